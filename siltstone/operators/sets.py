"""Ordering, top-k, unions and calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ordered(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*columns)


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """Largest k rows; `tie` makes the cut repeatable. Planned as a per-partition top-k."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie).limit(k)


def first_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_labelled(frames: Mapping[str, DataFrame], label: str = "source") -> DataFrame:
    marked = [df.withColumn(label, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), marked)


def calendar(spark: SparkSession, start: str, end: str, name: str = "cal_date") -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))


def calendar_of(df: DataFrame, column: str, name: str = "cal_date") -> DataFrame:
    """Every day between the first and last date found in the data."""
    span = df.agg(F.to_date(F.min(column)).alias("lo"), F.to_date(F.max(column)).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias(name))
