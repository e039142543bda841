"""Grouped counts, money sums, distinct counts and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import hour_of, money, shift


def row_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Count per group together with the overall count (group columns NULL), in one pass."""
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    total = groups.agg(F.sum("row_count").cast("bigint").alias("row_count"))
    return groups.withColumn("scope", F.lit("group")).unionByName(
        total.withColumn("scope", F.lit("all")), allowMissingColumns=True
    )


def revenue(df: DataFrame, by: Sequence[str], amount: str | Column, name: str = "revenue") -> DataFrame:
    total = F.sum(F.col(amount) if isinstance(amount, str) else amount)
    return df.groupBy(*by).agg(money(total).alias(name))


def daily_counts(df: DataFrame, by: Sequence[str], distinct: dict[str, str]) -> DataFrame:
    """Row count and several exact distinct counts per group: `{output name: column}`.

    Spark expands the rows per counted column and first groups by column value, so the rows of one
    large group are spread over its distinct values before they meet.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.countDistinct(c).alias(name) for name, c in distinct.items()],
    )


def distinct_composite(df: DataFrame, columns: Sequence[str]) -> Column:
    """Distinct count of a composite key whose NULL parts count as blank."""
    return F.countDistinct(F.struct(*[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def rate(bad: Column) -> Column:
    """Share of rows for which `bad` holds; NULL on no rows."""
    return F.try_divide(F.count_if(bad), F.count(F.lit(1)))


def usage_rollup(
    df: DataFrame, by: Sequence[str], ts: str, value: str | Column, now: Column, days: int
) -> DataFrame:
    """Sum and number of active hours over the trailing window, largest first."""
    recent = df.filter(F.col(ts) >= shift(now, -days, "days"))
    total = F.sum(F.col(value) if isinstance(value, str) else value)
    return (
        recent.groupBy(*by)
        .agg(
            money(total).alias("total_value"),
            F.countDistinct(hour_of(ts)).alias("active_hours"),
        )
        .orderBy(F.desc("total_value"), *by)
    )


def rollup_by(df: DataFrame, columns: Sequence[str], amount: str) -> DataFrame:
    """Row count and revenue per group."""
    return df.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("orders"), money(F.sum(amount)).alias("revenue")
    )


def distinct_bitmaps(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by, bucket, bits): which values of a dense, not negative number occur, as bitmaps of 32,768 values each.

    Bitmaps of any groups can be joined to those of larger groups without the rows, and the counts stay exact.
    Rows whose number is NULL are left out, as by a distinct count.
    """
    known = df.filter(F.col(key).isNotNull())
    placed = known.select(*by, F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("_place"))
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_place").alias("bits"))


def distinct_from(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact distinct counts of larger groups from the bitmaps of smaller ones."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
