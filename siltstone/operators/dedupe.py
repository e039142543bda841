"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _descending(order: Sequence[str | Column]) -> list[Column]:
    """Names sort newest first with NULL last; Column entries are taken as written."""
    return [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key under `order`, which must be a total order within the key.

    The rank filter is planned as a group limit on both sides of the shuffle, so one task receives
    at most one row per key and upstream partition, however many copies a key has.
    """
    window = Window.partitionBy(*key).orderBy(*_descending(order))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def max_collapse(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key holding the maximum of every attribute on its own."""
    return df.groupBy(*key).agg(*[F.max(c).alias(c) for c in columns])


def change_set(
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    action_column: str | None = None,
) -> DataFrame:
    """Latest inserted row per key of one micro-batch."""
    rows = batch if action_column is None else batch.filter(F.col(action_column) == "INSERT")
    return latest(rows, key, order)


def latest_success(
    df: DataFrame, item: Sequence[str], status: str, ts: str, ok: str = "ok"
) -> DataFrame:
    """Newest successful response per item; the newest failure only where nothing succeeded."""
    return latest(df, item, [(F.col(status) == ok).desc_nulls_last(), ts])
