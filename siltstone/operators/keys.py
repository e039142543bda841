"""Dense surrogate keys and running totals without a single-partition window.

Rows are range-partitioned in key order and sorted inside each partition. A row's number is its
position in the partition plus the size of all partitions before it, so the only thing that meets in
one place is one count per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import pin

# monotonically_increasing_id() holds the partition above bit 33 and the row position below it.
_POSITION_BITS = 33


def placed_rows(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Globally sorted rows with their partition (`_part`) and position in it (`_pos`).

    Range bounds come from a sample, so the placement is pinned before anything reads it twice.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = pin(sorted_rows.withColumn("_row", F.monotonically_increasing_id()))
    return placed.select(
        *df.columns,
        F.shiftright("_row", _POSITION_BITS).alias("_part"),
        F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def _with_offsets(placed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Attach, for every total, its sum over all earlier partitions as `_before_<name>`."""
    rows = (
        placed.groupBy("_part")
        .agg(*[total.cast("bigint").alias(name) for name, total in totals.items()])
        .orderBy("_part")
        .collect()  # one row per range partition
    )
    before = {
        name: [0, *accumulate(row[name] for row in rows)] for name in totals
    }
    offsets = [
        (row["_part"], *[before[name][i] for name in totals]) for i, row in enumerate(rows)
    ]
    schema = "_part bigint, " + ", ".join(f"_before_{name} bigint" for name in totals)
    lookup = placed.sparkSession.createDataFrame(offsets, schema)
    return placed.join(F.broadcast(lookup), "_part")


def dense_key(
    df: DataFrame, order: Sequence[str | Column], name: str, start: int = 1
) -> DataFrame:
    """Consecutive numbers from `start` in `order`, equal to a global row number.

    `order` has to identify rows, otherwise numbers inside a tie are arbitrary.
    """
    numbered = _with_offsets(placed_rows(df, order), {"rows": F.count(F.lit(1))})
    key = F.col("_before_rows") + F.col("_pos") + F.lit(start)
    return numbered.select(key.cast("bigint").alias(name), *df.columns)


def continue_key(
    existing: DataFrame, new: DataFrame, order: Sequence[str | Column], name: str
) -> DataFrame:
    """Number only the new rows, from the largest existing key on. Existing keys never move."""
    highest = existing.agg(F.max(name)).first()[0] or 0
    return dense_key(new.drop(name), order, name, start=highest + 1)


def running_totals(
    df: DataFrame, order: Sequence[str | Column], values: dict[str, Column]
) -> DataFrame:
    """Running sum (inclusive) of every value in global `order`."""
    placed = placed_rows(df.withColumns(values), order)
    numbered = _with_offsets(placed, {name: F.sum(name) for name in values})
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return numbered.select(
        *df.columns,
        *[
            (F.sum(name).over(inside) + F.col(f"_before_{name}")).alias(name)
            for name in values
        ],
    )
