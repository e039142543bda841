"""Accuracy of scored predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy_by(df: DataFrame, by: Sequence[str], ok: str, correct: str) -> DataFrame:
    """Attempted, scored and correct counts, and accuracy over the scored rows only."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col(ok)).alias("scored"),
        F.count_if(F.col(ok) & F.col(correct)).alias("correct_rows"),
    ).withColumn(
        "accuracy_pct",
        F.round(F.try_divide(F.col("correct_rows") * 100, F.col("scored")), 4),
    )


def cohort_gap(
    df: DataFrame, cohort: str, a: str, b: str, ok: str, correct: str, by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy of cohort `a` less that of cohort `b`, in percentage points."""

    def accuracy(name: str):
        inside = F.col(ok) & (F.col(cohort) == name)
        return F.try_divide(F.count_if(inside & F.col(correct)) * 100, F.count_if(inside))

    both = df.groupBy(*by).agg(accuracy(a).alias("pct_a"), accuracy(b).alias("pct_b"))
    return both.select(
        *by,
        F.round("pct_a", 4).alias("accuracy_a"),
        F.round("pct_b", 4).alias("accuracy_b"),
        F.round(F.col("pct_a") - F.col("pct_b"), 4).alias("gap_points"),
    )
