"""Data-quality gates, reject reasons, quarantine and control logs.

A gate is one aggregate that returns a metrics frame; `enforce` turns failed metrics into an error.
All limits are strict: a share equal to the limit fails, and so does an empty load.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.columns import is_blank, normal_key
from siltstone.operators.joins import mark_known


class DataQualityError(RuntimeError):
    """A gate failed; nothing downstream may run."""


def _verdict(df: DataFrame, rule: str, table: str, limit: float, unit: str = "rows") -> DataFrame:
    """Complete `failed_rows` and `total_rows` to a metrics row."""
    share = F.try_divide(F.col("failed_rows"), F.col("total_rows"))
    return df.withColumns(
        {
            "failed_rows": F.coalesce("failed_rows", F.lit(0)).cast("bigint"),
            "total_rows": F.coalesce("total_rows", F.lit(0)).cast("bigint"),
            "rule_name": F.lit(rule),
            "table_name": F.lit(table),
            "threshold": F.lit(f"< {limit:.0%} of {unit}"),
            "passed": F.coalesce(share < F.lit(limit), F.lit(False)),
        }
    )


def _share_gate(
    df: DataFrame, bad: Column, rule: str, table: str, limit: float, by: Sequence[str]
) -> DataFrame:
    counts = [F.count_if(bad).alias("failed_rows"), F.count(F.lit(1)).alias("total_rows")]
    return _verdict(df.groupBy(*by).agg(*counts), rule, table, limit)


def gate_null_rate(
    df: DataFrame, column: str, limit: float = 0.02, by: Sequence[str] = (), table: str = "silver"
) -> DataFrame:
    """Share of rows in which the column is NULL."""
    return _share_gate(df, F.col(column).isNull(), f"NULL_{column.upper()}", table, limit, by)


def gate_null_keys(
    df: DataFrame,
    columns: Sequence[str],
    limit: float = 0.02,
    by: Sequence[str] = (),
    table: str = "bronze",
) -> DataFrame:
    """Share of rows in which any business key column is blank."""
    bad = reduce(lambda a, b: a | b, [is_blank(c) for c in columns])
    return _share_gate(df, bad, "NULL_BUSINESS_KEYS", table, limit, by)


def gate_duplicates(
    df: DataFrame,
    key: Sequence[str],
    required: str,
    limit: float = 0.05,
    by: Sequence[str] = (),
    table: str = "bronze",
) -> DataFrame:
    """Keys with more than one row, relative to all distinct keys.

    Only keys whose `required` part is set can fail, while the denominator holds every key (NULL
    parts count as blank). Rows are counted per key first, so copies collapse before they meet.
    """
    normal = {c: F.coalesce(normal_key(c), F.lit("")) for c in key}
    per_key = df.withColumns(normal).groupBy(*by, *key).agg(F.count(F.lit(1)).alias("copies"))
    repeated = (F.col("copies") > 1) & (F.col(required) != "")
    counts = per_key.groupBy(*by).agg(
        F.count_if(repeated).alias("failed_rows"), F.count(F.lit(1)).alias("total_rows")
    )
    return _verdict(counts, "DUPLICATE_KEYS", table, limit, "keys")


def gate_referential(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    name: str,
    limit: float = 0.02,
    by: Sequence[str] = (),
    table: str = "bronze",
) -> DataFrame:
    """Rows with a key, without a name to onboard it, and unknown to the dimension.

    Candidates are counted per key before the lookup, so the join sees one row per key.
    """
    nameless = ~is_blank(on) & is_blank(name)
    per_key = (
        df.withColumn("_key", normal_key(on))
        .groupBy(*by, "_key")
        .agg(F.count_if(nameless).alias("nameless"), F.count(F.lit(1)).alias("total_rows"))
    )
    known = dim.select(normal_key(on).alias("_key"))
    marked = mark_known(per_key, known, ["_key"], "_known")
    counts = marked.groupBy(*by).agg(
        F.sum(F.when(~F.col("_known"), F.col("nameless")).otherwise(0)).alias("failed_rows"),
        F.sum("total_rows").alias("total_rows"),
    )
    return _verdict(counts, f"REFERENTIAL_{on.upper()}", table, limit)


METRIC_COLUMNS = ("rule_name", "table_name", "failed_rows", "total_rows", "threshold", "passed")


def dq_log(results: Sequence[DataFrame], run_ts: Column | None = None) -> DataFrame:
    """One log frame from several gates, ready to append."""
    together = reduce(lambda a, b: a.unionByName(b), results)
    return together.withColumn("logged_at", F.localtimestamp() if run_ts is None else run_ts)


def enforce(metrics: DataFrame) -> None:
    """Raise when any metrics row failed, or when there is none."""
    failed = metrics.filter(~F.col("passed")).collect()  # one row per gate and group
    if failed:
        raise DataQualityError("; ".join(
            f"{r['rule_name']} on {r['table_name']}: {r['failed_rows']} of {r['total_rows']}, "
            f"limit {r['threshold']}" for r in failed
        ))
    if metrics.isEmpty():
        raise DataQualityError("empty load")


def reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """First rule that applies gives the reason; NULL means the row is clean."""
    reasons = [F.when(condition, F.lit(reason)) for reason, condition in rules]
    return df.withColumn("reject_reason", F.coalesce(*reasons))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their reason). Persist `df` when both sides are written."""
    reason = F.col("reject_reason")
    return df.filter(reason.isNull()).drop("reject_reason"), df.filter(reason.isNotNull())


def quarantine_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def dedupe_removed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows before and after keeping one per key: one aggregation, no second scan."""
    copies = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def acceptance(checks: dict[str, DataFrame]) -> DataFrame:
    """`{check: frame of offending rows}` to (check_name, value, passed): offending must be none."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("check_name"), "value", (F.col("value") == 0).alias("passed")
        )
        for name, df in checks.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


LOAD_LOG_SCHEMA = (
    "pipeline_name string, business_date date, step string, rows_affected bigint, "
    "status string, message string"
)


def load_log(
    spark: SparkSession, pipeline: str, business_date, steps: Sequence[tuple[str, Callable[[], int]]]
) -> DataFrame:
    """Run the steps in order, each returning its row count, and log every outcome.

    A failing step is logged as FAILED and the steps after it as SKIPPED; the caller appends the
    log and decides whether to raise. Counts come from `observe`, not from a second scan.
    """
    log, failed = [], False
    for step, run in steps:
        rows, status, message = None, "SKIPPED", None
        if not failed:
            try:
                rows, status = run(), "SUCCESS"
            except Exception as error:  # the log has to name any failure
                status, message, failed = "FAILED", str(error), True
        log.append((pipeline, business_date, step, rows, status, message))
    return spark.createDataFrame(log, LOAD_LOG_SCHEMA).withColumn("logged_at", F.localtimestamp())
