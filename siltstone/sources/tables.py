"""Parquet tables: versioned full refresh, partitioned facts, replace by key, append, update.

A full refresh goes to a new version folder and becomes visible when its `_SUCCESS` marker is
written; a failure leaves the version before it readable.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.joins import keyed_join
from siltstone.operators.merge import upsert
from siltstone.session import pin, pin_sized
from siltstone.sources import key_index, storage

_VERSION = "v="


def versions(spark: SparkSession, base: str) -> list[int]:
    """Complete versions, oldest first."""
    found = [n for n in storage.children(spark, base) if n.startswith(_VERSION)]
    complete = [n for n in found if storage.exists(spark, f"{base}/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix(_VERSION)) for n in complete)


def version_path(base: str, version: int) -> str:
    return f"{base}/{_VERSION}{version}"


def write_overwrite(df: DataFrame, base: str, version: int | None = None) -> str:
    """Write a new version and return its path. An explicit number makes a retry idempotent."""
    if version is None:
        done = versions(df.sparkSession, base)
        version = done[-1] + 1 if done else 1
    path = version_path(base, version)
    df.write.mode("overwrite").parquet(path)
    return path


def write_unpublished(df: DataFrame, base: str, by: Sequence[str] = ()) -> str:
    """Write the next version without its completion marker: readers do not see it yet.

    For loads whose quality is measured while they are written; see `publish`.
    """
    done = versions(df.sparkSession, base)
    path = version_path(base, done[-1] + 1 if done else 1)
    unmarked = df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unmarked.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def publish(spark: SparkSession, path: str) -> str:
    """Make a version written by `write_unpublished` the current one."""
    storage.touch(spark, f"{path}/_SUCCESS")
    return path


def read_current(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """Newest complete version, or the one asked for."""
    done = versions(spark, base)
    if not done or (version is not None and version not in done):
        raise FileNotFoundError(f"no complete version {version or ''} below {base}")
    return spark.read.parquet(version_path(base, done[-1] if version is None else version))


def retire_versions(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Remove all but the newest `keep` complete versions; returns the numbers of those removed."""
    old = versions(spark, base)[:-keep]
    for version in old:
        storage.remove_folder(spark, version_path(base, version))
    return old


def _spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together for few files; oversized partitions are split by AQE."""
    return df.hint("rebalance", *by)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> str:
    _spread(df, by).write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def replace_by_key(df: DataFrame, path: str, key: str, values: Sequence[Any]) -> str:
    """Delete and insert by partition: afterwards `values` hold exactly the rows of `df`.

    Partitions without replacement rows are cleared, which a dynamic overwrite alone does not do.
    """
    spark = df.sparkSession
    rows = pin(df.filter(F.col(key).isin(list(values))), "replacement")
    found = {row[0] for row in rows.select(key).distinct().collect()}  # at most len(values) entries
    (
        _spread(rows, [key])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    for value in set(values) - found:
        storage.remove_folder(spark, f"{path}/{key}={value}")
    return path


def append_select(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def update_where(df: DataFrame, condition: Column, **assignments: Any) -> DataFrame:
    """New table state with the assigned columns where the condition holds."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns(
        {
            c: F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c))
            for c, v in assignments.items()
        }
    )


def observed_write(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write and return the row count without a second scan."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get["rows"]


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: Sequence[str],
    update_columns: Sequence[str],
    partition: str,
    run_ts: Column | None = None,
    schema: T.StructType | str | None = None,
) -> int:
    """Upsert into a partitioned table, rewriting only the partitions that the source touches.

    `schema` is needed if the table may still be without a file.

    The index of `key_index` names the partitions that may hold a key of the source; their key columns are
    read to see which do. Other partitions are not opened, nor are files listed one by one on the driver.
    Files that other writers made since are read once and indexed. Rerunning after a failure between two
    partitions gives the same table, since the upsert itself is idempotent. Returns the number of rewritten
    partitions.
    """
    target = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    source, size = pin_sized(source.select(*[c for c in target.columns if c in source.columns]), "batch")
    near, unknown = key_index.candidates(spark, target, path, source, key, partition)
    near = target.filter(key_index.among(partition, near))
    matched = keyed_join(near.select(*key, partition), source.select(*key), key, "left_semi")
    touched = matched.select(partition).union(source.select(partition)).distinct()
    values = [row[0] for row in touched.collect()]  # one entry per partition
    merged = upsert(target.filter(key_index.among(partition, values)), source, key, update_columns, run_ts, size=size)
    (
        _spread(merged, [partition])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    written = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    key_index.add_files(spark, written, path, key, partition, list(dict.fromkeys([*values, *unknown])))
    return len(values)
