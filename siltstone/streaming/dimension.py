"""A type 2 dimension on disk whose batches cost what they change.

Current versions are kept in hash buckets of the key: a batch reads the buckets its keys fall into and
writes those in which a version was opened. Versions that a batch closes, and changes that came too late,
are written once beside them and never again. Folders that no reader can need any more are removed.

Below `base`: `current` (see `sources.buckets`), and `aside/batch=N/kind=closed|late`.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.predicates import Differs, changed
from siltstone.operators.keys import dense_key
from siltstone.operators.merge import Interval, decide, end_of, open_versions
from siltstone.session import pin
from siltstone.sources import buckets, storage


# So many new versions are numbered by one sort in one task; more of them by ranges.
ONE_TASK = 50_000


def _numbered(rows: DataFrame, key: Sequence[str], name: str, start: int, count: int) -> DataFrame:
    """Consecutive numbers from `start` in key order; `count` is the number of rows."""
    if count > ONE_TASK:
        return dense_key(rows, key, name, start=start)
    place = F.row_number().over(Window.orderBy(*key)) + F.lit(start - 1)
    return rows.select(place.cast("bigint").alias(name), *rows.columns)


@dataclass(frozen=True)
class Dimension:
    """`key`, `tracked` and `ts` as in `merge.scd2_apply`; `surrogate` numbers versions in the order they came."""

    base: str
    key: Sequence[str]
    tracked: Sequence[str] | Differs
    ts: str
    surrogate: str
    count: int = 64
    interval: Interval = "half_open"

    def start(self, delta: DataFrame, run_ts: Column | None = None) -> None:
        """The first load: one row per key, all of them current. It is version 1."""
        rows = dense_key(open_versions(delta, self.ts, run_ts), list(self.key), self.surrogate)
        last = rows.count()
        buckets.write(rows, f"{self.base}/current", self.key, buckets.State(0, self.count), last_key=last, schema=rows.schema.json())

    def apply(self, delta: DataFrame, version: int, run_ts: Column | None = None) -> None:
        """Make `version` from the one before it. Doing it again gives the same tables.

        `delta` holds one row per key with the dimension's attributes and the change instant. Changes older
        than the current version are set aside, see `late`.
        """
        spark, key = delta.sparkSession, list(self.key)
        before = buckets.state(spark, f"{self.base}/current", version - 1)
        schema = T.StructType.fromJson(json.loads(before.notes["schema"]))
        if run_ts is not None:
            delta = delta.withColumn(self.ts, F.coalesce(F.col(self.ts), run_ts))
        delta = pin(delta, "batch")
        hit = buckets.touched(delta, key, before.count)
        rows = buckets.read(spark, f"{self.base}/current", schema, version - 1, hit)
        pairs = delta.select(*key, F.struct(*delta.columns).alias("s")).join(rows.select(*key, F.struct(*rows.columns).alias("d")), key, "left")
        differs = self.tracked if callable(self.tracked) else changed(self.tracked)
        decided = decide(pairs.select("s", "d"), self.ts, differs)
        decided = pin(decided.filter("d is null or _differs"), "decided")
        replaces = F.col("_differs") & ~F.col("_late")

        opens = decided.filter(F.col("d").isNull() | replaces).select("s.*")
        counts = opens.groupBy(buckets.bucket_of(key, before.count).alias("b")).count().collect()  # a number per bucket
        total, start = sum(r["count"] for r in counts), before.notes["last_key"] + 1
        opened = _numbered(open_versions(opens, self.ts), key, self.surrogate, start, total)
        kind = F.when(F.col("_late"), "late").otherwise("closed")
        ends = F.when(replaces, end_of(F.col(f"s.{self.ts}"), self.interval))
        closed = [
            F.col(f"d.{c.name}") if c.name not in ("valid_to", "is_current")
            else (ends.cast(c.dataType) if c.name == "valid_to" else F.lit(False)).alias(c.name)
            for c in schema
        ]
        late = [
            (F.col(f"s.{self.ts}") if c.name == "valid_from" else F.col(f"s.{c.name}") if c.name in delta.columns else F.lit(None))
            .cast(c.dataType).alias(c.name)
            for c in schema
        ]
        aside = decided.filter("_differs").select(kind.alias("kind"), F.when(F.col("_late"), F.struct(*late)).otherwise(F.struct(*closed)).alias("v"))
        aside.select("kind", "v.*").write.mode("overwrite").partitionBy("kind").parquet(f"{self.base}/aside/batch={version}")

        written = sorted(r["b"] for r in counts)
        gone = decided.filter(replaces).select(*[F.col(f"s.{k}").alias(k) for k in key])
        stays = buckets.read(spark, f"{self.base}/current", schema, version - 1, written).join(gone, key, "left_anti")
        after = stays.unionByName(opened.select(*schema.names)).select(*schema.names)
        buckets.write(after, f"{self.base}/current", key, before, written, last_key=start - 1 + total)
        buckets.retire(spark, f"{self.base}/current")

    def _schema(self, spark: SparkSession) -> T.StructType:
        return T.StructType.fromJson(json.loads(buckets.state(spark, f"{self.base}/current").notes["schema"]))

    def current(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """Current versions, as the newest batch or the one asked for left them."""
        return buckets.read(spark, f"{self.base}/current", self._schema(spark), version)

    def _aside(self, spark: SparkSession, kind: str) -> DataFrame:
        schema = self._schema(spark)
        last = buckets.versions(spark, f"{self.base}/current")[-1]
        done = [n for n in storage.children(spark, f"{self.base}/aside") if int(n.partition("=")[2]) <= last]
        paths = [f"{self.base}/aside/{n}/kind={kind}" for n in done]
        paths = [p for p in paths if storage.exists(spark, p)]
        if not paths:
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("version", T.IntegerType())]))
        version = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/kind=", 1).cast("int")
        return spark.read.schema(schema).parquet(*paths).withColumn("version", version)

    def closed(self, spark: SparkSession) -> DataFrame:
        """Versions that have ended."""
        return self._aside(spark, "closed").drop("version")

    def versions(self, spark: SparkSession) -> DataFrame:
        """Current and closed versions."""
        return self.current(spark).unionByName(self.closed(spark))

    def late(self, spark: SparkSession) -> DataFrame:
        """Changes that came after a newer version, with their instant as `valid_from` and the `version` of the
        dimension whose batch brought them; none is applied."""
        return self._aside(spark, "late").drop(self.surrogate, "valid_to", "is_current")
