"""Tables with a unique key, kept in hash buckets, so that a batch rewrites only the buckets its keys fall into.

Below `base`:

* `data/batch=N/bucket=B`: the rows of bucket B as batch N left them; only touched buckets are written;
* `state/v=N.json`: for every bucket the batch that wrote it last. A batch becomes visible with its state
  file, which appears under its name only when it is complete.

The number of buckets is fixed when the table is made; choose it so that a bucket is a file or a few. The
driver handles one number per bucket. A batch that is run again writes the same folder and state again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources import storage

BUCKET = "bucket"


@dataclass
class State:
    """Where each bucket's rows are, and what the table's owner keeps beside them."""

    version: int
    count: int
    written: dict[int, int] = field(default_factory=dict)  # bucket -> batch; buckets without rows are missing
    notes: dict[str, Any] = field(default_factory=dict)


def bucket_of(key: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")


def versions(spark: SparkSession, base: str) -> list[int]:
    """Versions with a complete state, oldest first."""
    names = storage.children(spark, f"{base}/state")
    return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json"))


def state(spark: SparkSession, base: str, version: int | None = None) -> State:
    """The newest state, or the one asked for."""
    done = versions(spark, base)
    if not done or (version is not None and version not in done):
        raise FileNotFoundError(f"no state {'' if version is None else version} below {base}")
    found = json.loads(storage.read_text(spark, f"{base}/state/v={done[-1] if version is None else version}.json"))
    return State(found["version"], found["count"], {int(k): v for k, v in found["written"].items()}, found["notes"])


def _folder(base: str, bucket: int, batch: int) -> str:
    return f"{base}/data/batch={batch}/{BUCKET}={bucket}"


def read(
    spark: SparkSession, base: str, schema: T.StructType, version: int | None = None, buckets: Iterable[int] | None = None
) -> DataFrame:
    """Rows of the table, or of some buckets: no other file is listed or opened."""
    held = state(spark, base, version)
    wanted = held.written if buckets is None else [b for b in buckets if b in held.written]
    paths = [_folder(base, b, held.written[b]) for b in sorted(wanted)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def touched(rows: DataFrame, key: Sequence[str], count: int) -> list[int]:
    """Buckets of the rows' keys: one number per bucket."""
    return sorted(r[0] for r in rows.select(bucket_of(key, count).alias(BUCKET)).distinct().collect())


def write(
    rows: DataFrame, base: str, key: Sequence[str], before: State, buckets: Iterable[int] | None = None, **notes: Any
) -> State:
    """Commit the version after `before`, in which `buckets` (default: all) hold exactly `rows`; others stay as they are."""
    spark, version = rows.sparkSession, before.version + 1
    folder = f"{base}/data/batch={version}"
    placed = rows.withColumn(BUCKET, bucket_of(key, before.count))
    placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    filled = {int(n.partition("=")[2]) for n in storage.children(spark, folder) if n.startswith(f"{BUCKET}=")}
    replaced = set(range(before.count)) if buckets is None else set(buckets)
    if not filled <= replaced:
        raise ValueError(f"rows of buckets {sorted(filled - replaced)} were not to be written")
    written = {b: n for b, n in before.written.items() if b not in replaced} | dict.fromkeys(filled, version)
    after = State(version, before.count, written, {**before.notes, **notes})
    text = json.dumps({"version": version, "count": after.count, "written": written, "notes": after.notes})
    storage.write_text(spark, f"{base}/state/v={version}.json", text)
    return after


def retire(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Remove what none of the newest `keep` versions refers to; returns the number of folders removed.

    Two versions are enough to run the last batch again. Nothing that a later batch will read is touched.
    """
    done = versions(spark, base)
    if len(done) <= keep:
        return 0
    live = {(n, b) for v in done[-keep:] for b, n in state(spark, base, v).written.items()}
    for v in done[:-keep]:
        storage.remove_folder(spark, f"{base}/state/v={v}.json")
    gone = 0
    for name in storage.children(spark, f"{base}/data"):
        batch = int(name.partition("=")[2])
        if batch > done[-1]:  # being written
            continue
        held = [n for n in storage.children(spark, f"{base}/data/{name}") if n.startswith(f"{BUCKET}=")]
        dead = [n for n in held if (batch, int(n.partition("=")[2])) not in live]
        if len(dead) == len(held) and batch not in done[-keep:]:
            storage.remove_folder(spark, f"{base}/data/{name}")
        else:
            for n in dead:
                storage.remove_folder(spark, f"{base}/data/{name}/{n}")
        gone += len(dead)
    return gone
