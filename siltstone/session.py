"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Capturing the Python call site of every column expression slows down plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators were tuned under."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    Only a local master may run without one; it gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="siltstone-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


_OWNED: ContextVar[tuple[str, ...]] = ContextVar("owned", default=())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder, inside a `scratch` block below the block's own folder."""
    folders = [scratch_root(spark).rstrip("/"), *_OWNED.get()[-1:]]
    return f"{'/'.join(folders)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """A job's own part of the scratch folder, removed when the job is done, also when it fails.

    Everything that is pinned inside the block goes there, so results have to be written elsewhere (or read to
    the end) before it closes. Blocks may be nested; other threads do not share them.
    """
    name = "/".join([*_OWNED.get()[-1:], f"{label}-{uuid.uuid4().hex}"])
    path = f"{scratch_root(spark).rstrip('/')}/{name}"
    token = _OWNED.set((*_OWNED.get(), name))
    try:
        yield path
    finally:
        _OWNED.reset(token)
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """An intermediate table of this session under a name: written once, read by SQL or by frames.

    It lives as long as its scratch block, or without one as long as the scratch folder.
    """
    held = pin(df, name)
    held.createOrReplaceTempView(name)
    return held


def pin(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Write `df` as a table in the shared folder, cut its lineage, and read it back.

    Row positions and other values that depend on one particular run stay the same afterwards, also
    when executors are lost. Later readers fetch only the columns they need, and the optimizer knows
    the table's size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_sized(df: DataFrame, label: str = "pinned") -> tuple[DataFrame, int]:
    """`pin`, and the bytes that the table takes in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(df.schema).parquet(path), files.getContentSummary(location).getLength()
