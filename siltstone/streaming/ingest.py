"""Incremental file ingestion: every file is consumed once, tracked by the stream's checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.sources.evolve import read_by_header, rescue
from siltstone.sources.files import CSV_QUOTES, RESCUED, with_audit
from siltstone.sources.headers import files_by_header

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


# What a record holds beyond the declared columns is kept; Spark's pruning would not notice it.
_KEEP_ALL = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED, "columnPruning": "false"}


def _reader(spark: SparkSession, fmt: str, options: Mapping[str, str] | None):
    reader = spark.readStream.format(fmt).option("recursiveFileLookup", True)
    return reader.options(**{**(CSV_QUOTES if fmt == "csv" else {}), **(options or {})})


def _declared(spark: SparkSession, src: str, fmt: str, schema: T.StructType | str, options: Mapping[str, str] | None, files: int):
    """A stream of files with declared columns; text formats get `_rescued_data` for records that do not fit."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    keep = {}
    if fmt in ("csv", "json"):
        keep = _KEEP_ALL
        if RESCUED not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    reader = _reader(spark, fmt, {**keep, "maxFilesPerTrigger": str(files), **(options or {})})
    return with_audit(reader.schema(schema).load(src))


def _writer(rows: DataFrame, checkpoint: str):
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)


def ingest(
    spark: SparkSession,
    src: str,
    fmt: str,
    dst: str,
    checkpoint: str,
    schema: T.StructType | str,
    options: Mapping[str, str] | None = None,
    files_per_trigger: int = 10_000,
) -> DataFrame:
    """Append new files below `src` to the Parquet table `dst` with audit columns.

    All files that are there are drained and the stream stops; a rerun adds only files that came since. CSV
    records whose number of fields is not that of `schema`, and JSON lines that cannot be read, are kept whole
    in `_rescued_data`.
    """
    rows = _declared(spark, src, fmt, schema, options, files_per_trigger)
    _writer(rows, checkpoint).trigger(availableNow=True).start(dst).awaitTermination()
    return spark.read.schema(rows.schema).parquet(dst)


def ingest_continuously(
    spark: SparkSession,
    src: str,
    fmt: str,
    dst: str,
    checkpoint: str,
    schema: T.StructType | str,
    options: Mapping[str, str] | None = None,
    every: str = "1 minute",
    files_per_trigger: int = 10_000,
) -> StreamingQuery:
    """As `ingest`, but the stream keeps running; the caller waits for it or stops it."""
    rows = _declared(spark, src, fmt, schema, options, files_per_trigger)
    return _writer(rows, checkpoint).trigger(processingTime=every).start(dst)


def ingest_rescued(
    spark: SparkSession, src: str, dst: str, checkpoint: str, known: list[str], array: bool = False
) -> DataFrame:
    """JSON Lines, or with `array` files of one JSON array each, as text columns.

    Unexpected fields and unreadable lines or files are kept in `_rescued_data`.
    """
    options = {"wholetext": "true"} if array else None
    rows = rescue(with_audit(_reader(spark, "text", options).load(src)), known, array=array)
    _writer(rows, checkpoint).trigger(availableNow=True).start(dst).awaitTermination()
    return spark.read.schema(rows.schema).parquet(dst)


def run_if_new_data(
    batches: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> int:
    """Hand pending input to `apply` in micro-batches; without new input it is not called.

    Returns how many micro-batches ran. `apply` has to be idempotent per batch id.
    """
    ran = 0

    def counted(batch: DataFrame, batch_id: int) -> None:
        nonlocal ran
        apply(batch, batch_id)
        ran += 1

    query = (
        batches.writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return ran


def ingest_evolving_csv(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    known: Sequence[str] | None = None,
    multiline: bool = True,
    files_per_batch: int = 10_000,
) -> DataFrame:
    """CSV whose header may gain columns, and whose records may not fit their header.

    Without `known` new columns are added, and older rows hold NULL; with `known` only these are columns and
    all other fields go to `_rescued_data`. Records with more or fewer fields than their header are kept there
    whole. Enclosed fields may hold line breaks (see `read_rescued_csv` for `multiline`).

    The stream only lists: it yields the path of every new file without opening it. A micro-batch takes at
    most `files_per_batch` of them, reads their headers and then the files by header, and writes its own
    folder, so a repeated batch replaces itself.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        groups = files_by_header(session, [row["path"] for row in batch.collect()])
        if groups:  # files without any record have no header
            rows = read_by_header(session, groups, audit=True, known=known, multiline=multiline)
            rows.write.mode("overwrite").parquet(f"{dst}/ingest_batch={batch_id}")

    reader = _reader(spark, "binaryFile", {"maxFilesPerTrigger": str(files_per_batch)})
    run_if_new_data(reader.schema(_LISTING).load(src).select("path"), load, checkpoint)
    return spark.read.option("mergeSchema", True).parquet(dst)
