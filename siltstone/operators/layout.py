"""Physical layout of written tables: clustering, Morton order and overlap report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.operators.keys import running_totals
from siltstone.session import pin


_TIE = "_tie"


def _with_tie(df: DataFrame) -> DataFrame:
    """A last range key that splits a value too frequent for one file, identical rows included.

    It depends on row content and input partition only, so a retried task repeats it.
    """
    return df.withColumn(_TIE, F.xxhash64(F.spark_partition_id(), *df.columns))


def _ranges(df: DataFrame, files: int | None, columns: Sequence[str]) -> DataFrame:
    """Range-partition; without a number of files AQE merges neighbours up to its advisory size."""
    number = [] if files is None else [files]
    return _with_tie(df).repartitionByRange(*number, *columns, _TIE)


def cluster_by(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Range-partition and sort, so that files cover narrow ranges of the filter columns."""
    placed = _ranges(df, files, columns)
    return placed.sortWithinPartitions(*columns).drop(_TIE)


def _bucket(df: DataFrame, column: str, bits: int, error: float) -> Column:
    """Number of quantile cut points below the value; NULL goes to bucket 0."""
    parts = 1 << bits
    cuts = sorted(set(df.approxQuantile(column, [i / parts for i in range(1, parts)], error)))
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(column)))
    return F.when(F.col(column).isNull(), 0).otherwise(below) if cuts else F.lit(0)


def morton_key(
    df: DataFrame, columns: Sequence[str], bits: int = 5, error: float = 0.01
) -> Column:
    """Interleaved bits of the columns' quantile buckets. Columns are numeric."""
    buckets = [_bucket(df, c, bits, error).cast("bigint") for c in columns]
    width = len(columns)
    pieces = [
        F.shiftleft(F.shiftright(b, bit).bitwiseAND(F.lit(1)), bit * width + place)
        for bit in range(bits)
        for place, b in enumerate(buckets)
    ]
    return reduce(lambda x, y: x.bitwiseOR(y), pieces)


def zorder_by(
    df: DataFrame,
    columns: Sequence[str],
    files: int | None = None,
    bits: int = 5,
    within: Sequence[str] = (),
) -> DataFrame:
    """Rows near each other in several columns end up in the same file.

    `within` names partition columns of the table: the order then holds inside each partition, and a
    partition is spread over a few neighbouring tasks only.
    """
    keyed = df.withColumn("_z", morton_key(df, columns, bits))
    placed = _ranges(keyed, files, [*within, "_z"])
    return placed.sortWithinPartitions(*within, "_z", *columns).drop("_z", _TIE)


SORT_BITS = 8


def dense_cell(key: str, count: int, bits: int) -> Column:
    """Which of 2^bits equal stretches of 1 .. count the key lies in; NULL goes to the first."""
    place = F.floor((F.col(key) - 1) * F.lit(1 << bits) / F.lit(max(count, 1)))
    return F.coalesce(F.greatest(F.least(place, F.lit((1 << bits) - 1)), F.lit(0)), F.lit(0)).cast("bigint")


def zorder_dense(df: DataFrame, keys: Mapping[str, int], within: Sequence[str] = (), cells: int = 64) -> DataFrame:
    """As `zorder_by` for dense surrogate keys {column: highest key}, without looking at the data first.

    Dense keys need no quantiles and no sampled ranges: a key's cell follows from its number. Rows of one of
    `cells` cells (per combination of `within`) come together by hash; AQE merges small neighbours and splits
    large cells, and inside a task rows lie in Morton order. The frame is computed once.
    """
    width = len(keys)
    coarse = min(SORT_BITS, max(1, -(-(cells - 1).bit_length() // width)))
    parts = [dense_cell(key, count, SORT_BITS) for key, count in keys.items()]
    pieces = [
        F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1)), bit * width + place)
        for bit in range(SORT_BITS)
        for place, part in enumerate(parts)
    ]
    keyed = df.withColumn("_z", reduce(lambda x, y: x.bitwiseOR(y), pieces))
    keyed = keyed.withColumn("_cell", F.shiftright("_z", (SORT_BITS - coarse) * width))
    return keyed.hint("rebalance", *within, "_cell").sortWithinPartitions(*within, "_z", *keys).drop("_z", "_cell")


def file_ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file_path, row_count, min_value, max_value) of every Parquet file, from the footers alone.

    Tasks open the footers on file systems that Arrow knows. Files whose footers hold no range for the column
    (some writers and types leave it out) are scanned; so is everything on other file systems.
    """
    table = spark.read.parquet(path)
    kind = table.schema[column].dataType
    arrow_kind = to_arrow_type(kind)

    def run(batches):
        for batch in batches:
            files, counts, lows, highs, known = [], [], [], [], []
            for name in batch.column(0).to_pylist():
                scheme, _, rest = name.partition(":")
                try:
                    fs, place = (pafs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else pafs.FileSystem.from_uri(name)
                    footer = pq.read_metadata(place, filesystem=fs)
                except (pa.ArrowInvalid, OSError):
                    files, counts, lows, highs, known = [*files, name], [*counts, None], [*lows, None], [*highs, None], [*known, False]
                    continue
                groups = [footer.row_group(k) for k in range(footer.num_row_groups)]
                stats = [g.column(k).statistics for g in groups for k in range(g.num_columns) if g.column(k).path_in_schema == column]
                held = [x for x in stats if x is not None and x.has_min_max]
                blank = [x for x in stats if x is not None and not x.has_min_max and x.has_null_count and x.num_values == 0]
                files.append(name)
                counts.append(footer.num_rows)
                lows.append(min((x.min for x in held), default=None))
                highs.append(max((x.max for x in held), default=None))
                known.append(len(stats) == len(groups) == len(held) + len(blank))
            columns = [pa.array(files, pa.string()), pa.array(counts, pa.int64()), pa.array(lows, arrow_kind), pa.array(highs, arrow_kind), pa.array(known, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["file_path", "row_count", "min_value", "max_value", "known"])

    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    out = T.StructType.fromDDL("file_path string, row_count bigint").add("min_value", kind).add("max_value", kind).add("known", "boolean")
    found = pin(listing.mapInArrow(run, out), "footers")
    rest = [r[0] for r in found.filter("not known").select("file_path").collect()]  # one entry per file without a range
    found = found.filter("known").drop("known")
    if not rest:
        return found
    scanned = spark.read.parquet(*rest).groupBy(F.col("_metadata.file_path").alias("file_path"))
    return found.union(
        scanned.agg(F.count(F.lit(1)).alias("row_count"), F.min(column).alias("min_value"), F.max(column).alias("max_value"))
    )


def clustering_info(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Per file: rows, smallest and largest value, and how many files overlap its range.

    Overlaps are counted by a sweep: files that start at or before this file's end, less the files
    that end before it starts.
    """
    files = file_ranges(spark, path, column).filter(F.col("min_value").isNotNull())
    start = F.struct(F.col("min_value").alias("at"), F.lit(0).alias("is_end"))
    end = F.struct(F.col("max_value").alias("at"), F.lit(1).alias("is_end"))
    marks = files.withColumn("mark", F.explode(F.array(start, end)))
    swept = running_totals(
        marks,
        ["mark", "file_path"],
        {"started": 1 - F.col("mark.is_end"), "ended": F.col("mark.is_end")},
    )
    depth = F.sum(
        F.when(F.col("mark.is_end") == 1, F.col("started")).otherwise(-F.col("ended"))
    )
    return swept.groupBy("file_path", "row_count", "min_value", "max_value").agg(
        depth.alias("overlap_depth")
    )


def pruned_files(info: DataFrame, low, high) -> DataFrame:
    """Files a range filter has to read, and how many there are."""
    hit = (F.col("max_value") >= F.lit(low)) & (F.col("min_value") <= F.lit(high))
    return info.agg(F.count_if(hit).alias("files_read"), F.count(F.lit(1)).alias("files_total"))
