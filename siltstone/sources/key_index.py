"""Which partitions of a table may hold the keys of a batch, without reading the table's keys.

For every data file the index keeps a Bloom filter, cut into slots of SLOT_BITS bits that hold about
KEYS_PER_SLOT keys each, with the smallest and the largest key of each slot; a key's hash names the slot,
and PROBES bits are set in it. Data files are never changed in place, so an entry stays right as long as
its file exists: entries of files that are gone are passed over, and the partition of a file without an
entry always counts as a candidate. A filter can name a partition too many (about one key and file in
400), never one too few.

The index is a Parquet table in `_keys` below the data, which readers of the table do not see.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import pin
from siltstone.sources import storage

SLOT_BITS = 1 << 15  # what one Spark bitmap holds
KEYS_PER_SLOT = 2048
PROBES = 4
EARLY = 64  # the part of the keys that is tested first


def _file(part: Column, name: Column) -> Column:
    """A file's name within the table: one task gives its files in several partitions the same name."""
    return F.concat_ws("/", F.coalesce(part.cast("string"), F.lit("")), name)


def index_path(path: str) -> str:
    return f"{path}/_keys"


def _schema(key: T.StructType, partition: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("part", partition), T.StructField("low", key), T.StructField("high", key)]
        + [T.StructField("slots", T.LongType()), T.StructField("slot", T.LongType()), T.StructField("bits", T.BinaryType())]
    )


def live_files(spark: SparkSession, path: str, partition: str, kind: T.DataType) -> DataFrame:
    """(file, part): the data files that are there now, from the listing alone; none for a table without files."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    folder = F.regexp_extract("path", f"/{partition}=([^/]*)/[^/]*$", 1)
    value = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))).cast(kind)  # folders write odd characters as %XX
    part = F.when(folder != "__HIVE_DEFAULT_PARTITION__", value)
    live = listing.load(path).filter(~F.col("path").contains("/_keys")).select("path", part.alias("part"))
    return live.select(_file(F.col("part"), F.element_at(F.split("path", "/"), -1)).alias("file"), "part")


def read_index(spark: SparkSession, path: str, key: T.StructType, partition: T.DataType) -> DataFrame:
    schema = _schema(key, partition)
    if not storage.exists(spark, index_path(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(index_path(path))


def _slot(key: Sequence[str], slots: Column) -> Column:
    return F.xxhash64(*key).bitwiseAND(slots - 1)


def _places(key: Sequence[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(*key, F.lit(k)), F.lit(SLOT_BITS)) for k in range(PROBES)]


def _has(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def add_files(spark: SparkSession, table: DataFrame, path: str, key: Sequence[str], partition: str, parts: Sequence[Any] | None = None) -> None:
    """Index the files of `path` that have no entry yet. `parts` limits the search to some partitions; `table` reads `path`."""
    types = table.schema
    known = read_index(spark, path, table.select(*key).schema, types[partition].dataType).select("file").distinct()
    rows = table if parts is None else table.filter(among(partition, parts))
    part = F.col(partition)
    keyed = rows.select(_file(part, F.col("_metadata.file_name")).alias("file"), part.alias("part"), *key)
    keyed = keyed.join(F.broadcast(known), "file", "left_anti")
    sizes = keyed.groupBy("file", "part").count()  # of metadata alone: no column is read
    need = F.greatest(F.ceil(F.log2(F.col("count") / KEYS_PER_SLOT)), F.lit(0))
    sizes = sizes.withColumn("slots", F.pow(F.lit(2), need).cast("bigint"))
    # A row per file from here on: a number for every slot of every file, so that keys are sorted by one number.
    before = F.sum("slots").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    sizes = F.broadcast(pin(sizes.select("file", "part", "slots", F.coalesce(before, F.lit(0)).alias("_first")), "files"))
    placed = keyed.drop("part").join(sizes, "file").withColumn("_at", F.col("_first") + _slot(key, F.col("slots")))
    whole = F.struct(*key)
    probes = [F.bitmap_construct_agg(place).alias(f"_b{k}") for k, place in enumerate(_places(key))]
    each = placed.groupBy("_at").agg(F.first("file").alias("file"), F.min(whole).alias("low"), F.max(whole).alias("high"), *probes)
    each = each.withColumn("_bits", F.explode(F.array(*[f"_b{k}" for k in range(PROBES)])))
    united = each.groupBy("_at", "file", "low", "high").agg(F.bitmap_or_agg("_bits").alias("bits")).join(sizes, "file")
    found = united.select("file", "part", "low", "high", "slots", (F.col("_at") - F.col("_first")).alias("slot"), "bits")
    found.write.mode("append").parquet(index_path(path))


def candidates(
    spark: SparkSession, table: DataFrame, path: str, keys: DataFrame, key: Sequence[str], partition: str
) -> tuple[list[Any], list[Any]]:
    """Partitions of `path` that may hold one of `keys`, and those of them with files that have no entry.

    One entry per partition comes to the driver.
    """
    kind = table.schema[partition].dataType
    files = live_files(spark, path, partition, kind)
    index = read_index(spark, path, table.select(*key).schema, kind)
    entries = index.groupBy("file").agg(F.max("slots").alias("slots"))
    known = files.join(entries, "file", "left").select("part", "slots").distinct().collect()  # slots are powers of two
    unknown = list(dict.fromkeys(r["part"] for r in known if r["slots"] is None))
    sizes = {r["slots"] for r in known} - {None}
    if not sizes:
        return unknown, unknown
    held = index.join(files.select("file"), "file", "left_semi")
    slots = F.explode(F.array(*[F.lit(n).cast("bigint") for n in sorted(sizes)]))

    def named(held: DataFrame, keys: DataFrame) -> list[Any]:
        asked = keys.select(*key, slots.alias("slots"))
        asked = asked.select("slots", _slot(key, F.col("slots")).alias("slot"), F.struct(*key).alias("_key"), F.array(*_places(key)).alias("_places"))
        found = held.join(asked, ["slots", "slot"]).filter((F.col("_key") >= F.col("low")) & (F.col("_key") <= F.col("high")))
        for k in range(PROBES):
            found = found.filter(_has(F.col("bits"), F.col("_places")[k]))
        return [r[0] for r in found.select("part").distinct().collect()]

    # One key is enough to name a partition: all keys are tested only where the first few named none.
    early = F.pmod(F.xxhash64(*key, F.lit("early")), F.lit(EARLY)) == 0
    hit = [*unknown, *named(held, keys.filter(early))]
    left = {r["part"] for r in known} - set(hit)
    if left:
        hit += named(held.filter(among("part", list(left))), keys.filter(~early))
    return list(dict.fromkeys(hit)), unknown


def among(column: str, values: Sequence[Any]) -> Column:
    """Whether the column has one of the values, of which one may be NULL."""
    hit = F.col(column).isin([v for v in values if v is not None])
    return F.coalesce(hit, F.lit(False)) | F.col(column).isNull() if None in values else hit


def compact(spark: SparkSession, table: DataFrame, path: str, key: Sequence[str], partition: str) -> None:
    """Drop the entries of files that are gone."""
    aside = f"{path}/_keys_next"
    kind = table.schema[partition].dataType
    held = read_index(spark, path, table.select(*key).schema, kind)
    held.join(live_files(spark, path, partition, kind).select("file"), "file", "left_semi").write.mode("overwrite").parquet(aside)
    storage.replace_folder(spark, aside, index_path(path))
