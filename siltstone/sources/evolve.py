"""Sources whose columns change over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.files import CSV_QUOTES, INGEST_TS, RESCUED, SOURCE_FILE, text_schema, with_audit
from siltstone.sources.headers import files_by_header


def evolve_union(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that a frame lacks are NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_rescued_csv(
    spark: SparkSession, files: str | list[str], header: Sequence[str], multiline: bool = True
) -> DataFrame:
    """CSV files of one header as text columns, with the whole record in `_rescued_data` where it has more or
    fewer fields than the header.

    Fields of such a record are bound from the left. With `multiline` enclosed fields may hold line breaks and
    a file is read by one task; without, files are split, and every line is a record of its own.
    """
    reader = spark.read.options(**CSV_QUOTES, mode="PERMISSIVE", columnNameOfCorruptRecord=RESCUED)
    # With pruning Spark would count only the fields that are asked for.
    reader = reader.options(header=True, columnPruning=False, multiLine=multiline, recursiveFileLookup=True)
    return reader.schema(text_schema([*header, RESCUED])).csv(files)


def with_known(rows: DataFrame, known: Sequence[str] | None) -> DataFrame:
    """Only the `known` columns, NULL where a file lacks them; values of others go to `_rescued_data` as JSON.

    A record that is kept there as a whole stays as it is. Without `known` all columns stay.
    """
    if known is None:
        return rows
    lower = {c.lower(): c for c in known}
    other = [c for c in rows.columns if c.lower() not in lower and c != RESCUED and c not in (INGEST_TS, SOURCE_FILE)]
    have = {c.lower() for c in rows.columns}
    own = [(F.col(c) if c.lower() in have else F.lit(None).cast("string")).alias(c) for c in known]
    extra = F.lit(None).cast("string")
    if other:
        fields = F.to_json(F.struct(*other))
        extra = F.when(F.coalesce(*other).isNotNull(), fields)
    audit = [c for c in rows.columns if c in (INGEST_TS, SOURCE_FILE)]
    return rows.select(*own, F.coalesce(RESCUED, extra).alias(RESCUED), *audit)


def read_by_header(
    spark: SparkSession,
    groups: Mapping[tuple[str, ...], list[str]],
    audit: bool = False,
    known: Sequence[str] | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Each group of files is bound by its own header, then aligned by name; no field is lost."""
    frames = []
    for header, files in groups.items():
        rows = read_rescued_csv(spark, files, header, multiline)
        frames.append(with_known(with_audit(rows) if audit else rows, known))
    return evolve_union(*frames)


def read_evolving_csv(
    spark: SparkSession, path: str, known: Sequence[str] | None = None, multiline: bool = True
) -> DataFrame:
    """CSV files with differing headers below one folder, with `_rescued_data`; see `read_by_header`."""
    return read_by_header(spark, files_by_header(spark, path), known=known, multiline=multiline)


def rescue(
    lines: DataFrame, known: Sequence[str], column: str = "value", array: bool = False
) -> DataFrame:
    """Flat JSON objects to text columns; what does not fit is kept as text in `_rescued_data`.

    Unexpected fields are kept as JSON. A text that is not an object (with `array`: an array of objects)
    gives one row with all columns NULL and the text itself. Blank texts give no row. Works on batch and
    streaming frames. Other columns of `lines` are passed on.
    """
    rest = [c for c in lines.columns if c != column]
    text = F.col(column)
    readable = F.get_json_object(text, "$").isNotNull() & F.trim(text).startswith("[" if array else "{")
    if array:
        parsed = F.when(readable, F.from_json(text, "array<map<string,string>>"))
        whole = F.array(F.lit(None).cast("map<string,string>"))
        rows = lines.select("*", F.explode(F.coalesce(parsed, whole)).alias("_fields"))
    else:
        rows = lines.withColumn("_fields", F.when(readable, F.from_json(text, "map<string,string>")))
    rows = rows.filter(F.col("_fields").isNotNull() | (F.trim(text) != ""))
    unexpected = F.map_filter("_fields", lambda k, v: ~k.isin(list(known)))
    rescued = F.when(F.col("_fields").isNull(), text).when(F.size(unexpected) > 0, F.to_json(unexpected))
    return rows.select(*[F.col("_fields")[k].alias(k) for k in known], rescued.alias(RESCUED), *rest)
