"""Readers for landed CSV and JSON files. Bronze columns stay text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_FILE = "_source_file"
INGEST_TS = "_ingest_ts"
RESCUED = "_rescued_data"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Enclosed fields double their quotes, as spreadsheet and standard-library writers do.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def read_raw_csv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], multiline: bool = False
) -> DataFrame:
    """CSV with a header row, every column as text, bound in header order.

    Files whose header differs in order or content belong into `read_evolving_csv`. With `multiline`
    enclosed fields may hold line breaks; a file is then read by one task.
    """
    reader = spark.read.options(**CSV_QUOTES).option("header", True).option("recursiveFileLookup", True)
    return reader.option("multiLine", multiline).schema(text_schema(columns)).csv(path)


def read_raw_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """JSON Lines; files are splittable. A line that cannot be read is kept as text in `_rescued_data`.

    Fields that are not in `schema` are passed over; `evolve.rescue` keeps them.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.options(recursiveFileLookup=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RESCUED)
    return reader.schema(T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])).json(path)


def read_raw_json_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str
) -> DataFrame:
    """Files that hold one JSON array each. One task reads one file, so land several files."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True)
    return reader.schema(schema).json(path)


def with_audit(df: DataFrame) -> DataFrame:
    """Load instant and source file of every row."""
    return df.select(
        "*",
        F.current_timestamp().cast("timestamp_ntz").alias(INGEST_TS),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
    )


def copy_into(
    spark: SparkSession, path: str, pattern: str, columns: Sequence[str]
) -> DataFrame:
    """One-off bulk load of the files whose path matches the regular expression.

    Columns are taken by position. The condition on the file path prunes files before any is read.
    """
    rows = read_raw_csv(spark, path, columns)
    return with_audit(rows.filter(F.col("_metadata.file_path").rlike(pattern)))


def csv_dialect(df: DataFrame, null_tokens: Sequence[str] = ("", "NULL")) -> DataFrame:
    """Tokens that stand for a missing value become NULL in every text column."""

    def clean(c: str) -> Column:
        return F.when(~F.col(c).isin(list(null_tokens)), F.col(c)).alias(c)

    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[clean(c) if c in text else F.col(c) for c in df.columns])


def load_history(bronze: DataFrame) -> DataFrame:
    """Rows and last load instant per source file."""
    return bronze.groupBy(SOURCE_FILE).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(INGEST_TS).alias("last_load_time")
    )


def load_day(
    spark: SparkSession,
    root: str,
    feed: str,
    business_date: str,
    columns: Sequence[str],
    template: str = "{feed}_{tag}*",
) -> DataFrame:
    """Files of one business date, found by their yyyyMMdd tag: no other file is listed or read."""
    name = template.format(feed=feed, tag=business_date.replace("-", ""))
    rows = read_raw_csv(spark, f"{root}/{name}", columns)
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def load_range(
    spark: SparkSession,
    path: str,
    start: str,
    end: str,
    columns: Sequence[str],
    tag_pattern: str = r"(\d{8})",
) -> DataFrame:
    """Files of all dates in a range as one frame with a typed `business_day`, for backfills.

    The day comes from the file path alone, so files outside the range are pruned before reading.
    """
    tag = F.regexp_extract(F.col("_metadata.file_path"), tag_pattern, 1)
    day = F.try_to_date(tag, "yyyyMMdd")  # files without a date tag belong to no day
    rows = read_raw_csv(spark, path, columns).select("*", day.alias("business_day"))
    bounds = [F.lit(d).cast("date") for d in (start, end)]
    return rows.filter(F.col("business_day").between(*bounds))
