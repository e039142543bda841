"""The retail pipeline as three jobs over landed files: bronze, silver, gold.

Every layer is a set of Parquet tables below `base`; a job reads only the tables of the layer before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.layout import zorder_dense
from siltstone.operators.quality import DataQualityError
from siltstone.plans import retail
from siltstone.session import scratch
from siltstone.sources import tables
from siltstone.sources.evolve import RESCUED
from siltstone.sources.files import INGEST_TS, SOURCE_FILE
from siltstone.streaming.ingest import ingest_evolving_csv, ingest_rescued

NULL_SKU_LIMIT = 0.02
CLICK_COLUMNS = ["event_id", "user_id", "session_id", "event_type", "sku", "event_ts", "device"]
PRODUCT_COLUMNS = ["sku", "name", "category", "brand", "list_price", "updated_at"]
# Rows of one load carry one load time; the source file and the content decide between copies.
SALES_ORDER = (INGEST_TS, SOURCE_FILE, "txn_ts", "sku", "qty", "unit_price", "payment_type", "loyalty_id")


def bronze(spark: SparkSession, landing: str, base: str) -> None:
    """Ingest new files of the three feeds. A rerun adds only what arrived since.

    New sales columns are added; sales records that do not fit their header, new fields of clicks and products,
    and lines that cannot be read, are kept in `_rescued_data` (see `rescued`).
    """
    ingest_evolving_csv(spark, f"{landing}/pos", f"{base}/bronze/pos", f"{base}/chk/pos")
    ingest_rescued(spark, f"{landing}/clicks", f"{base}/bronze/clicks", f"{base}/chk/clicks", CLICK_COLUMNS)
    ingest_rescued(
        spark, f"{landing}/products", f"{base}/bronze/products", f"{base}/chk/products", PRODUCT_COLUMNS, array=True
    )


def rescued(spark: SparkSession, base: str) -> DataFrame:
    """(feed, unreadable, row_count): bronze rows that carry something no column holds."""
    parts = []
    for feed, key in (("pos", "txn_id"), ("clicks", "event_id"), ("products", "sku")):
        bronze = spark.read.option("mergeSchema", True).parquet(f"{base}/bronze/{feed}")
        rows = bronze.filter(F.col(RESCUED).isNotNull())
        parts.append(rows.select(F.lit(feed).alias("feed"), F.col(key).isNull().alias("unreadable")))
    return reduce(DataFrame.union, parts).groupBy("feed", "unreadable").agg(F.count(F.lit(1)).alias("row_count"))


def _read_rows(spark: SparkSession, base: str, feed: str, key: str) -> DataFrame:
    """Bronze rows without those that are nothing but unreadable text."""
    rows = spark.read.parquet(f"{base}/bronze/{feed}")
    return rows.filter(F.col(key).isNotNull() | F.col(RESCUED).isNull())


def silver(spark: SparkSession, base: str) -> dict[str, int]:
    """Typed, deduplicated and checked tables; returns the row counts of the sales load.

    Clean and rejected sales are written in one pass, as two partitions of one table. The null-SKU
    gate is measured by that same pass and the table is published only if it holds.
    """
    products = retail.silver_products(_read_rows(spark, base, "products", "sku"))
    tables.write_overwrite(products, f"{base}/silver/products")

    raw = spark.read.option("mergeSchema", True).parquet(f"{base}/bronze/pos")
    if "loyalty_id" not in raw.columns:
        raw = raw.withColumn("loyalty_id", F.lit(None).cast("string"))
    deduped = retail.deduped_sales(raw, SALES_ORDER, (INGEST_TS, SOURCE_FILE))
    measured = Observation()
    deduped = deduped.observe(
        measured,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("sku").isNull()).alias("null_sku"),
    )
    known = tables.read_current(spark, f"{base}/silver/products")
    flagged = retail.flagged_sales(deduped, known)
    side = F.when(F.col("reject_reason").isNull(), "clean").otherwise("quarantine")
    path = tables.write_unpublished(
        flagged.withColumn("side", side), f"{base}/silver/sales", ["side"]
    )
    counts = measured.get
    if not counts["rows"] or counts["null_sku"] / counts["rows"] >= NULL_SKU_LIMIT:
        raise DataQualityError(f"null SKU in {counts['null_sku']} of {counts['rows']} sales lines")
    tables.publish(spark, path)

    clicks = retail.silver_clicks(_read_rows(spark, base, "clicks", "event_id"))
    tables.write_overwrite(clicks, f"{base}/silver/clicks")
    return counts


def clean_sales(spark: SparkSession, base: str) -> DataFrame:
    rows = tables.read_current(spark, f"{base}/silver/sales")
    return rows.filter(F.col("side") == "clean").drop("side", "reject_reason")


def quarantined_sales(spark: SparkSession, base: str) -> DataFrame:
    rows = tables.read_current(spark, f"{base}/silver/sales")
    return rows.filter(F.col("side") == "quarantine").drop("side")


# A partition of the fact should hold at least this many rows; with fewer, partitions are months instead of days.
ROWS_PER_DAY = 200_000
_MONTH = "month_key"


def month_of(key: str = "date_key") -> Column:
    return (F.col(key) / 100).cast("int").alias(_MONTH)


def by_grain(fact: DataFrame, grain: str) -> tuple[DataFrame, str]:
    """The fact with its partition column, and the name of that column."""
    return (fact, "date_key") if grain == "day" else (fact.withColumn(_MONTH, month_of()), _MONTH)


def gold(spark: SparkSession, base: str, grain: str | None = None) -> None:
    """Dimensions and facts. Facts are partitioned by date (`grain` "day") or by month, and lie in Morton order of
    their dense product and store keys inside a partition.

    Without `grain` it follows from the rows per date. Each fact is computed and written in one pass: the
    layout needs no look at the data, as the keys are dense.
    """
    with scratch(spark, "gold"):
        _gold(spark, base, grain)


def _gold(spark: SparkSession, base: str, grain: str | None) -> None:
    sales = clean_sales(spark, base)
    products = retail.dim_product(tables.read_current(spark, f"{base}/silver/products"))
    tables.write_overwrite(products, f"{base}/gold/dim_product")
    tables.write_overwrite(retail.dim_store(sales), f"{base}/gold/dim_store")
    dates = retail.dim_date(sales, "txn_ts").withColumn(_MONTH, month_of())
    tables.write_overwrite(dates, f"{base}/gold/dim_date")
    products, stores, dates = (tables.read_current(spark, f"{base}/gold/{n}") for n in ("dim_product", "dim_store", "dim_date"))

    keys = {"product_key": products.count(), "store_key": stores.count()}
    if grain is None:
        grain = "day" if sales.count() >= ROWS_PER_DAY * max(dates.count(), 1) else "month"
    fact, part = by_grain(retail.fact_sales(sales, products, stores), grain)
    laid_out = zorder_dense(fact, keys, within=[part])
    laid_out.write.mode("overwrite").partitionBy(part).parquet(f"{base}/gold/fact_sales")

    clicks = tables.read_current(spark, f"{base}/silver/clicks")
    daily, part = by_grain(retail.fact_clickstream_daily(clicks, products), grain)
    laid_out = zorder_dense(daily, {"product_key": keys["product_key"]}, within=[part], cells=8)
    laid_out.write.mode("overwrite").partitionBy(part).parquet(f"{base}/gold/fact_clickstream_daily")


def within_dates(fact: DataFrame, low: int, high: int) -> DataFrame:
    """Rows of the date keys `low` to `high`; partitions of other dates or months are not opened."""
    rows = fact.filter(F.col("date_key").between(low, high))
    return rows.filter(F.col(_MONTH).between(low // 100, high // 100)) if _MONTH in fact.columns else rows


def on_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of the dates in `dates` (any filter of the date dimension), which prunes partitions at run time."""
    on = [c for c in ("date_key", _MONTH) if c in fact.columns]
    return fact.join(dates.select(*on), on, "left_semi")


def read_star(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    star = {
        name: tables.read_current(spark, f"{base}/gold/{name}")
        for name in ("dim_product", "dim_store", "dim_date")
    }
    for name in ("fact_sales", "fact_clickstream_daily"):
        star[name] = spark.read.parquet(f"{base}/gold/{name}")
    return star
