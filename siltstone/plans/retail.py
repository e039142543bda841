"""Point-of-sale, clickstream and product feeds: bronze to silver to a star schema and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import (
    amount,
    blank_as_null,
    calendar_parts,
    date_key,
    money,
    normal_key,
    weekend,
)
from siltstone.functions.typing import tolerant
from siltstone.operators.dedupe import latest
from siltstone.operators.joins import attach_keys, join_aggregates, mark_known, star_join
from siltstone.operators.keys import dense_key
from siltstone.operators.quality import reject_reason
from siltstone.operators.sets import calendar_of, top_k

# Fixed values of the retail model.
SALES_KEY = ("store_id", "txn_id", "line_id")
LAST_EAST_STORE = "S010"
VIEW_EVENT = "product_view"

SALES_TYPES = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("txn_id", T.StringType()),
        T.StructField("line_id", T.IntegerType()),
        T.StructField("txn_ts", T.TimestampNTZType()),
        T.StructField("sku", T.StringType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("payment_type", T.StringType()),
        T.StructField("loyalty_id", T.StringType()),
    ]
)


def typed_sales(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Bronze sales with declared types. `carry` are typed columns to pass on, such as tie-breaks."""
    typed = raw.select(
        *[tolerant(f.name, f.dataType).alias(f.name) for f in SALES_TYPES.fields], *carry
    )
    return typed.withColumns(
        {"sku": blank_as_null(normal_key("sku")), "loyalty_id": blank_as_null("loyalty_id")}
    )


def deduped_sales(raw: DataFrame, order: tuple[str | Column, ...], carry: tuple[str, ...]) -> DataFrame:
    """Latest row per sales line; `order` is total within a line."""
    return latest(typed_sales(raw, carry), SALES_KEY, order)


def flagged_sales(deduped: DataFrame, products: DataFrame) -> DataFrame:
    """Every line once, with the first reject reason that applies."""
    marked = mark_known(deduped, products, ["sku"], "_known")
    quantity = F.col("qty")
    rules = [
        ("NULL_SKU", F.col("sku").isNull()),
        ("BAD_QTY", quantity.isNull() | (quantity <= 0)),
        ("UNKNOWN_SKU", ~F.col("_known")),
    ]
    return reject_reason(marked, rules).drop("_known")


def silver_products(raw: DataFrame) -> DataFrame:
    """Latest product per SKU, typed."""
    typed = raw.select(
        normal_key("sku").alias("sku"),
        "name",
        "category",
        "brand",
        tolerant("list_price", T.DecimalType(10, 2)).alias("list_price"),
        "updated_at",
    )
    changed = F.col("updated_at").try_cast("timestamp_ntz").desc_nulls_last()
    return latest(typed, ["sku"], [changed, "name", "brand", "category", "list_price", "updated_at"])


def silver_clicks(raw: DataFrame) -> DataFrame:
    """One row per event, typed."""
    typed = raw.select(
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        normal_key("sku").alias("sku"),
        F.col("event_ts").try_cast("timestamp_ntz").alias("event_ts"),
        "device",
        "_ingest_ts",
    )
    order = ["_ingest_ts", "event_ts", "user_id", "event_type", "device", "session_id", "sku"]
    return latest(typed, ["event_id"], order)


def dim_product(products: DataFrame) -> DataFrame:
    rows = products.select("sku", "name", "category", "brand", "list_price")
    return dense_key(rows, ["sku"], "product_key")


def dim_store(sales: DataFrame) -> DataFrame:
    east = F.col("store_id") <= LAST_EAST_STORE
    stores = sales.select("store_id").distinct()
    regions = stores.withColumn("region", F.when(east, "East").otherwise("West"))
    return dense_key(regions, ["store_id"], "store_key")


def dim_date(df: DataFrame, column: str) -> DataFrame:
    """Calendar over the dates of the data, so that no fact falls outside it."""
    days = calendar_parts(calendar_of(df, column), "cal_date")
    return days.select(
        "date_key", "cal_date", "day_of_week", "day_name", "week_of_year", "month", "is_weekend"
    )


def fact_sales(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    keyed = attach_keys(
        sales, {"product_key": (products, ["sku"]), "store_key": (stores, ["store_id"])}
    )
    return keyed.select(
        date_key("txn_ts").alias("date_key"),
        "product_key",
        "store_key",
        "txn_id",
        "line_id",
        "txn_ts",
        "qty",
        "unit_price",
        amount("qty", "unit_price").alias("line_amount"),
        "payment_type",
        "loyalty_id",
    )


def fact_clickstream_daily(clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Events, users and sessions per day, product, event type and device.

    Counted on the natural key and resolved to the surrogate afterwards: the lookup then joins the
    few aggregated rows. Both keys are unique in the dimension, so the groups are the same.
    """
    daily = (
        clicks.withColumn("date_key", date_key("event_ts"))
        .groupBy("date_key", "sku", "event_type", "device")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("user_id").alias("unique_users"),
            F.countDistinct("session_id").alias("sessions"),
        )
    )
    keyed = attach_keys(daily, {"product_key": (products, ["sku"])})
    return keyed.select(
        "date_key", "product_key", "event_type", "device", "events", "unique_users", "sessions"
    )


Star = Mapping[str, DataFrame]


def _sales_by(star: Star, *keys: str) -> DataFrame:
    """Fact summed to the keys a report needs, before any dimension is joined."""
    return star["fact_sales"].groupBy(*keys).agg(F.sum("line_amount").alias("line_amount"))


def daily_revenue_by_category(star: Star) -> DataFrame:
    products = star["dim_product"].select("product_key", "category")
    dates = star["dim_date"].select("date_key", "cal_date")
    sales = _sales_by(star, "date_key", "product_key")
    joined = star_join(sales, {"product_key": products, "date_key": dates})
    report = joined.groupBy("cal_date", "category").agg(money(F.sum("line_amount")).alias("revenue"))
    return report.orderBy("cal_date", "category")


def top_products_with_views(star: Star, k: int = 10) -> DataFrame:
    """Products with the highest revenue, with their views where there are any."""
    sales = _sales_by(star, "product_key").select(
        "product_key", money("line_amount").alias("revenue")
    )
    # The k best are known from revenue alone; k rows are safe to broadcast, so only their clicks are
    # summed and only their names are looked up.
    best = top_k(sales, "revenue", k, ["product_key"])
    views = (
        star["fact_clickstream_daily"]
        .filter(F.col("event_type") == VIEW_EVENT)
        .join(F.broadcast(best.select("product_key")), "product_key", "left_semi")
        .groupBy("product_key")
        .agg(F.sum("events").cast("bigint").alias("product_views"))
    )
    products = star["dim_product"].select("product_key", "name", "category")
    named = join_aggregates(products.join(F.broadcast(best), "product_key"), views, ["product_key"])
    return named.select("product_key", "name", "category", "revenue", "product_views").orderBy(
        F.desc("revenue"), "product_key"
    )


def weekend_mix_by_region(star: Star) -> DataFrame:
    stores = star["dim_store"].select("store_key", "region")
    day_type = F.when(weekend("cal_date"), "weekend").otherwise("weekday")
    dates = star["dim_date"].select("date_key", day_type.alias("day_type"))
    sales = _sales_by(star, "date_key", "store_key")
    joined = star_join(sales, {"store_key": stores, "date_key": dates})
    report = joined.groupBy("region", "day_type").agg(money(F.sum("line_amount")).alias("revenue"))
    return report.orderBy("region", "day_type")
