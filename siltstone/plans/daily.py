"""Daily store sales and inventory: gates, silver loads, versioned menu items and the daily fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import amount, calendar_parts, date_key, is_blank, normal_key
from siltstone.functions.predicates import changed_tsql
from siltstone.functions.typing import tolerant
from siltstone.operators.dedupe import latest, max_collapse
from siltstone.operators.joins import asof_version, attach_keys, left_on, mark_known, star_join
from siltstone.operators.keys import dense_key
from siltstone.operators.merge import scd2_apply, scd2_from_log
from siltstone.operators.quality import gate_duplicates, gate_null_keys, gate_referential
from siltstone.operators.sets import calendar_of
from siltstone.session import pin

# Fixed values of the daily model.
GRAIN = ("business_date", "store_id", "item_id")
ITEM_ATTRIBUTES = ("item_name", "category", "unit_price")
NULL_KEY_LIMIT = 0.02
DUPLICATE_LIMIT = 0.05
REFERENTIAL_LIMIT = 0.02

SALES_TYPES = {
    "unit_price": T.DecimalType(8, 2),
    "qty_sold": T.IntegerType(),
    "gross_sales": T.DecimalType(12, 2),
    "txn_count": T.IntegerType(),
}
INVENTORY_COUNTS = ("begin_qty", "received_qty", "sold_qty", "waste_qty", "end_qty")


def with_business_date(raw: DataFrame) -> DataFrame:
    """Typed date next to the raw text, so that later filters compare dates and prune."""
    return raw.withColumn("business_date", tolerant("business_date", T.DateType()))


def normal_grain(raw: DataFrame) -> DataFrame:
    """Typed date, normalised store and item; rows without a readable date are in `rejected_sales`."""
    keyed = with_business_date(raw).withColumns(
        {"store_id": normal_key("store_id"), "item_id": normal_key("item_id")}
    )
    return keyed.filter(F.col("business_date").isNotNull())


def silver_sales(raw: DataFrame, order: tuple[str | Column, ...]) -> DataFrame:
    """Typed sales, one row per date, store and item.

    The newest row decides: when its quantity or price is unreadable the key is left out, without
    falling back to an older row.
    """
    rows = normal_grain(raw).filter(~is_blank("item_id") & ~is_blank("store_id"))
    newest = latest(rows, GRAIN, order)
    typed = newest.select(
        *GRAIN,
        "item_name",
        "category",
        *[tolerant(c, t).alias(c) for c, t in SALES_TYPES.items()],
    )
    return typed.filter(F.col("qty_sold").isNotNull() & F.col("unit_price").isNotNull())


def rejected_sales(raw: DataFrame) -> DataFrame:
    """Rows that cannot reach silver, with the reason."""
    dated = tolerant("business_date", T.DateType())
    reason = (
        F.when(dated.isNull(), "BAD_DATE")
        .when(is_blank("item_id"), "NULL_ITEM")
        .when(is_blank("store_id"), "NULL_STORE")
    )
    return raw.withColumn("reject_reason", reason).filter("reject_reason IS NOT NULL")


def silver_inventory(raw: DataFrame, order: tuple[str | Column, ...]) -> DataFrame:
    rows = normal_grain(raw).filter(~is_blank("item_id") & ~is_blank("store_id"))
    newest = latest(rows, GRAIN, order)
    return newest.select(*GRAIN, *[tolerant(c, T.IntegerType()).alias(c) for c in INVENTORY_COUNTS])


def gates(raw: DataFrame, items: DataFrame, by: tuple[str, ...] = ("business_date",)) -> list[DataFrame]:
    """Metrics of the three bronze gates per business date."""
    rows = normal_grain(raw)
    return [
        gate_null_keys(rows, ["item_id", "store_id"], NULL_KEY_LIMIT, by),
        gate_duplicates(rows, ["store_id", "item_id"], "item_id", DUPLICATE_LIMIT, by),
        gate_referential(rows, items, "item_id", "item_name", REFERENTIAL_LIMIT, by),
    ]


def gates_in_one_pass(raw: DataFrame, items: DataFrame) -> DataFrame:
    """The metrics of `gates` from a single scan: rows are counted once per date, store and item, the
    few counted keys are looked up, and all three rules read the same counts."""
    blank_item, blank_store = is_blank("item_id"), is_blank("store_id")
    normal = {c: F.coalesce(F.col(c), F.lit("")) for c in ("store_id", "item_id")}
    per_key = (
        normal_grain(raw)
        .withColumns(normal)
        .groupBy(*GRAIN)
        .agg(F.count(F.lit(1)).alias("copies"), F.count_if(is_blank("item_name")).alias("nameless"))
    )
    marked = mark_known(per_key, items, ["item_id"], "_known")

    def total(condition: Column, value: str) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0))

    counts = marked.groupBy("business_date").agg(
        F.sum("copies").alias("total_rows"),
        F.count(F.lit(1)).alias("total_keys"),
        total(blank_item | blank_store, "copies").alias("null_keys"),
        F.count_if((F.col("copies") > 1) & ~blank_item).alias("duplicates"),
        total(~blank_item & ~F.col("_known"), "nameless").alias("unresolved"),
    )
    rules = (
        ("NULL_BUSINESS_KEYS", "null_keys", "total_rows", NULL_KEY_LIMIT, "rows"),
        ("DUPLICATE_KEYS", "duplicates", "total_keys", DUPLICATE_LIMIT, "keys"),
        ("REFERENTIAL_ITEM_ID", "unresolved", "total_rows", REFERENTIAL_LIMIT, "rows"),
    )
    lines = [
        F.struct(
            F.lit(rule).alias("rule_name"),
            F.lit("bronze").alias("table_name"),
            F.col(failed).cast("bigint").alias("failed_rows"),
            F.col(of).cast("bigint").alias("total_rows"),
            F.lit(f"< {limit:.0%} of {unit}").alias("threshold"),
            (F.col(failed) / F.col(of) < limit).alias("passed"),
        )
        for rule, failed, of, limit, unit in rules
    ]
    return counts.select("business_date", F.explode(F.array(*lines)).alias("m")).select(
        "business_date", "m.*"
    )


def items_of_day(sales: DataFrame) -> DataFrame:
    """One row per date and item, each attribute at its maximum."""
    return max_collapse(sales, ["business_date", "item_id"], ITEM_ATTRIBUTES)


def merge_items(dim: DataFrame, sales_of_day: DataFrame, surrogate: str | None = None) -> DataFrame:
    """Apply one business date to the item dimension; versions are closed days."""
    return scd2_apply(
        dim,
        items_of_day(sales_of_day),
        ["item_id"],
        changed_tsql("unit_price", ["category", "item_name"]),
        "business_date",
        interval="closed_day",
        surrogate=surrogate,
    )


def item_history(sales: DataFrame) -> DataFrame:
    """All item versions from all dates at once, for a backfill of any length."""
    blank_is_null = [F.coalesce(F.col(c), F.lit("")) for c in ("category", "item_name")]
    daily = items_of_day(sales).withColumn("_batch", F.col("business_date"))
    versions = scd2_from_log(
        daily,
        ["item_id"],
        [F.col("unit_price"), *blank_is_null],
        "business_date",
        "_batch",
        interval="closed_day",
    )
    return versions.drop("_batch")


def dim_menu_item(sales: DataFrame) -> DataFrame:
    return dense_key(item_history(sales), ["item_id", "valid_from"], "menu_item_key")


def seed_dim(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Reference dimension: the rows given, numbered in the order of their natural key."""
    return dense_key(rows, [key], name)


def dim_store(stores: DataFrame) -> DataFrame:
    return seed_dim(stores, "store_id", "store_key")


def dim_date(sales: DataFrame) -> DataFrame:
    days = calendar_parts(calendar_of(sales, "business_date"), "cal_date")
    return days.select("date_key", "cal_date", "day_name", "week_of_year", "month", "is_weekend")


def fact_daily_sales(
    sales: DataFrame,
    inventory: DataFrame,
    stores: DataFrame,
    items: DataFrame,
    day: str | None = None,
) -> DataFrame:
    """Sales with the item version valid that day and the waste of the same store and item.

    Rows of unknown stores or items are dropped; `joins.unmatched` lists them. `day` restricts the load to one business date and
    reaches the scans.
    """
    if day is not None:
        at = F.lit(day).cast("date")
        sales = sales.filter(F.col("business_date") == at)
        inventory = inventory.filter(F.col("business_date") == at)
    waste = inventory.select(*GRAIN, "waste_qty")
    rows = left_on(sales, waste, GRAIN)
    keyed = attach_keys(rows, {"store_key": (stores, ["store_id"])})
    versioned = asof_version(keyed, items, ["item_id"], "business_date", ["menu_item_key"])
    return versioned.select(
        date_key("business_date").alias("date_key"),
        "store_key",
        "menu_item_key",
        "qty_sold",
        "gross_sales",
        "txn_count",
        "waste_qty",
        amount("waste_qty", "unit_price", 12, 2).alias("waste_cost"),
    )


def backfill(
    raw_sales: DataFrame,
    raw_inventory: DataFrame,
    stores: DataFrame,
    order: tuple[str | Column, ...],
    start: str,
    end: str,
) -> DataFrame:
    """Daily facts of a whole date range in one set-based run.

    Dates are independent in silver and in the fact. Only the item versions depend on earlier dates,
    and they come from the full log at once, so no date has to wait for the one before.
    """
    bounds = [F.lit(d).cast("date") for d in (start, end)]
    sales = pin(silver_sales(raw_sales, order), "silver-daily")
    items = dim_menu_item(sales)
    wanted = sales.filter(F.col("business_date").between(*bounds))
    counted = with_business_date(raw_inventory).filter(F.col("business_date").between(*bounds))
    return fact_daily_sales(wanted, silver_inventory(counted, order), stores, items)


def revenue_by_version(fact: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per date and item version, with the version's own price."""
    sums = fact.groupBy("date_key", "menu_item_key").agg(F.sum("gross_sales").alias("gross_sales"))
    versions = items.select("menu_item_key", "item_id", F.col("unit_price").alias("version_price"))
    joined = star_join(sums, {"menu_item_key": versions})
    return joined.groupBy("date_key", "item_id", "version_price").agg(
        F.sum("gross_sales").cast("decimal(18,2)").alias("revenue")
    )
