"""Point-of-sale, clickstream and product queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.joins import mark_known
from siltstone.operators.quality import dedupe_removed, gate_null_rate, quarantine_summary, split_quarantine
from siltstone.plans import retail, shapes
from siltstone.plans.registry import query
from siltstone.session import pin


def deduped(spark: SparkSession, d: str) -> DataFrame:
    return retail.deduped_sales(shapes.pos_raw(spark, d), shapes.SALES_ORDER, shapes.SALES_ORDER)


def products(spark: SparkSession, d: str) -> DataFrame:
    return retail.silver_products(shapes.products_raw(spark, d))


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return retail.flagged_sales(deduped(spark, d), products(spark, d)).drop(*shapes.SALES_ORDER)


def clean(spark: SparkSession, d: str) -> DataFrame:
    return split_quarantine(flagged(spark, d))[0]


def clicks(spark: SparkSession, d: str) -> DataFrame:
    return retail.silver_clicks(shapes.clicks_raw(spark, d))


def star(spark: SparkSession, d: str, *names: str) -> dict[str, DataFrame]:
    """The gold tables a report needs. Silver is written once, as every layer of the pipeline is."""
    sales = pin(clean(spark, d), "silver-sales")
    products_table = pin(products(spark, d), "silver-products")
    tables: dict[str, DataFrame] = {}
    if "dim_product" in names or "fact_sales" in names or "fact_clickstream_daily" in names:
        tables["dim_product"] = retail.dim_product(products_table)
    if "dim_store" in names or "fact_sales" in names:
        tables["dim_store"] = retail.dim_store(sales)
    if "dim_date" in names:
        tables["dim_date"] = retail.dim_date(sales, "txn_ts")
    if "fact_sales" in names:
        tables["fact_sales"] = retail.fact_sales(sales, tables["dim_product"], tables["dim_store"])
    if "fact_clickstream_daily" in names:
        tables["fact_clickstream_daily"] = retail.fact_clickstream_daily(
            clicks(spark, d), tables["dim_product"]
        )
    return tables


_SALES_SQL = """select store_id, txn_id, line_id, txn_ts, sku, qty, unit_price, payment_type, loyalty_id"""


@query("dedupe_latest", f"{_SALES_SQL} from pos_deduped")
def dedupe_latest(spark, d):
    return deduped(spark, d).drop(*shapes.SALES_ORDER)


@query("reject_reasons", f"{_SALES_SQL}, reject_reason from pos_flagged")
def reject_reasons(spark, d):
    return flagged(spark, d).select(*retail.SALES_TYPES.names, "reject_reason")


@query(
    "quarantine_split",
    """select 'clean' as side, count(*) as row_count, sum(qty) as qty from pos_clean
       union all
       select 'quarantine', count(*), sum(qty) from pos_flagged where reject_reason is not null""",
)
def quarantine_split(spark, d):
    rows = flagged(spark, d)
    good, bad = split_quarantine(rows)
    sides = good.select(F.lit("clean").alias("side"), "qty").unionByName(
        bad.select(F.lit("quarantine").alias("side"), "qty")
    )
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("qty")
    )


@query(
    "quarantine_summary",
    """select reject_reason, count(*) as rejected_rows from pos_flagged
       where reject_reason is not null group by 1""",
)
def quarantine(spark, d):
    return quarantine_summary(split_quarantine(flagged(spark, d))[1])


@query(
    "ri_flag",
    """select d.store_id, d.txn_id, d.line_id, d.sku, p.sku is not null as known
       from pos_deduped d left join products p on p.sku = d.sku""",
)
def ri_flag(spark, d):
    marked = mark_known(deduped(spark, d), products(spark, d), ["sku"], "known")
    return marked.select("store_id", "txn_id", "line_id", "sku", "known")


@query(
    "dedupe_removed",
    """select (select count(*) from pos_raw) as rows_before, (select count(*) from pos_deduped)
       as rows_after, (select count(*) from pos_raw) - (select count(*) from pos_deduped)
       as rows_removed""",
)
def removed(spark, d):
    return dedupe_removed(retail.typed_sales(shapes.pos_raw(spark, d)), retail.SALES_KEY)


@query(
    "gate_null_rate",
    """select 'NULL_SKU' as rule_name, 'silver.sales' as table_name,
              count(*) filter (where sku is null) as failed_rows, count(*) as total_rows,
              '< 2% of rows' as threshold,
              count(*) filter (where sku is null) * 1.0 / count(*) < 0.02 as passed
       from pos_deduped""",
)
def null_rate(spark, d):
    return gate_null_rate(deduped(spark, d), "sku", table="silver.sales")


@query("dim_product", "select * from dim_product")
def dim_product(spark, d):
    return retail.dim_product(products(spark, d))


@query("dim_store", "select * from dim_store")
def dim_store(spark, d):
    return retail.dim_store(clean(spark, d))


@query("dim_date", "select * from dim_date")
def dim_date(spark, d):
    return retail.dim_date(clean(spark, d), "txn_ts")


@query("star_fact_build", "select * from fact_sales")
def star_fact_build(spark, d):
    return star(spark, d, "fact_sales")["fact_sales"]


@query("clickstream_daily", "select * from fact_clicks")
def clickstream_daily(spark, d):
    dimension = retail.dim_product(products(spark, d))
    return retail.fact_clickstream_daily(clicks(spark, d), dimension)


@query(
    "q1_daily_revenue_by_category",
    """select d.cal_date, p.category, cast(sum(f.line_amount) as decimal(18,2)) as revenue
       from fact_sales f join dim_product p using (product_key) join dim_date d using (date_key)
       group by all""",
)
def q1(spark, d):
    return retail.daily_revenue_by_category(
        star(spark, d, "dim_product", "dim_date", "fact_sales")
    )


@query(
    "q2_top_products_with_views",
    """select product_key, name, category, revenue, product_views
       from (select product_key, cast(sum(line_amount) as decimal(18,2)) as revenue
             from fact_sales group by 1)
       join dim_product using (product_key)
       left join (select product_key, cast(sum(events) as bigint) as product_views from fact_clicks
                  where event_type = 'product_view' group by 1) using (product_key)
       order by revenue desc, product_key limit 10""",
)
def q2(spark, d):
    return retail.top_products_with_views(
        star(spark, d, "dim_product", "fact_sales", "fact_clickstream_daily")
    )


@query(
    "q3_weekend_mix_by_region",
    """select s.region, case when d.day_of_week in (1, 7) then 'weekend' else 'weekday' end
              as day_type, cast(sum(f.line_amount) as decimal(18,2)) as revenue
       from fact_sales f join dim_store s using (store_key) join dim_date d using (date_key)
       group by all""",
)
def q3(spark, d):
    return retail.weekend_mix_by_region(star(spark, d, "dim_store", "dim_date", "fact_sales"))
