"""Daily sales and inventory queries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.columns import is_blank
from siltstone.operators.joins import asof_carried, asof_version, attach_keys, left_on
from siltstone.operators.merge import merge_actions
from siltstone.operators.quality import acceptance, dq_log, load_log
from siltstone.plans import daily, daily_job, shapes
from siltstone.plans.registry import query
from siltstone.session import pin, scratch_path
from siltstone.sources import tables
from siltstone.sources.tables import observed_write


def raw_sales(spark: SparkSession, d: str) -> DataFrame:
    return shapes.daily_sales_raw(spark, d)


def silver_sales(spark: SparkSession, d: str) -> DataFrame:
    return daily.silver_sales(raw_sales(spark, d), shapes.DAILY_ORDER)


def silver_inventory(spark: SparkSession, d: str) -> DataFrame:
    return daily.silver_inventory(shapes.daily_inventory_raw(spark, d), shapes.DAILY_ORDER)


def known_items(spark: SparkSession, d: str) -> DataFrame:
    """Items that ever came with a name."""
    named = raw_sales(spark, d).filter(~is_blank("item_name") & ~is_blank("item_id"))
    return named.select(F.upper(F.trim("item_id")).alias("item_id")).distinct()


def fact(spark: SparkSession, d: str, day: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(daily fact, item dimension)."""
    sales = pin(silver_sales(spark, d), "silver-daily")
    items = daily.dim_menu_item(sales)
    stores = daily.dim_store(shapes.daily_stores(spark, d))
    return daily.fact_daily_sales(sales, silver_inventory(spark, d), stores, items, day), items


_GATE_SQL = """select business_date, '{rule}' as rule_name, 'bronze' as table_name,
    failed_rows, total_rows, '{threshold}' as threshold,
    failed_rows * 1.0 / total_rows < {limit} as passed from ({counts})"""
_NULL_KEYS = _GATE_SQL.format(
    rule="NULL_BUSINESS_KEYS", threshold="< 2% of rows", limit=0.02,
    counts="""select business_date, count(*) filter (where item_id = '' or store_id = '')
              as failed_rows, count(*) as total_rows from daily_norm group by 1""",
)
_DUPLICATES = _GATE_SQL.format(
    rule="DUPLICATE_KEYS", threshold="< 5% of keys", limit=0.05,
    counts="""select business_date, count(*) filter (where n > 1 and item_id <> '') as failed_rows,
              count(distinct store_id || '|' || item_id) as total_rows
              from (select business_date, store_id, item_id, count(*) as n
                    from daily_norm group by all) group by 1""",
)
_REFERENTIAL = _GATE_SQL.format(
    rule="REFERENTIAL_ITEM_ID", threshold="< 2% of rows", limit=0.02,
    counts="""select business_date, count(*) filter (where item_id <> '' and item_name = ''
              and item_id not in (select item_id from daily_norm where item_name <> ''))
              as failed_rows, count(*) as total_rows from daily_norm group by 1""",
)


@query("silver_sales", "select * from daily_silver")
def sales(spark, d):
    return silver_sales(spark, d)


@query("silver_inventory", "select * from daily_stock")
def inventory(spark, d):
    return silver_inventory(spark, d)


@query("gate_null_keys", _NULL_KEYS)
def null_keys(spark, d):
    return daily.gates(raw_sales(spark, d), known_items(spark, d))[0]


@query("gate_duplicates", _DUPLICATES)
def duplicates(spark, d):
    return daily.gates(raw_sales(spark, d), known_items(spark, d))[1]


@query("gate_referential", _REFERENTIAL)
def referential(spark, d):
    return daily.gates(raw_sales(spark, d), known_items(spark, d))[2]


@query("dq_log", f"{_NULL_KEYS} union all {_DUPLICATES} union all {_REFERENTIAL}")
def log(spark, d):
    metrics = daily.gates_in_one_pass(raw_sales(spark, d), known_items(spark, d))
    return dq_log([metrics]).drop("logged_at")


@query("max_collapse", "select * from items_of_day")
def max_collapse(spark, d):
    return daily.items_of_day(silver_sales(spark, d))


@query(
    "multi_key_left_join",
    """select s.business_date, s.store_id, s.item_id, s.qty_sold, i.waste_qty
       from daily_silver s left join daily_stock i
         on i.business_date = s.business_date and i.store_id = s.store_id and i.item_id = s.item_id""",
)
def multi_key_left_join(spark, d):
    waste = silver_inventory(spark, d).select(*daily.GRAIN, "waste_qty")
    rows = silver_sales(spark, d).select(*daily.GRAIN, "qty_sold")
    return left_on(rows, waste, daily.GRAIN)


@query(
    "asof_version_join",
    """select s.business_date, s.store_id, s.item_id, h.menu_item_key, h.unit_price as version_price
       from daily_silver s join item_hist h on h.item_id = s.item_id
         and s.business_date >= h.valid_from
         and (h.valid_to is null or s.business_date <= h.valid_to)""",
)
def asof(spark, d):
    rows = pin(silver_sales(spark, d), "silver-daily")
    items = daily.dim_menu_item(rows).withColumnRenamed("unit_price", "version_price")
    return asof_version(
        rows.select(*daily.GRAIN), items, ["item_id"], "business_date", ["menu_item_key", "version_price"]
    )


@query(
    "asof_carried_join",
    """select s.business_date, s.store_id, s.item_id, h.menu_item_key, h.unit_price as version_price
       from daily_silver s join item_hist h on h.item_id = s.item_id
         and s.business_date >= h.valid_from
         and (h.valid_to is null or s.business_date <= h.valid_to)""",
)
def asof_sorted(spark, d):
    """The same lookup by one sort of rows and versions together."""
    rows = pin(silver_sales(spark, d), "silver-daily")
    items = daily.dim_menu_item(rows).withColumnRenamed("unit_price", "version_price")
    return asof_carried(
        rows.select(*daily.GRAIN), items, ["item_id"], "business_date", ["menu_item_key", "version_price"]
    )


@query(
    "scd2_daily",
    "select item_id, item_name, category, unit_price, valid_from, valid_to, is_current from item_hist",
)
def scd2_daily(spark, d):
    """All days but the last from the log, the last one merged on top."""
    rows = pin(silver_sales(spark, d), "silver-daily")
    last = F.lit(rows.agg(F.max("business_date")).first()[0]).cast("date")
    before = daily.item_history(rows.filter(F.col("business_date") < last))
    return daily.merge_items(before, rows.filter(F.col("business_date") == last))


@query(
    "rejected_daily",
    """select reject_reason, count(*) as row_count from (
         select case when try_cast(business_date as date) is null then 'BAD_DATE'
                     when trim(item_id) = '' then 'NULL_ITEM' when trim(store_id) = '' then 'NULL_STORE' end
                as reject_reason from daily_sales_raw)
       where reject_reason is not null group by 1
       union all select 'ACCEPTED', count(*) from daily_norm where item_id <> '' and store_id <> ''""",
)
def rejected_daily(spark, d):
    """Every landed row is accepted or set aside with a reason."""
    raw = raw_sales(spark, d)
    kept = daily.normal_grain(raw).filter(~is_blank("item_id") & ~is_blank("store_id"))
    counted = kept.select(F.lit("ACCEPTED").alias("reject_reason")).unionByName(daily.rejected_sales(raw).select("reject_reason"))
    return counted.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


@query("fact_daily_sales", "select * from fact_daily")
def fact_daily_sales(spark, d):
    return fact(spark, d)[0]


@query(
    "revenue_by_version",
    """select f.date_key, h.item_id, h.unit_price as version_price,
              cast(sum(f.gross_sales) as decimal(18,2)) as revenue
       from fact_daily f join item_hist h using (menu_item_key) group by all""",
)
def by_version(spark, d):
    return daily.revenue_by_version(*fact(spark, d))


@query(
    "backfill_range",
    """select date_key, count(*) as fact_rows, cast(sum(gross_sales) as decimal(18,2)) as gross_sales,
              cast(sum(waste_cost) as decimal(18,2)) as waste_cost
       from fact_daily where date_key between 19960101 and 20001231 group by 1""",
)
def backfill_range(spark, d):
    return daily.backfill(
        raw_sales(spark, d),
        shapes.daily_inventory_raw(spark, d),
        daily.dim_store(shapes.daily_stores(spark, d)),
        shapes.DAILY_ORDER,
        "1996-01-01",
        "2000-12-31",
    ).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("gross_sales").cast("decimal(18,2)").alias("gross_sales"),
        F.sum("waste_cost").cast("decimal(18,2)").alias("waste_cost"),
    )


@query(
    "seed_dim",
    """select s.store_key, s.store_id, s.region, count(*) as row_count
       from daily_silver d join daily_stores s using (store_id) group by all""",
)
def seed_dim(spark, d):
    keyed = attach_keys(
        silver_sales(spark, d).groupBy("store_id").agg(F.count(F.lit(1)).alias("row_count")),
        {"store_key": (daily.dim_store(shapes.daily_stores(spark, d)), ["store_id"])},
    )
    return keyed.join(shapes.daily_stores(spark, d), "store_id")


_LOG_DAY = "2000-03-01"


@query(
    "load_log",
    f"""select 'daily' as pipeline_name, date '{_LOG_DAY}' as business_date, step, rows_affected,
               'SUCCESS' as status, cast(null as varchar) as message
        from (select 'silver_sales' as step, count(*) as rows_affected from daily_silver
              where business_date = date '{_LOG_DAY}'
              union all select 'silver_inventory', count(*) from daily_stock
              where business_date = date '{_LOG_DAY}'
              union all select 'fact_daily_sales', count(*) from fact_daily
              where date_key = {_LOG_DAY.replace('-', '')})""",
)
def loads(spark, d):
    at = F.col("business_date") == F.lit(_LOG_DAY).cast("date")

    def write(df: DataFrame, step: str):
        return step, lambda: observed_write(df, scratch_path(spark, step))

    steps = [
        write(silver_sales(spark, d).filter(at), "silver_sales"),
        write(silver_inventory(spark, d).filter(at), "silver_inventory"),
        write(fact(spark, d, _LOG_DAY)[0], "fact_daily_sales"),
    ]
    day = datetime.date.fromisoformat(_LOG_DAY)
    return load_log(spark, "daily", day, steps).drop("logged_at")


@query(
    "acceptance_checks",
    """select check_name, value, value = 0 as passed from (
         select 'blank_items' as check_name, count(*) as value from daily_silver where item_id = ''
         union all
         select 'duplicate_keys', count(*) from (select 1 from daily_silver
           group by business_date, store_id, item_id having count(*) > 1)
         union all
         select 'overlapping_current_versions', count(*) from (select 1 from item_hist
           where is_current group by item_id having count(*) > 1)
         union all
         select 'replay_changes', count(*) from items_of_day t join item_hist h
           on h.item_id = t.item_id and h.is_current
           where t.business_date = (select max(business_date) from daily_silver)
             and (t.unit_price <> h.unit_price or t.category <> h.category
                  or t.item_name <> h.item_name))""",
)
def acceptance_checks(spark, d):
    rows = pin(silver_sales(spark, d), "silver-daily")
    history = pin(daily.item_history(rows), "item-history")
    current = history.filter("is_current")
    last_day = rows.agg(F.max("business_date").alias("business_date"))
    newest = rows.join(F.broadcast(last_day), "business_date", "left_semi")
    actions = merge_actions(
        history, daily.items_of_day(newest), ["item_id"], list(daily.ITEM_ATTRIBUTES)
    )
    return acceptance(
        {
            "blank_items": rows.filter(is_blank("item_id")),
            "duplicate_keys": rows.groupBy(*daily.GRAIN).count().filter("count > 1"),
            "overlapping_current_versions": current.groupBy("item_id").count().filter("count > 1"),
            "replay_changes": actions.filter("merge_action <> 'none'"),
        }
    )


_DAILY_TOTALS = (
    "date_key int, fact_rows bigint, gross_sales decimal(18,2), waste_cost decimal(18,2), items bigint, changed_by_rerun int"
)


@query(
    "daily_pipeline",
    f"""with days as (
          select business_date from ({_NULL_KEYS} union all {_DUPLICATES} union all {_REFERENTIAL})
          group by 1 having bool_and(passed))
        select f.date_key, count(*) as fact_rows, cast(sum(f.gross_sales) as decimal(18,2)) as gross_sales,
               cast(sum(f.waste_cost) as decimal(18,2)) as waste_cost, count(distinct h.item_id) as items,
               0 as changed_by_rerun
        from fact_daily f join item_hist h using (menu_item_key)
        where f.date_key in (select cast(strftime(business_date, '%Y%m%d') as int) from days) group by 1""",
)
def daily_pipeline(spark, d):
    """Every date whose gates hold: a backfill, the last two dates as single jobs, and the last one run again.

    Without such a date there is no table to report on, and no row.
    """
    base = scratch_path(spark, "daily")
    known = pin(known_items(spark, d), "items")
    stores = pin(daily.dim_store(shapes.daily_stores(spark, d)), "stores")
    inputs = pin(raw_sales(spark, d), "raw-sales"), shapes.daily_inventory_raw(spark, d), stores, known, shapes.DAILY_ORDER
    days = daily_job.catch_up(spark, base, *inputs, single=2)
    if not days:
        return spark.createDataFrame([], _DAILY_TOTALS)

    def state():
        items = spark.read.parquet(tables.version_path(f"{base}/dim_item", tables.versions(spark, f"{base}/dim_item")[-1]))
        facts = spark.read.parquet(f"{base}/fact")
        return pin(facts.join(items.select("menu_item_key", "item_id", "valid_from", "valid_to"), "menu_item_key"), "state")

    before = state()
    daily_job.run_day(spark, base, days[-1], *inputs)
    after = state()
    moved = before.exceptAll(after).union(after.exceptAll(before)).groupBy("date_key").count()
    totals = after.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("gross_sales").cast("decimal(18,2)").alias("gross_sales"),
        F.sum("waste_cost").cast("decimal(18,2)").alias("waste_cost"),
        F.countDistinct("item_id").alias("items"),
    )
    joined = totals.join(moved, "date_key", "left")
    return joined.select(*totals.columns, F.coalesce("count", F.lit(0)).cast("int").alias("changed_by_rerun"))
