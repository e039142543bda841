"""Counts, sums, top-k and calendars over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import aggregates as A
from siltstone.operators.sets import calendar_of, first_n, top_k
from siltstone.plans import shapes
from siltstone.plans.registry import query
from siltstone.session import pin


@query(
    "row_counts",
    """select o_orderstatus, count(*) as row_count, 'group' as scope from orders group by 1
       union all select null, count(*), 'all' from orders""",
)
def row_counts(spark, d):
    return A.row_counts(shapes.table(spark, d, "orders"), ["o_orderstatus"])


@query(
    "grouped_revenue",
    """select l_returnflag, l_linestatus, cast(sum(cast(l_extendedprice as decimal(18,2)))
              as decimal(18,2)) as revenue from lineitem group by all""",
)
def grouped_revenue(spark, d):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return A.revenue(shapes.table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], price)


@query(
    "duplicate_keys",
    """select l_orderkey, l_linenumber, count(*) as copies from lineitem
       group by all having count(*) > 1""",
)
def duplicate_keys(spark, d):
    return A.duplicate_keys(shapes.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "distinct_composite",
    """select l_returnflag, count(distinct l_orderkey || '|' || l_linenumber) as order_lines
       from lineitem group by 1""",
)
def distinct_composite(spark, d):
    rows = shapes.table(spark, d, "lineitem").select(
        "l_returnflag", F.col("l_orderkey").cast("string").alias("o"),
        F.col("l_linenumber").cast("string").alias("n"),
    )
    return rows.groupBy("l_returnflag").agg(
        A.distinct_composite(rows, ["o", "n"]).alias("order_lines")
    )


@query(
    "failure_rate",
    """select user_id, count(*) filter (where event_type = 'error') * 1.0 / count(*) as error_rate
       from events group by 1""",
)
def failure_rate(spark, d):
    return shapes.table(spark, d, "events").groupBy("user_id").agg(
        A.rate(F.col("event_type") == "error").alias("error_rate")
    )


@query(
    "usage_rollup",
    """select event_type, cast(sum(cast(value as decimal(18,2))) as decimal(18,2)) as total_value,
              count(distinct date_trunc('hour', ts)) as active_hours
       from events where ts >= timestamp '2024-01-31 00:00:00' - interval 7 day group by 1""",
)
def usage_rollup(spark, d):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    value = F.col("value").cast("decimal(18,2)")
    return A.usage_rollup(shapes.table(spark, d, "events"), ["event_type"], "ts", value, now, 7)


@query(
    "top_k",
    """select o_orderkey, o_custkey, cast(o_totalprice as decimal(18,2)) as total from orders
       order by total desc, o_orderkey limit 10""",
)
def largest_orders(spark, d):
    rows = shapes.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    )
    return top_k(rows, "total", 10, ["o_orderkey"])


@query(
    "ordered_limit",
    """select cast(o_orderdate as date) as order_date, o_orderstatus, count(*) as orders
       from orders group by all order by order_date, o_orderstatus limit 20""",
)
def ordered_limit(spark, d):
    rows = shapes.table(spark, d, "orders").groupBy(
        F.to_date("o_orderdate").alias("order_date"), "o_orderstatus"
    ).agg(F.count(F.lit(1)).alias("orders"))
    return first_n(rows, ["order_date", "o_orderstatus"], 20)


@query(
    "calendar",
    """select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as cal_date
       from (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi
             from orders)""",
)
def calendar(spark, d):
    return calendar_of(shapes.table(spark, d, "orders"), "o_orderdate")


@query(
    "distinct_rollup",
    """select event_type, cast(date_trunc('month', ts) as date) as month_start, count(distinct user_id) as users
       from events group by all
       union all select event_type, null, count(distinct user_id) from events group by 1""",
)
def distinct_rollup(spark, d):
    """Users per day as bitmaps; months and the whole range are joined from the days."""
    events = shapes.table(spark, d, "events").withColumn("day", F.to_date("ts"))
    days = pin(A.distinct_bitmaps(events, ["event_type", "day"], "user_id"), "user-days")
    months = days.withColumn("month_start", F.trunc("day", "month"))
    ever = A.distinct_from(days, ["event_type"], "users").withColumn("month_start", F.lit(None).cast("date"))
    return A.distinct_from(months, ["event_type", "month_start"], "users").unionByName(ever)
