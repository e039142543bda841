"""Casting, scalar columns, predicates and masking."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import columns as C
from siltstone.functions.masking import mask_email, mask_phone, masked_view
from siltstone.functions.predicates import changed, changed_tsql, on_day
from siltstone.functions.typing import cast_to, try_cast_to
from siltstone.plans import daily, orders, shapes
from siltstone.plans.registry import query

ORDER_TYPES = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("order_total", T.DecimalType(12, 2)),
    ]
)


@query(
    "cast_projection",
    """select order_id, cast(order_ts as timestamp) as order_ts, status,
              cast(order_total as decimal(12,2)) as order_total, batch from orders_raw""",
)
def cast_projection(spark, d):
    types = T.StructType([*ORDER_TYPES.fields, T.StructField("batch", T.LongType())])
    return cast_to(shapes.orders_raw(spark, d), types)


@query(
    "try_cast_suite",
    """select order_id, batch,
              try_cast(try_cast(items as decimal(10,2)) as decimal(38,0)) as items,
              cast(try_cast(items as decimal(10,2)) as int) as items_int,
              try_cast(order_total as decimal(12,2)) as order_total,
              try_cast(order_ts as timestamp) as order_ts,
              cast(try_strptime(us_date, '%m/%d/%Y') as date) as us_date
       from (select *, case when items = 'n/a' then items
                            else strftime(cast(order_ts as timestamp), '%m/%d/%Y') end as us_date
             from orders_raw)""",
)
def try_cast_suite(spark, d):
    raw = shapes.orders_raw(spark, d)
    american = F.date_format(F.col("order_ts").cast("date"), "MM/dd/yyyy")
    rows = raw.withColumns(
        {
            "us_date": F.when(F.col("items") == "n/a", F.col("items")).otherwise(american),
            "items_int": F.col("items"),
        }
    )
    types = T.StructType(
        [
            T.StructField("order_id", T.StringType()),
            T.StructField("batch", T.LongType()),
            T.StructField("items", T.DecimalType(38, 0)),
            T.StructField("items_int", T.IntegerType()),
            T.StructField("order_total", T.DecimalType(12, 2)),
            T.StructField("order_ts", T.TimestampNTZType()),
            T.StructField("us_date", T.DateType()),
        ]
    )
    return try_cast_to(rows, types, {"us_date": "MM/dd/yyyy"})


@query(
    "normalise_keys",
    """select upper(trim(store_id)) as store_id, upper(trim(item_id)) as item_id, count(*) as row_count
       from daily_sales_raw group by all""",
)
def normalise_keys(spark, d):
    rows = C.normalise(shapes.daily_sales_raw(spark, d), ["store_id", "item_id"])
    return rows.groupBy("store_id", "item_id").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "blank_to_null",
    """select store_id, txn_id, line_id, nullif(sku, '') as sku, nullif(loyalty_id, '')
       as loyalty_id from pos_raw""",
)
def blank_to_null(spark, d):
    rows = C.blank_to_null(shapes.pos_raw(spark, d), ["sku", "loyalty_id"])
    return rows.select("store_id", "txn_id", "line_id", "sku", "loyalty_id")


@query(
    "date_key",
    "select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) as date_key from orders",
)
def date_key(spark, d):
    return shapes.table(spark, d, "orders").select(
        "o_orderkey", C.date_key("o_orderdate").alias("date_key")
    )


@query("ts_to_date", "select event_id, cast(ts as date) as event_date from events")
def ts_to_date(spark, d):
    return shapes.table(spark, d, "events").select("event_id", C.to_day("ts").alias("event_date"))


@query(
    "calendar_parts",
    """select d, cast(strftime(d, '%Y%m%d') as int) as date_key, dayofweek(d) + 1 as day_of_week,
              dayname(d) as day_name, week(d) as week_of_year, month(d) as month,
              dayofweek(d) in (0, 6) as is_weekend
       from (select distinct cast(o_orderdate as date) as d from orders)""",
)
def calendar_parts(spark, d):
    days = shapes.table(spark, d, "orders").select(C.to_day("o_orderdate").alias("d")).distinct()
    return C.calendar_parts(days, "d")


@query(
    "date_arith",
    """select event_id, cast(cast(ts as date) - interval 1 day as date) as day_before,
              ts - interval 24 hour as hours_back, ts - interval 7 day as week_back,
              ts + to_minutes(event_id % 60) as minutes_on, date_trunc('hour', ts) as hour_start
       from events""",
)
def date_arith(spark, d):
    minutes = (F.col("event_id") % 60).cast("int")
    return shapes.table(spark, d, "events").select(
        "event_id",
        C.shift(C.to_day("ts"), -1, "date").alias("day_before"),
        C.shift("ts", -24, "hours").alias("hours_back"),
        C.shift("ts", -7, "days").alias("week_back"),
        C.shift("ts", minutes, "minutes").alias("minutes_on"),
        C.hour_of("ts").alias("hour_start"),
    )


@query(
    "derived_amounts",
    """select store_id, txn_id, line_id, cast(qty * unit_price as decimal(18,2)) as line_amount,
              cast(qty % 5 * unit_price as decimal(12,2)) as waste_cost from pos_typed""",
)
def derived_amounts(spark, d):
    from siltstone.plans.retail import typed_sales

    return typed_sales(shapes.pos_raw(spark, d)).select(
        "store_id",
        "txn_id",
        "line_id",
        C.amount("qty", "unit_price").alias("line_amount"),
        C.amount(F.col("qty") % 5, "unit_price", 12, 2).alias("waste_cost"),
    )


@query(
    "case_mapping",
    """select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'filled'
              else 'other' end as status_name,
              case when o_totalprice >= 200000 then 'large' else 'small' end as size_class,
              case year(o_orderdate) % 4 when 0 then 'leap' when 2 then 'even'
              else 'odd' end as year_kind
       from orders""",
)
def case_mapping(spark, d):
    return shapes.table(spark, d, "orders").select(
        "o_orderkey",
        C.map_case("o_orderstatus", {"O": "open", "F": "filled"}, "other").alias("status_name"),
        F.when(F.col("o_totalprice") >= 200000, "large").otherwise("small").alias("size_class"),
        C.map_case(F.year("o_orderdate") % 4, {0: "leap", 2: "even"}, "odd").alias("year_kind"),
    )


@query(
    "string_pad_concat",
    """select c_custkey, 'C' || lpad(cast(c_custkey as varchar),
              cast(greatest(6, length(cast(c_custkey as varchar))) as int), '0') as customer_id,
              c_custkey % 8 as bucket, left(c_mktsegment, 2) as segment_code,
              c_mktsegment || '-' || c_nationkey as segment_nation
       from customer""",
)
def string_pad_concat(spark, d):
    return shapes.table(spark, d, "customer").select(
        "c_custkey",
        C.pad_id("C", "c_custkey", 6).alias("customer_id"),
        (F.col("c_custkey") % 8).alias("bucket"),
        F.left("c_mktsegment", F.lit(2)).alias("segment_code"),
        F.concat("c_mktsegment", F.lit("-"), "c_nationkey").alias("segment_nation"),
    )


@query(
    "coalesce_defaults",
    """select customer_id, batch, updated_at, coalesce(email, 'none') as email,
              coalesce(try_cast(signup_date as date), date '1970-01-01') as signup_date
       from customers_raw""",
)
def coalesce_defaults(spark, d):
    rows = shapes.customers_raw(spark, d).withColumn(
        "signup_date", F.col("signup_date").try_cast("date")
    )
    fixed = C.defaults(rows, {"email": "none", "signup_date": F.lit("1970-01-01").cast("date")})
    return fixed.select("customer_id", "batch", "updated_at", "email", "signup_date")


@query(
    "filter_business_date",
    """select business_date, store_id, item_id, qty_sold, _order, _line from daily_sales_raw
       where try_cast(business_date as date) = date '1998-01-05'""",
)
def filter_business_date(spark, d):
    rows = on_day(shapes.daily_sales_raw(spark, d), "business_date", "1998-01-05")
    return rows.select("business_date", "store_id", "item_id", "qty_sold", "_order", "_line")


@query(
    "null_safe_changes",
    """select s.customer_id, s.batch, (s.city is distinct from b.city)
              or (s.email is distinct from b.email) as differs
       from cust_delta s join cust_delta b on b.customer_id = s.customer_id and b.batch = 0
       where s.batch > 0""",
)
def null_safe_changes(spark, d):
    raw = shapes.customers_raw(spark, d)
    baseline = orders.customer_changes(raw.filter("batch = 0")).alias("old")
    from siltstone.operators.dedupe import change_set

    typed = orders.typed_customers(raw.filter("batch > 0"))
    later = change_set(typed, ["customer_id", "batch"], ["updated_at", "city"]).alias("new")
    pairs = later.join(baseline, F.col("old.customer_id") == F.col("new.customer_id"))
    return pairs.select(
        "new.customer_id", "new.batch", changed(["city", "email"])("old", "new").alias("differs")
    )


@query(
    "tsql_change_predicate",
    """select business_date, item_id,
              coalesce(unit_price <> price_now, false)
              or coalesce(category, '') <> coalesce(category_now, '') as differs
       from (select *, case when item_id like '%7' then null else unit_price + 1 end as price_now,
                    case when item_id like '%3' then null else category end as category_now
             from items_of_day)""",
)
def tsql_change_predicate(spark, d):
    from siltstone.plans.registered.daily import silver_sales

    items = daily.items_of_day(silver_sales(spark, d))
    ends = F.right("item_id", F.lit(1))
    pairs = items.select(
        "business_date",
        "item_id",
        F.struct("unit_price", "category").alias("old"),
        F.struct(
            F.when(ends != "7", F.col("unit_price") + 1).alias("unit_price"),
            F.when(ends != "3", F.col("category")).alias("category"),
        ).alias("new"),
    )
    differs = changed_tsql("unit_price", ["category"])("old", "new")
    return pairs.select("business_date", "item_id", differs.alias("differs"))


@query(
    "mask_email",
    """select customer_id, batch, updated_at, left(email, 2) || '****@masked.com' as masked,
              email as clear from customers_raw""",
)
def email(spark, d):
    return shapes.customers_raw(spark, d).select(
        "customer_id",
        "batch",
        "updated_at",
        mask_email("email", "DE_ANALYST").alias("masked"),
        mask_email("email", "DE_ENGINEER").alias("clear"),
    )


@query(
    "mask_phone",
    """select customer_id, batch, updated_at, '***-***-****' as masked, phone as clear
       from customers_raw""",
)
def phone(spark, d):
    return shapes.customers_raw(spark, d).select(
        "customer_id",
        "batch",
        "updated_at",
        mask_phone("phone", "DE_VIEWER").alias("masked"),
        mask_phone("phone", "ACCOUNTADMIN").alias("clear"),
    )


@query(
    "masked_view",
    """select customer_id, full_name, left(email, 2) || '****@masked.com' as email,
              '***-***-****' as phone, city, state, signup_date, updated_at, batch
       from customers_raw""",
)
def masked(spark, d):
    policies = {"email": mask_email, "phone": mask_phone}
    return masked_view(shapes.customers_raw(spark, d), policies, "DE_ANALYST")
