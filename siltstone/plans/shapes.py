"""The given tables in the shapes of the pipelines' inputs.

All rules are modulo arithmetic on keys over whole tables, so that the same shape can be stated in
another engine's SQL (`shapes_sql`). They plant the defects the pipelines have to handle: copies,
blank and unknown keys, unreadable numbers, late and repeated rows, columns that appear later.
Identifiers are padded to a minimum width and never cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(number: str, width: int) -> str:
    text = f"cast({number} as string)"
    return f"lpad({text}, greatest({width}, length({text})), '0')"


def _cents(number: str) -> str:
    """Whole cents to decimal text, exactly."""
    return f"cast(cast(cast({number} as decimal(18,0)) * 0.01BD as decimal(12,2)) as string)"


# Tie-break columns that make every sales line's order total.
SALES_ORDER = ("_ingest_ts", "_part", "_supp")
DAILY_ORDER = ("_loaded_at", "_order", "_part", "_supp", "_line")
POS_COLUMNS = (
    "store_id", "txn_id", "line_id", "txn_ts", "sku", "qty", "unit_price", "payment_type",
)
CLICK_COLUMNS = ("event_id", "user_id", "session_id", "event_type", "sku", "event_ts", "device")
CUSTOMER_COLUMNS = (
    "customer_id", "full_name", "email", "phone", "city", "state", "signup_date", "updated_at",
)
ORDER_COLUMNS = (
    "order_id", "customer_id", "order_ts", "status", "channel", "items", "order_total",
)


def pos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines as landed: all text, plus load time and tie-breaks."""
    price = "cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"concat('S', {_pad('l_orderkey % 20 + 1', 3)}) as store_id",
        "concat('T', l_orderkey) as txn_id",
        "cast(l_linenumber as string) as line_id",
        "cast(l_shipdate + make_dt_interval(0, l_linenumber) as string) as txn_ts",
        f"""case when l_partkey % 150 = 0 then ''
                 when l_partkey % 200 = 1 then concat('SKUX', l_partkey)
                 else concat(' sku', {_pad('l_partkey', 5)}, ' ') end as sku""",
        """case when l_orderkey % 251 = 0 then '0'
                when l_orderkey % 509 = 0 then 'n/a'
                else cast(cast(l_quantity as int) as string) end as qty""",
        f"{_cents(price)} as unit_price",
        "concat(l_returnflag, '-', l_linestatus) as payment_type",
        """case when year(l_shipdate) >= 1999 then
                case when l_returnflag = 'R' then '' else concat('supplier-', l_suppkey) end end as loyalty_id""",
        "l_shipdate as _ingest_ts",
        "l_partkey as _part",
        "l_suppkey as _supp",
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a product feed. One part in 19 comes twice, first with an older name; one in 43 has an
    unreadable price; some change times are unreadable too."""
    return table(spark, sf_dir, "part").selectExpr(
        "*", "explode(case when p_partkey % 19 = 4 then array(0, 1) else array(0) end) as older"
    ).selectExpr(
        f"concat('sku', {_pad('p_partkey', 5)}) as sku",
        "case when older = 1 then concat('former ', p_name) else p_name end as name",
        "p_type as category",
        "p_brand as brand",
        "cast(round(p_retailprice * 100) as bigint) as _cents",
        "p_partkey % 43 = 11 as _bad_price",
        "case when p_partkey % 71 = 9 then 'soon' else "
        "cast(timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(p_size, -older) as string) end as updated_at",
    ).selectExpr(
        "sku", "name", "category", "brand",
        f"case when _bad_price then 'ask' else {_cents('_cents')} end as list_price", "updated_at",
    )


def clicks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed. Every event whose number ends in 7 was sent twice, the copy with another
    device and a minute later."""
    return table(spark, sf_dir, "events").selectExpr(
        "*",
        "explode(case when event_id % 10 = 7 then array(0, 1) else array(0) end) as copy",
    ).selectExpr(
        "concat('E', event_id) as event_id",
        "concat('U', user_id) as user_id",
        "concat('G', user_id, '-', date_format(ts, 'yyyyMMdd')) as session_id",
        "case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart' "
        "else event_type end as event_type",
        f"concat('sku', {_pad('event_id % 200', 5)}) as sku",
        "cast(date_trunc('second', ts) as timestamp_ntz) as event_time",
        "concat('client ', (event_id + copy) % 4) as device",
        "ts + make_dt_interval(0, 0, copy) as _ingest_ts",
    ).selectExpr(
        "event_id", "user_id", "session_id", "event_type", "sku",
        "cast(event_time as string) as event_ts", "device", "_ingest_ts",
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows of four batches.

    Batch 0 is the baseline. Batches 1 to 3 bring moved customers (every second one after a stale
    row of the same batch), customers whose state alone changed, and in batch 1 new customers.
    """
    changed = "batch > 0 and c_custkey % 25 = batch"
    state_only = "batch > 0 and c_custkey % 25 = batch + 10"
    is_new = "c_custkey % 50 = 7"
    return (
        table(spark, sf_dir, "customer")
        .selectExpr("*", "explode(sequence(0, 3)) as batch")
        .selectExpr(
            "*",
            f"explode(case when {changed} and c_custkey % 2 = 0 then array(0, 1) else array(0) end)"
            " as stale",
        )
        .filter(
            f"(batch = 0 and not {is_new}) or (batch = 1 and {is_new}) or ({changed}) or ({state_only})"
        )
        .selectExpr(
            f"concat('C', {_pad('c_custkey + 1', 6)}) as customer_id",
            "c_name as full_name",
            f"case when c_custkey % 17 = 0 and not ({changed}) then null "
            "else concat(lower(c_mktsegment), '.', c_custkey, '@mail.test') end as email",
            f"concat('+', c_nationkey + 10, ' ', {_pad('c_custkey', 7)}) as phone",
            f"""case when stale = 1 then 'STALE'
                     when {changed} then concat('CITY_', (c_nationkey + 1) % 25)
                     else concat('CITY_', c_nationkey) end as city""",
            f"case when {state_only} then 'ZZ' else concat('ST', c_nationkey % 5) end as state",
            "case when c_custkey % 31 = 0 then 'unknown' "
            "else cast(date_add(date'1994-06-01', cast(abs(c_acctbal) as int) % 1000) as string) end"
            " as signup_date",
            "cast(timestamp_ntz'2026-05-01 12:00:00' + make_dt_interval(batch, -stale) as string)"
            " as updated_at",
            "batch",
        )
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows of four batches: a baseline, new orders, and orders sent again with other values."""
    resent = "batch > 0 and o_orderkey % 40 = batch + 4"
    is_new = "batch > 0 and o_orderkey % 20 = batch"
    total = f"cast(round(o_totalprice * 100) as bigint) + case when {resent} then 100 else 0 end"
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("*", "explode(sequence(0, 3)) as batch")
        .filter(
            f"(batch = 0 and o_orderkey % 20 not in (1, 2, 3)) or ({is_new}) or ({resent})"
        )
        .selectExpr(
            f"concat('O', {_pad('o_orderkey + 1', 8)}) as order_id",
            f"case when o_orderkey % 97 = 0 then concat('CX', o_custkey) "
            f"else concat('C', {_pad('o_custkey + 1', 6)}) end as customer_id",
            "cast(o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int)) as string)"
            " as order_ts",
            f"case when {resent} then 'again' else o_orderstatus end as status",
            "o_orderpriority as channel",
            """case when o_orderkey % 101 = 0 then '2.5' when o_orderkey % 103 = 0 then 'n/a'
                    else cast(cast(o_totalprice as bigint) div 20000 + 1 as string) end as items""",
            f"{_cents(total)} as order_total",
            "batch",
        )
    )


# Items of the daily feeds are parts folded to this many, stores suppliers folded to this many.
DAILY_ITEMS, DAILY_STORES = 75, 10


def _item_cents() -> str:
    """Price of a folded part in cents; one item in seven rises by 25 cents with every year."""
    item = f"(l_partkey % {DAILY_ITEMS})"
    rise = f"case when {item} % 7 = 2 then 25 * (year(l_shipdate) - 1994) else 0 end"
    return f"(199 + {item} * 37 % 900 + {rise})"


def daily_sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily store sales as landed, with blank, nameless, oddly spelled and unreadable values."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_orderkey % 229 = 0 then 'yesterday' else cast(cast(l_shipdate as date) as string) end"
        " as business_date",
        f"""case when l_orderkey % 223 = 0 then ' '
                 when l_orderkey % 3 = 0 then concat(' st', l_suppkey % {DAILY_STORES}, ' ')
                 else concat('ST', l_suppkey % {DAILY_STORES}) end as store_id""",
        f"""case when l_orderkey % 211 = 0 then ''
                 when l_orderkey % 307 = 0 then concat('UNLISTED', l_orderkey % 7)
                 when l_orderkey % 5 = 0 then concat('part', l_partkey % {DAILY_ITEMS})
                 else concat('PART', l_partkey % {DAILY_ITEMS}) end as item_id""",
        f"case when l_orderkey % 307 = 0 then '' "
        f"else concat('part number ', l_partkey % {DAILY_ITEMS}) end as item_name",
        "concat('shelf ', l_partkey % 5) as category",
        f"case when l_orderkey % 401 = 0 then 'bad' else {_cents(_item_cents())} end as unit_price",
        "cast(cast(l_quantity as int) as string) as qty_sold",
        f"{_cents(f'{_item_cents()} * cast(l_quantity as bigint)')} as gross_sales",
        "cast(l_linenumber as string) as txn_count",
        "l_shipdate + make_dt_interval(0, 0, l_linenumber) as _loaded_at",
        "l_orderkey as _order",
        "l_partkey as _part",
        "l_suppkey as _supp",
        "l_linenumber as _line",
    )


def daily_inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock counts on the sales grid; some items are never counted."""
    return (
        table(spark, sf_dir, "lineitem")
        .filter(f"l_partkey % {DAILY_ITEMS} % 7 <> 3")
        .selectExpr(
            "case when l_orderkey % 233 = 0 then '' else cast(cast(l_shipdate as date) as string) end as business_date",
            f"concat('ST', l_suppkey % {DAILY_STORES}) as store_id",
            f"concat('PART', l_partkey % {DAILY_ITEMS}) as item_id",
            "cast(l_orderkey % 90 + 35 as string) as begin_qty",
            "cast(l_linenumber * 12 as string) as received_qty",
            "cast(cast(l_quantity as int) as string) as sold_qty",
            "cast(cast(round(l_discount * 100) as int) as string) as waste_qty",
            "cast(l_orderkey % 61 + l_linenumber as string) as end_qty",
            "l_shipdate + make_dt_interval(0, 0, l_linenumber) as _loaded_at",
            "l_orderkey as _order",
            "l_partkey as _part",
            "l_suppkey as _supp",
            "l_linenumber as _line",
        )
    )


def daily_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stores of the daily feeds: the first suppliers, with the region of their nation."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    suppliers = table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") < DAILY_STORES)
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("ST"), F.col("s_suppkey")).alias("store_id"), F.col("r_name").alias("region")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answers per part: price as truth, a wordy prediction that is off by up to six percent,
    and some failed requests."""
    failed = "(p_partkey % 97 = 0 or (p_partkey % 13 = 5 and attempt = 1))"
    answer = "cast(round(p_retailprice * 100) as bigint) * (100 + p_partkey % 13 - 6) div 100"
    return (
        table(spark, sf_dir, "part")
        .selectExpr("*", "explode(array(0, 1)) as attempt")
        .selectExpr(
            "p_partkey as item_id",
            "attempt",
            "p_type as category",
            "case when p_size < 25 then '2d' else '3d' end as cohort",
            f"case when {failed} then 'failed' else 'ok' end as status",
            f"cast({_cents('cast(round(p_retailprice * 100) as bigint)')} as decimal(12,2)) as truth",
            f"case when {failed} then null when p_partkey % 29 = 0 then 'cannot tell' "
            f"else concat('The value is ', {_cents(answer)}, ' units') end as prediction",
            "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, attempt) as answered_at",
            "p_name as name",
        )
    )
