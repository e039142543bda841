"""Customer versions, order upserts and change capture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.columns import pad_id
from siltstone.operators.dedupe import change_set, latest
from siltstone.operators.joins import keys_with_history, lookup_current, new_keys, unmatched
from siltstone.operators.keys import continue_key, dense_key
from siltstone.operators.merge import (
    log_as_of,
    merge_actions,
    scd2_from_log,
    state_as_of,
    table_diff,
)
from siltstone.operators.sets import union_labelled
from siltstone.plans import orders, shapes
from siltstone.plans.registry import query
from siltstone.session import pin, scratch_path
from siltstone.sources import tables
from siltstone.sources.tables import update_where
from siltstone.streaming import warehouse
from siltstone.streaming.dimension import Dimension

BATCHES = (1, 2, 3)
VERSION = ["customer_sk", *shapes.CUSTOMER_COLUMNS[:-1], "valid_from", "valid_to", "is_current"]
_VERSION_SQL = ", ".join(VERSION)


def run_ts(batch: int = 0):
    """Load instant of a batch, fixed so that results can be compared: a day per batch."""
    return F.lit(f"2026-06-{batch + 1:02d} 00:00:00").cast("timestamp_ntz")


def customers(spark: SparkSession, d: str) -> DataFrame:
    return shapes.customers_raw(spark, d)


def batch_of(df: DataFrame, batch: int) -> DataFrame:
    return df.filter(F.col("batch") == batch).drop("batch")


def kept_customers(spark: SparkSession, d: str) -> Dimension:
    """The dimension on disk after the baseline."""
    kept = orders.customer_dimension(scratch_path(spark, "customers"), count=16)
    kept.start(orders.customer_changes(batch_of(customers(spark, d), 0)))
    return kept


def customer_dim(spark: SparkSession, d: str, upto: int = BATCHES[-1]) -> DataFrame:
    """Dimension after applying the batches one after the other."""
    raw, kept = customers(spark, d), kept_customers(spark, d)
    for batch in BATCHES[:upto]:
        kept.apply(orders.customer_changes(batch_of(raw, batch)), batch + 1)
    return kept.versions(spark)


def customer_log(spark: SparkSession, d: str) -> DataFrame:
    return orders.typed_customers(customers(spark, d))


def history_from_log(spark: SparkSession, d: str) -> DataFrame:
    return scd2_from_log(
        customer_log(spark, d),
        ["customer_id"],
        orders.TRACKED,
        "updated_at",
        "batch",
        order=["updated_at", "city"],
    )


@query(
    "qualify_latest",
    """select customer_id, batch, city, email, updated_at from cust_delta""",
)
def qualify_latest(spark, d):
    rows = latest(customer_log(spark, d), ["customer_id", "batch"], ["updated_at", "city"])
    return rows.select("customer_id", "batch", "city", "email", "updated_at")


@query(
    "change_set",
    """select customer_id, full_name, email, phone, city, state, signup_date, updated_at
       from cust_typed where batch > 0
       qualify row_number() over (partition by customer_id order by updated_at desc, city desc) = 1""",
)
def changes(spark, d):
    raw = customers(spark, d)
    marked = raw.withColumn("_action", F.when(F.col("batch") > 0, "INSERT").otherwise("BASELINE"))
    typed = orders.typed_customers(marked)
    rows = change_set(typed, ["customer_id"], ["updated_at", "city"], "_action")
    return rows.drop("_action", "batch")


@query("scd2_timestamp", f"select {_VERSION_SQL} from cust_hist")
def scd2_timestamp(spark, d):
    return customer_dim(spark, d).select(*VERSION)


@query("scd2_from_log", f"select {', '.join(VERSION[1:])} from cust_hist")
def from_log(spark, d):
    return history_from_log(spark, d).select(*VERSION[1:])


@query(
    "multi_version_keys",
    """select customer_id, city, valid_from, valid_to, is_current from cust_hist
       where customer_id in (select customer_id from cust_hist group by 1 having count(*) > 1)""",
)
def multi_version_keys(spark, d):
    history = pin(history_from_log(spark, d), "customer-history")
    rows = keys_with_history(history, ["customer_id"])
    return rows.select("customer_id", "city", "valid_from", "valid_to", "is_current").orderBy(
        "customer_id", "valid_from"
    )


@query(
    "merge_actions",
    """select t.batch, t.customer_id, case when h.customer_id is null then 'insert'
              when h.city is distinct from t.city or h.email is distinct from t.email
                   or h.phone is distinct from t.phone or h.full_name is distinct from t.full_name
              then 'update' else 'none' end as merge_action
       from cust_delta t left join (select * from cust_delta where batch = 0) h
         on h.customer_id = t.customer_id""",
)
def actions(spark, d):
    raw = customers(spark, d)
    baseline = orders.first_customers(batch_of(raw, 0))
    baseline = pin(baseline, "customer-dim")
    planned = [
        merge_actions(baseline, orders.customer_changes(batch_of(raw, b)), ["customer_id"], orders.TRACKED)
        .withColumn("batch", F.lit(b))
        for b in (0, *BATCHES)
    ]
    return reduce(lambda a, b: a.unionByName(b), planned)


@query(
    "late_changes",
    """select customer_id, city, updated_at, 'late' as state from (
         select c.customer_id, 'TOO_LATE' as city, timestamp '1990-01-01 00:00:00' as updated_at
         from cust_hist c where c.is_current and c.customer_id in (
           select customer_id from customers_raw where batch = 0) and right(c.customer_id, 1) = '3')
       union all select customer_id, city, valid_from, 'current' from cust_hist where is_current""",
)
def late(spark, d):
    """A batch of changes older than the current versions is set aside and changes nothing."""
    dim = customer_dim(spark, d)
    known = batch_of(customers(spark, d), 0).filter(F.right("customer_id", F.lit(1)) == "3")
    batch = known.withColumns({"city": F.lit("TOO_LATE"), "updated_at": F.lit("1990-01-01 00:00:00")})
    aside = orders.late_customers(dim, batch).select("customer_id", "city", "updated_at", F.lit("late").alias("state"))
    after = orders.merge_customers(dim, batch).filter("is_current")
    return aside.unionByName(
        after.select("customer_id", "city", F.col("valid_from").alias("updated_at"), F.lit("current").alias("state"))
    )


@query(
    "unmatched_facts",
    """select 'customer_sk' as missing_key, batch, count(*) as row_count from orders_raw
       where customer_id not in (select customer_id from customers_raw where batch = 0) group by batch""",
)
def unmatched_facts(spark, d):
    """Order rows that an inner lookup of the baseline customers would drop."""
    dim = orders.first_customers(batch_of(customers(spark, d), 0))
    rows = unmatched(shapes.orders_raw(spark, d), {"customer_sk": (dim, ["customer_id"])})
    return rows.groupBy("missing_key", "batch").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "state_as_of",
    f"""select {', '.join(VERSION[1:])} from cust_hist
        where valid_from <= timestamp '2026-05-03 00:00:00'
          and (valid_to is null or timestamp '2026-05-03 00:00:00' < valid_to)""",
)
def as_of(spark, d):
    at = F.lit("2026-05-03 00:00:00").cast("timestamp_ntz")
    return state_as_of(history_from_log(spark, d), at).select(*VERSION[1:])


@query(
    "log_as_of",
    """select customer_id, city, state, email, updated_at from cust_typed
       where updated_at <= timestamp '2026-05-03 00:00:00'
       qualify row_number() over (partition by customer_id order by updated_at desc, city desc) = 1""",
)
def from_log_as_of(spark, d):
    at = F.lit("2026-05-03 00:00:00").cast("timestamp_ntz")
    rows = log_as_of(customer_log(spark, d), ["customer_id"], "updated_at", at, ["city"])
    return rows.select("customer_id", "city", "state", "email", "updated_at")


@query(
    "anti_join_new_keys",
    """select customer_id, batch, updated_at from cust_typed where batch > 0
       and customer_id not in (select customer_id from cust_typed where batch = 0)""",
)
def anti_join_new_keys(spark, d):
    log = customer_log(spark, d)
    later = log.filter("batch > 0").select("customer_id", "batch", "updated_at")
    return new_keys(later, log.filter("batch = 0"), ["customer_id"])


@query(
    "lookup_current_version",
    """select o.order_id, o.batch, o.customer_id, h.customer_sk
       from ord_delta o left join cust_hist h on h.customer_id = o.customer_id and h.is_current""",
)
def lookup_current_version(spark, d):
    raw = shapes.orders_raw(spark, d).select("order_id", "batch", "customer_id")
    return lookup_current(raw, customer_dim(spark, d), ["customer_id"], ["customer_sk"])


@query("fact_upsert", "select * from ord_fact")
def fact_upsert(spark, d):
    """Orders after four batches, each looking up the customer versions of its own time."""
    customer_rows, order_rows = customers(spark, d), shapes.orders_raw(spark, d)
    kept, path = kept_customers(spark, d), scratch_path(spark, "orders")
    schema = f"{orders.ORDER_FACT}, order_year int"

    def facts(batch: int) -> DataFrame:
        found = orders.order_facts(batch_of(order_rows, batch), kept.current(spark), run_ts(batch))
        return found.withColumn("order_year", F.year("order_date"))

    tables.write_partitioned(facts(0), path, ["order_year"])
    for batch in BATCHES:
        kept.apply(orders.customer_changes(batch_of(customer_rows, batch)), batch + 1)
        tables.upsert_partitions(
            spark, path, facts(batch), ["order_id"], orders.UPDATED_ON_MATCH, "order_year", run_ts(batch), schema
        )
    return spark.read.schema(schema).parquet(path).drop("order_year")


@query(
    "date_range_rollup",
    """select order_date, channel, count(*) as orders, cast(sum(order_total) as decimal(18,2))
              as revenue from ord_fact
       where order_date between date '1997-03-01' and date '1999-03-07' group by all""",
)
def date_range_rollup(spark, d):
    fact = latest(
        orders.typed_orders(shapes.orders_raw(spark, d)), ["order_id"], ["batch", "order_total"]
    ).withColumn("order_date", F.to_date("order_ts"))
    return orders.orders_by_day_channel(fact, "1997-03-01", "1999-03-07")


@query(
    "surrogate_keys",
    """select row_number() over (order by o_orderdate, o_orderkey) as order_sk, o_orderkey,
              o_orderdate from orders""",
)
def surrogate_keys(spark, d):
    rows = shapes.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return dense_key(rows, ["o_orderdate", "o_orderkey"], "order_sk")


@query(
    "surrogate_keys_incremental",
    """with keys as (select distinct customer_id, min(batch) as batch from cust_typed group by 1)
       select row_number() over (order by batch, customer_id) as customer_sk, customer_id,
              batch > 0 as added from keys""",
)
def surrogate_keys_incremental(spark, d):
    log = customers(spark, d).select("customer_id", "batch")
    first = log.filter("batch = 0").select("customer_id").distinct()
    existing = dense_key(first, ["customer_id"], "customer_sk")
    added = new_keys(log.filter("batch > 0"), existing, ["customer_id"]).select("customer_id")
    fresh = continue_key(existing, added.distinct(), ["customer_id"], "customer_sk")
    return existing.withColumn("added", F.lit(False)).unionByName(
        fresh.withColumn("added", F.lit(True))
    )


@query(
    "update_where",
    """select c_custkey, case when c_mktsegment = 'BUILDING' then 'DEVTEST' else c_name end as c_name,
              c_mktsegment from customer""",
)
def updated(spark, d):
    rows = shapes.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return update_where(rows, F.col("c_mktsegment") == "BUILDING", c_name="DEVTEST")


def _copy(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers and an independent copy that was changed in place."""
    rows = shapes.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    copy = update_where(rows, F.col("c_custkey") % 10 == 2, c_name="DEVTEST")
    kept = copy.filter(F.col("c_custkey") % 10 != 3)
    added = copy.filter(F.col("c_custkey") % 10 == 3).withColumn("c_custkey", -F.col("c_custkey"))
    return rows, kept.unionByName(added)


@query(
    "table_diff",
    """select coalesce(a.c_custkey, b.c_custkey) as c_custkey,
              case when b.c_custkey is null then 'only_a' when a.c_custkey is null then 'only_b'
                   else 'changed' end as difference,
              a.c_name as c_name_a, b.c_name as c_name_b
       from customer a full join
            (select case when c_custkey % 10 = 3 then -c_custkey else c_custkey end as c_custkey,
                    case when c_custkey % 10 = 2 then 'DEVTEST' else c_name end as c_name
             from customer) b on a.c_custkey = b.c_custkey
       where a.c_custkey is null or b.c_custkey is null or a.c_name <> b.c_name""",
)
def diff(spark, d):
    return table_diff(*_copy(spark, d), ["c_custkey"], ["c_name"])


@query(
    "union_labelled",
    """select 'prod' as source, c_custkey, c_name from customer union all
       select 'dev', case when c_custkey % 10 = 3 then -c_custkey else c_custkey end,
              case when c_custkey % 10 = 2 then 'DEVTEST' else c_name end from customer""",
)
def labelled(spark, d):
    prod, dev = _copy(spark, d)
    return union_labelled({"prod": prod, "dev": dev}).select("source", "c_custkey", "c_name")


def _land(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _streamed(spark: SparkSession, d: str) -> str:
    """Land four batches one after the other and let the stream maintain the tables."""
    base = scratch_path(spark, "warehouse")
    raw = {"customers": customers(spark, d), "orders": shapes.orders_raw(spark, d)}
    feeds = {
        name: (f"{base}/bronze_{name}", df.drop("batch").schema) for name, df in raw.items()
    }
    for batch in (0, *BATCHES):
        for name, (path, _) in feeds.items():
            _land(batch_of(raw[name], batch), path)
        warehouse.maintain(spark, base, feeds, run_ts())
    return base


@query(
    "bootstrap_then_incremental",
    """select f.order_id, f.customer_sk, f.order_ts, f.status, f.channel, f.items, f.order_total,
              h.city as city_at_load, h.is_current as still_current
       from ord_fact f left join cust_hist h on h.customer_sk = f.customer_sk""",
)
def bootstrap_then_incremental(spark, d):
    base = _streamed(spark, d)
    versions = warehouse.read_customers(spark, base).select(
        "customer_sk", F.col("city").alias("city_at_load"), F.col("is_current").alias("still_current")
    )
    facts = warehouse.read_orders(spark, base).drop("order_month", "order_date", "_updated_at")
    return facts.join(versions, "customer_sk", "left")
