"""Customer and order batches: versioned customers and an order fact kept by upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.predicates import in_range
from siltstone.functions.typing import tolerant
from siltstone.operators.aggregates import rollup_by
from siltstone.operators.dedupe import change_set
from siltstone.operators.joins import lookup_current
from siltstone.operators.keys import dense_key
from siltstone.operators.merge import late_changes, open_versions, scd2_apply, upsert
from siltstone.operators.sets import ordered
from siltstone.streaming.dimension import Dimension

# Fixed values of the order model.
TRACKED = ("city", "email", "phone", "full_name")
UPDATED_ON_MATCH = ("status", "order_total")
CUSTOMER_KEY = "customer_sk"
ORDER_FACT = (
    "order_id string, customer_sk bigint, order_ts timestamp_ntz, order_date date, status string, channel string, "
    "items decimal(38,0), order_total decimal(12,2), _updated_at timestamp_ntz"
)


def typed_customers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "signup_date": tolerant("signup_date", T.DateType()),
            "updated_at": tolerant("updated_at", T.TimestampNTZType()),
        }
    )


def typed_orders(raw: DataFrame) -> DataFrame:
    order_ts = tolerant("order_ts", T.TimestampNTZType())
    return raw.withColumns(
        {
            "order_ts": order_ts,
            "items": tolerant("items", T.DecimalType(38, 0)),
            "order_total": tolerant("order_total", T.DecimalType(12, 2)),
        }
    )


def customer_changes(batch: DataFrame) -> DataFrame:
    """Latest row per customer of one batch; a readable change time wins over an unreadable one."""
    columns = ["customer_id", "full_name", "email", "phone", "city", "state", "signup_date", "updated_at"]
    typed = typed_customers(batch.select(*columns))
    return change_set(typed, ["customer_id"], ["updated_at", "city", "email", "phone", "full_name"])


def order_changes(batch: DataFrame) -> DataFrame:
    """Latest row per order of one batch."""
    columns = ["order_id", "customer_id", "order_ts", "status", "channel", "items", "order_total"]
    typed = typed_orders(batch.select(*columns))
    return change_set(typed, ["order_id"], ["order_ts", "status", "order_total", "items"])


def first_customers(batch: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Customer dimension from the baseline load."""
    rows = open_versions(customer_changes(batch), "updated_at", run_ts)
    return dense_key(rows, ["customer_id"], CUSTOMER_KEY)


def merge_customers(dim: DataFrame, batch: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return scd2_apply(
        dim,
        customer_changes(batch),
        ["customer_id"],
        TRACKED,
        "updated_at",
        run_ts=run_ts,
        surrogate=CUSTOMER_KEY,
    )


def customer_dimension(base: str, count: int = 64) -> Dimension:
    """The customer dimension kept on disk, for batches at the cost of what they change."""
    return Dimension(base, ("customer_id",), TRACKED, "updated_at", CUSTOMER_KEY, count)


def late_customers(dim: DataFrame, batch: DataFrame) -> DataFrame:
    """Changes of a batch that are older than the customer's current version, which are not applied."""
    return late_changes(dim, customer_changes(batch), ["customer_id"], TRACKED, "updated_at")


def order_facts(batch: DataFrame, dim: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Order rows with the customer version that is current now; NULL for an unknown customer."""
    orders = lookup_current(order_changes(batch), dim, ["customer_id"], [CUSTOMER_KEY])
    return orders.select(
        "order_id",
        CUSTOMER_KEY,
        "order_ts",
        F.to_date("order_ts").alias("order_date"),
        "status",
        "channel",
        "items",
        "order_total",
        (F.localtimestamp() if run_ts is None else run_ts).alias("_updated_at"),
    )


def merge_orders(
    fact: DataFrame, batch: DataFrame, dim: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    return upsert(fact, order_facts(batch, dim, run_ts), ["order_id"], UPDATED_ON_MATCH, run_ts)


def orders_by_day_channel(fact: DataFrame, low: str, high: str) -> DataFrame:
    """Orders and revenue by date and channel inside a date range."""
    bounds = [F.lit(d).cast("date") for d in (low, high)]
    rows = in_range(fact, "order_date", *bounds)
    return ordered(rollup_by(rows, ["order_date", "channel"], "order_total"), ["order_date", "channel"])
