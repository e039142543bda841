"""Customer dimension and order fact maintained from the bronze tables by one stream.

Both bronze tables feed one query, so either having new files triggers a micro-batch, and inside a
batch the dimension is merged before the fact looks versions up. The first micro-batch is the
baseline. Every effect of a batch goes to a place named after the batch id or is an idempotent
upsert, so a batch that is repeated after a failure leaves the same tables.

Tables below `base`:

* `customers`: the dimension, its current versions in hash buckets, with closed versions and late changes
  beside them (see `streaming.dimension`); a batch rewrites only the buckets it touches;
* `orders/order_month=yyyyMM`: facts; a batch rewrites only the months it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.plans.orders import (
    ORDER_FACT,
    UPDATED_ON_MATCH,
    customer_changes,
    customer_dimension,
    order_facts,
)
from siltstone.session import scratch
from siltstone.sources import storage
from siltstone.sources.tables import upsert_partitions, write_partitioned
from siltstone.streaming.dimension import Dimension
from siltstone.streaming.ingest import run_if_new_data

FEED = "_feed"
_FACT = f"{ORDER_FACT}, order_month int"


def changes(spark: SparkSession, feeds: dict[str, tuple[str, T.StructType]]) -> DataFrame:
    """One stream over several bronze tables `{feed: (path, schema)}`, rows labelled by feed."""
    together = None
    for name, (path, schema) in feeds.items():
        rows = spark.readStream.schema(schema).parquet(path).withColumn(FEED, F.lit(name))
        together = rows if together is None else together.unionByName(rows, allowMissingColumns=True)
    return together


def _with_month(facts: DataFrame) -> DataFrame:
    month = F.year("order_date") * 100 + F.month("order_date")
    return facts.withColumn("order_month", month.cast("int"))


def _customers(base: str) -> Dimension:
    return customer_dimension(f"{base}/customers")


def apply_batch(base: str, run_ts: Column | None = None):
    """Micro-batch function: dimension first, then fact."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession, "batch"):  # intermediate tables go with the batch
            change(batch, batch_id)

    def change(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        customers = batch.filter(F.col(FEED) == "customers")
        orders = batch.filter(F.col(FEED) == "orders")
        kept, version = _customers(base), batch_id + 1
        if batch_id == 0:
            kept.start(customer_changes(customers), run_ts)
        else:
            kept.apply(customer_changes(customers), version, run_ts)
        facts = _with_month(order_facts(orders, kept.current(spark, version), run_ts))
        if storage.exists(spark, f"{base}/orders/_SUCCESS"):
            upsert_partitions(
                spark, f"{base}/orders", facts, ["order_id"], UPDATED_ON_MATCH, "order_month", run_ts, _FACT
            )
        else:
            write_partitioned(facts, f"{base}/orders", ["order_month"])

    return apply


def maintain(
    spark: SparkSession,
    base: str,
    feeds: dict[str, tuple[str, T.StructType]],
    run_ts: Column | None = None,
) -> int:
    """Apply everything that arrived since the last call; returns the number of micro-batches."""
    return run_if_new_data(changes(spark, feeds), apply_batch(base, run_ts), f"{base}/_checkpoint")


def read_customers(spark: SparkSession, base: str) -> DataFrame:
    """Current and closed versions."""
    return _customers(base).versions(spark)


def read_late(spark: SparkSession, base: str) -> DataFrame:
    """Customer changes that came after a newer version, as they came, with their batch; none is applied."""
    found = _customers(base).late(spark).withColumnRenamed("valid_from", "updated_at")
    return found.withColumn("batch", F.col("version") - 1).drop("version")


def read_orders(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(_FACT).parquet(f"{base}/orders")
