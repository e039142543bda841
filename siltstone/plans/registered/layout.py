"""Written layouts and what they allow a reader to skip."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.layout import cluster_by, clustering_info, zorder_by, zorder_dense
from siltstone.plans import shapes
from siltstone.plans.registry import query
from siltstone.session import scratch_path

_ORDERS = "select o_orderkey, o_custkey, o_orderdate, o_orderstatus from orders"


def _orders(spark, d):
    return shapes.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    )


def _written(spark, df, label):
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return path


@query("cluster_by", _ORDERS)
def clustered(spark, d):
    path = _written(spark, cluster_by(_orders(spark, d), ["o_orderdate"]), "clustered")
    return spark.read.parquet(path)


@query("zorder_layout", _ORDERS)
def zordered(spark, d):
    layout = zorder_by(_orders(spark, d), ["o_custkey", "o_orderkey"])
    return spark.read.parquet(_written(spark, layout, "zordered"))


@query(
    "clustering_info",
    """select count(*) as row_count, min(o_orderdate) as min_value, max(o_orderdate) as max_value,
              0 as files_without_own_range from orders""",
)
def info(spark, d):
    path = _written(spark, cluster_by(_orders(spark, d), ["o_orderdate"]), "clustered")
    report = clustering_info(spark, path, "o_orderdate")
    # What SQL can state of the files: their totals, and that each overlaps at least itself.
    return report.agg(
        F.sum("row_count").alias("row_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.count_if(F.col("overlap_depth") < 1).cast("int").alias("files_without_own_range"),
    )


@query("dense_layout", "select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem")
def dense(spark, d):
    """Part and supplier numbers are dense: no look at the rows before they are placed."""
    rows = shapes.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    keys = {"l_partkey": shapes.table(spark, d, "part").count(), "l_suppkey": shapes.table(spark, d, "supplier").count()}
    return spark.read.parquet(_written(spark, zorder_dense(rows, keys), "dense"))
