import pytest
from conftest import day, plan, rows
from pyspark.sql import functions as F

from siltstone.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows, all identical, share one key; another third has no key at all."""
    hot = spark.range(4000).select(F.lit(1).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("v"))
    none = spark.range(4000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
    cold = spark.range(4000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    return hot.union(none).union(cold).repartition(8).cache()


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_keyed_join_equals_plain_join(spark, skewed, lookup, how, threshold):
    """By shuffle and by broadcast, with a map column beside the key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = skewed.withColumn("m", F.create_map(F.lit("v"), "v"))
        got = joins.keyed_join(left, lookup, ["k"], how)
        want = skewed.join(lookup, "k", how)
        assert rows(got.drop("m")) == rows(want)
        assert ("BroadcastHashJoin" in plan(got)) == (threshold == "10m")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_job_runs_while_a_join_is_planned(spark, skewed, lookup):
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        joined = joins.star_join(joins.keyed_join(skewed, lookup, ["k"]).withColumnRenamed("w", "j"), {"k": lookup})
        joins.mark_known(joined, lookup, ["k"], "known")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_half_of_the_rows_under_one_key_are_split(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        half = spark.range(0, 200_000, 1, 16).select(
            F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 997).alias("k"), F.md5(F.col("id").cast("string")).alias("v")
        )
        other = spark.range(0, 997, 1, 2).select(F.col("id").cast("int").alias("k"), (F.col("id") * 3).alias("w"))
        half = half.withColumn("k", F.col("k").cast("int"))
        joined = joins.keyed_join(half, other, ["k"]).withColumn("task", F.spark_partition_id())
        sizes = sorted(r["count"] for r in joined.groupBy("task").count().collect())
        assert sum(sizes) == 200_000
        # Four shuffle partitions; the one with the frequent key is read in several pieces.
        assert len(sizes) > 4 and sizes[-1] < 70_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_unmatched_rows_name_the_key_they_lack(spark):
    fact = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", None), (None, "y")], "p string, s string")
    dims = {
        "p_key": (spark.createDataFrame([(1, "a")], "p_key int, p string"), ["p"]),
        "s_key": (spark.createDataFrame([(1, "x"), (2, "y")], "s_key int, s string"), ["s"]),
    }
    assert rows(joins.attach_keys(fact, dims), "p", "s") == [("a", "x")]
    assert rows(joins.unmatched(fact, dims), "p", "s", "missing_key") == sorted(
        [("b", "x", "p_key"), ("a", None, "s_key"), (None, "y", "p_key")], key=repr
    )


def test_unsupported_join_type(skewed, lookup):
    with pytest.raises(ValueError):
        joins.keyed_join(skewed, lookup, ["k"], "full_outer")


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame(
        [
            ("a", 1, day("2026-01-01"), day("2026-01-10")),
            ("a", 2, day("2026-01-11"), None),
        ],
        "item string, sk int, valid_from date, valid_to date",
    )


def test_asof_closed_days(spark, versions):
    facts = spark.createDataFrame(
        [("a", day(d)) for d in ("2025-12-31", "2026-01-01", "2026-01-10", "2026-01-11", "2026-05-05")]
        + [("b", day("2026-01-01"))],
        "item string, at date",
    )
    got = joins.asof_version(facts, versions, ["item"], "at", ["sk"])
    assert rows(got, "at", "sk") == [
        (day("2026-01-01"), 1), (day("2026-01-10"), 1), (day("2026-01-11"), 2), (day("2026-05-05"), 2),
    ]
    left = joins.asof_version(facts, versions, ["item"], "at", ["sk"], how="left")
    assert left.count() == 6 and left.filter("sk is null").count() == 2


def test_asof_half_open_excludes_the_end(spark, versions):
    facts = spark.createDataFrame([("a", day("2026-01-10"))], "item string, at date")
    assert joins.asof_version(facts, versions, ["item"], "at", ["sk"], closed=False).count() == 0


def test_asof_hashes_on_the_key(spark, versions):
    facts = spark.createDataFrame([("a", day("2026-01-10"))], "item string, at date")
    text = plan(joins.asof_version(facts, versions, ["item"], "at", ["sk"]))
    assert "NestedLoop" not in text and ("SortMergeJoin [item" in text or "BroadcastHashJoin [item" in text)


def test_mark_known_keeps_rows_once(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    ref = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(joins.mark_known(df, ref, ["k"], "known")) == sorted(
        [("a", True), ("b", False), (None, False)], key=repr
    )


def test_keys_with_history(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, n int")
    assert rows(joins.keys_with_history(df, ["k"])) == [("a", 1), ("a", 2)]
