import random

from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from siltstone.operators.dedupe import change_set, latest, latest_success, max_collapse
from siltstone.operators.keys import continue_key, dense_key, running_totals


def test_latest_prefers_readable_time_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "z"), ("b", 5, "m"), ("b", 5, "n"), ("c", None, "q")],
        "k string, t int, v string",
    )
    assert rows(latest(df, ["k"], ["t", "v"])) == [("a", 1, "x"), ("b", 5, "n"), ("c", None, "q")]


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    text = plan(latest(df.repartition(4), ["k"], ["t"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_latest_with_one_dominant_key(spark):
    hot = spark.range(30000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    cold = spark.range(60000).select(
        F.concat(F.lit("c"), F.col("id") % 20000).alias("k"), F.col("id").alias("t")
    )
    result = latest(hot.union(cold), ["k"], ["t"])
    assert result.count() == 20001
    assert result.filter("k = 'hot'").first()["t"] == 29999


def test_change_set_takes_inserts_only(spark):
    df = spark.createDataFrame(
        [("a", 1, "INSERT"), ("a", 2, "DELETE"), ("b", 1, "UPDATE")], "k string, t int, act string"
    )
    assert rows(change_set(df, ["k"], ["t"], "act"), "k", "t") == [("a", 1)]


def test_latest_success_falls_back_to_newest_failure(spark):
    df = spark.createDataFrame(
        [("a", "ok", 1), ("a", "failed", 2), ("b", "failed", 1), ("b", "failed", 3)],
        "item string, status string, t int",
    )
    assert rows(latest_success(df, ["item"], "status", "t")) == [("a", "ok", 1), ("b", "failed", 3)]


def test_max_collapse_combines_attributes(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "b", 9)], "k string, name string, p int")
    assert rows(max_collapse(df, ["k"], ["name", "p"])) == [("a", "x", 9)]


def test_dense_key_equals_global_row_number(spark):
    random.seed(3)
    values = random.sample(range(100000), 5000)
    df = spark.createDataFrame([(v, f"n{v % 7}") for v in values], "v int, n string").repartition(7)
    keyed = dense_key(df, ["n", F.col("v").desc()], "sk")
    window = Window.orderBy("n", F.col("v").desc())
    want = df.select(F.row_number().over(window).cast("bigint").alias("sk"), "v", "n")
    assert rows(keyed) == rows(want)
    assert "SinglePartition" not in plan(keyed)


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), ["id"], "sk").count() == 0


def test_continue_key_keeps_existing(spark):
    old = dense_key(spark.createDataFrame([("m",), ("z",)], "k string"), ["k"], "sk")
    new = continue_key(old, spark.createDataFrame([("c",), ("a",)], "k string"), ["k"], "sk")
    assert rows(new, "sk", "k") == [(3, "a"), (4, "c")]


def test_running_totals_match_a_window(spark):
    df = spark.range(2000).select("id", (F.col("id") * 7 % 13).alias("x"), F.lit(1).alias("one"))
    got = running_totals(df.repartition(5), ["id"], {"x_sum": F.col("x"), "seen": F.col("one")})
    window = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("x").over(window).alias("x_sum"), F.sum("one").over(window).alias("seen"))
    assert rows(got, "id", "x_sum", "seen") == rows(want)
