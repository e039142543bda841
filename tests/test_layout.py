"""Gold layout, footer ranges, bitmaps, carried as-of joins, and the newest row of a stream."""

import random
import re

import pytest
from conftest import day, instant, plan, rows
from pyspark.sql import functions as F

from siltstone.operators import aggregates as A
from siltstone.operators.dedupe import latest
from siltstone.operators.joins import asof_carried, asof_version
from siltstone.operators.layout import file_ranges, pruned_files, zorder_dense
from siltstone.plans import lakehouse, retail, shapes
from siltstone.plans.registered.files import POS_ALL, land_csv, land_products
from siltstone.sources import tables
from siltstone.streaming.latest import latest_updates


@pytest.fixture(scope="module")
def star(spark, sf_dir, tmp_path_factory):
    """The retail tables below one folder, with the fact by month and by day."""
    base = str(tmp_path_factory.mktemp("retail"))
    raw = shapes.pos_raw(spark, sf_dir)
    land_csv(raw.select(*POS_ALL), f"{base}/landing/pos")
    shapes.clicks_raw(spark, sf_dir).select(*shapes.CLICK_COLUMNS).write.json(f"{base}/landing/clicks")
    land_products(spark, sf_dir, f"{base}/landing/products")
    lakehouse.bronze(spark, f"{base}/landing", base)
    lakehouse.silver(spark, base)
    lakehouse.gold(spark, base)
    return base


def partitions_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in leaves.nodeName():
        leaves = leaves.executedPlan()
    scans = leaves.collectLeaves()
    return [
        scans.apply(k).metrics().get("numPartitions").get().value() for k in range(scans.size())
        if scans.apply(k).metrics().contains("numPartitions")
    ]


def one_day(spark, base):
    return spark.read.parquet(f"{base}/gold/dim_date").agg(F.min("date_key")).first()[0]


def test_one_day_opens_one_month(spark, star):
    facts = lakehouse.read_star(spark, star)["fact_sales"]
    key = facts.agg(F.min("date_key")).first()[0]
    one = lakehouse.within_dates(facts, key, key)
    assert one.count() == facts.filter(F.col("date_key") == key).count() > 0
    assert "PartitionFilters: [isnotnull(month_key" in plan(one)
    assert partitions_read(one) == [1]


def test_one_day_opens_one_date(spark, star, tmp_path):
    facts = lakehouse.read_star(spark, star)["fact_sales"].drop("month_key")
    first = facts.agg(F.min("date_key")).first()[0]
    part, name = lakehouse.by_grain(facts.filter(F.col("date_key") < first + 300), "day")
    zorder_dense(part, {"product_key": 200, "store_key": 20}, within=[name]).write.partitionBy(name).parquet(f"{tmp_path}/t")
    daily = spark.read.parquet(f"{tmp_path}/t")
    assert daily.select("date_key").distinct().count() > 10
    assert partitions_read(lakehouse.within_dates(daily, first, first)) == [1]


def test_a_filter_on_the_date_dimension_prunes_at_run_time(spark, star):
    found = lakehouse.read_star(spark, star)
    key = found["fact_sales"].agg(F.min("date_key")).first()[0]
    first = found["dim_date"].filter(F.col("date_key") == key)
    hit = lakehouse.on_dates(found["fact_sales"], first)
    assert "dynamicpruning" in plan(hit).lower()
    assert hit.count() == found["fact_sales"].filter(F.col("date_key") == key).count()


def test_reports_do_not_depend_on_the_grain(spark, star, tmp_path):
    found = lakehouse.read_star(spark, star)
    by_day = {**found, "fact_sales": found["fact_sales"].drop("month_key")}
    for report in (retail.daily_revenue_by_category, retail.weekend_mix_by_region):
        assert rows(report(found)) == rows(report(by_day))


def test_dense_layout_narrows_both_keys(spark, tmp_path):
    """Files that a filter on either key has to open, against the same rows dealt out at random."""
    df = spark.range(64_000).select((F.col("id") % 320 + 1).alias("a"), (F.crc32(F.col("id").cast("string").cast("binary")) % 200 + 1).alias("b"))
    df = df.withColumn("a", F.when(F.col("a") == 320, None).otherwise(F.col("a")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        zorder_dense(df, {"a": 320, "b": 200}, cells=64).write.parquet(f"{tmp_path}/z")
        df.repartition(40).write.parquet(f"{tmp_path}/r")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows(spark.read.parquet(f"{tmp_path}/z").groupBy("a", "b").count()) == rows(df.groupBy("a", "b").count())
    for column in ("a", "b"):
        read, total = pruned_files(file_ranges(spark, f"{tmp_path}/z", column), 100, 110).first()
        assert read <= total / 2
        read, total = pruned_files(file_ranges(spark, f"{tmp_path}/r", column), 100, 110).first()
        assert read == total


def test_footers_give_the_ranges_of_a_scan(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.col("id").cast("string").alias("text"), (F.col("id") / 7).cast("decimal(12,3)").alias("dec"),
        F.expr("date'2020-01-01' + cast(id as int)").alias("day"), F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("ntz"),
        F.expr("timestamp'2020-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("ts"), F.when(F.col("id") > 500, F.col("id")).alias("some"),
        F.lit(None).cast("int").alias("none"), (F.col("id") % 3).cast("int").alias("part"),
    )
    df.repartitionByRange(6, "id").write.partitionBy("part").parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    for column in ("id", "text", "dec", "day", "ntz", "ts", "some", "none"):
        scan = table.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)), F.min(column), F.max(column))
        got = file_ranges(spark, f"{tmp_path}/t", column)
        assert rows(got, "row_count", "min_value", "max_value") == rows(scan.drop("f")), column
        assert got.schema["min_value"].dataType == table.schema[column].dataType
    assert file_ranges(spark, f"{tmp_path}/t", "id").select("file_path").distinct().count() == table.select("_metadata.file_path").distinct().count()


def test_footers_are_read_without_rows(spark, tmp_path):
    spark.range(3000).write.parquet(f"{tmp_path}/t")
    before = pruned_files(file_ranges(spark, f"{tmp_path}/t", "id"), 0, 10).first()
    text = plan(file_ranges(spark, f"{tmp_path}/t", "id"))
    assert "HashAggregate" not in text and re.search(r"footers", text)
    assert before["files_read"] >= 1


def test_bitmaps_of_days_give_exact_counts_of_any_range(spark):
    r = random.Random(2)
    values = [(r.choice("ab"), r.randrange(9), r.choice([None, r.randrange(100_000), 3])) for _ in range(4000)]
    df = spark.createDataFrame(values, "kind string, day int, user bigint")
    days = A.distinct_bitmaps(df, ["kind", "day"], "user")
    assert days.filter(F.length("bits") != 4096).count() == 0
    for low, high in ((0, 8), (2, 4), (7, 7)):
        inside = F.col("day").between(low, high)
        want = df.filter(inside).groupBy("kind").agg(F.countDistinct("user").alias("users"))
        assert rows(A.distinct_from(days.filter(inside), ["kind"], "users")) == rows(want)


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_carried_versions_are_those_of_the_join(spark, closed, how):
    r = random.Random(5)
    versions = []
    for key in "abcde":
        at = 0
        for k in range(r.randrange(1, 9)):
            start = at + r.randrange(1, 4)
            at = start + r.randrange(1, 6)
            last = k > 5 and key in "ab"
            versions.append((key, f"{key}{k}", day("2026-01-01").fromordinal(738000 + start), None if last else day("2026-01-01").fromordinal(738000 + at)))
    versions.append((None, "none", day("2026-01-01"), None))
    dim = spark.createDataFrame(versions, "k string, v string, valid_from date, valid_to date")
    facts = [(n, r.choice(["a", "b", "c", "d", "e", "z", None]), day("2026-01-01").fromordinal(738000 + r.randrange(60)) if n % 19 else None) for n in range(500)]
    df = spark.createDataFrame(facts, "n int, k string, at date")
    args = (["k"], "at", ["v"], closed, how)
    # Where a closed interval ends on the day the next one begins, the join gives both; there are none here.
    assert rows(asof_carried(df, dim, *args)) == rows(asof_version(df, dim, *args))


def test_a_key_with_a_hundred_thousand_versions(spark):
    """One key holds all versions and most rows; rows and versions are cut over several tasks."""
    at = F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, 2 * id)")
    dim = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"), at.alias("valid_from"))
    dim = dim.withColumn("valid_to", F.expr("valid_from + interval 2 seconds"))
    rows_in = spark.range(50_000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("k"), "id",
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, 3 * id + 1)").alias("ts"),
    )
    got = asof_carried(rows_in, dim, ["k"], "ts", ["v"], closed=False)
    assert got.filter("v <> (3 * id + 1) div 2").count() == 0
    assert got.count() == rows_in.filter("k = 'hot' and 3 * id + 1 < 200000").count()


def test_the_newest_row_of_a_stream(spark, tmp_path):
    """Arrivals out of order over several batches end with the rows that `latest` picks from all of them."""
    schema = "id string, ts timestamp, city string, n int"
    arrivals = [
        [("a", instant("2026-05-02T10:00:00"), "B", 1), ("b", instant("2026-05-02T09:00:00"), "X", 1)],
        [("a", instant("2026-05-02T09:00:00"), "A", 9), ("c", instant("2026-05-02T11:00:00"), "C", None)],
        [("a", instant("2026-05-02T10:00:00"), "B", 2), ("b", instant("2026-05-02T12:00:00"), None, 3), ("c", instant("2026-05-02T11:00:00"), "C", 0)],
        [("d", None, "never", 1), ("a", instant("2026-05-02T10:30:00"), "E", 0)],
    ]
    seen = []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for k, part in enumerate(arrivals):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
            updates = latest_updates(stream, ["id"], ["ts", "n"], "ts", idle_ms=10 * 86_400_000)

            def keep(batch, batch_id):
                seen.append(batch.collect())

            query = updates.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/chk").trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    state = {}
    for batch in seen:
        for row in batch:
            state[row["id"]] = tuple(row)
    every = spark.createDataFrame([r for part in arrivals for r in part if r[1] is not None], schema)
    assert sorted(state.values()) == sorted(tuple(r) for r in latest(every, ["id"], ["ts", "n"]).collect())
    assert sum(len(batch) for batch in seen) == 2 + 1 + 3 + 1  # older rows give nothing
