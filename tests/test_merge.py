import pytest
from conftest import day, instant, plan, rows
from pyspark.sql import functions as F

from siltstone.functions.predicates import changed_tsql
from siltstone.operators import joins, merge
from siltstone.operators.keys import dense_key
from siltstone.session import pin

DIM = "id string, city string, state string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
DELTA = "id string, city string, state string, ts timestamp_ntz"
T0, T1, T2 = (instant(f"2026-05-0{n}T00:00:00") for n in (1, 2, 3))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [
            ("moved", "A", "VA", T1, None, True),
            ("state", "A", "VA", T1, None, True),
            ("same", "A", "VA", T1, None, True),
            ("filled", None, "VA", T1, None, True),
            ("late", "A", "VA", T1, None, True),
            ("old", "Z", "VA", T0, T1, False),
            ("old", "A", "VA", T1, None, True),
        ],
        DIM,
    )


@pytest.fixture(scope="module")
def delta(spark):
    return spark.createDataFrame(
        [
            ("moved", "B", "CO", T2),
            ("state", "A", "CO", T2),
            ("same", "A", "VA", T2),
            ("filled", "B", "VA", T2),
            ("late", "B", "VA", T0),
            ("new", "N", "VA", T2),
        ],
        DELTA,
    )


@pytest.fixture(params=[0, 1 << 20], ids=["outer_join", "broadcast_batch"])
def batch_limit(request, monkeypatch):
    """Both ways of pairing a batch with its target."""
    monkeypatch.setattr(joins, "BATCH_BYTES", request.param)
    return request.param


def test_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(100000).select("id", F.col("id").alias("v"))
    source = spark.createDataFrame([(5, 50), (-1, 1)], "id bigint, v bigint")
    pairs = joins.pair_rows(target, source, ["id"])
    assert "hashpartitioning" not in plan(pairs)
    assert pairs.count() == 100001


def test_scd2_timestamp_cases(dim, delta, batch_limit):
    got = merge.scd2_apply(dim, delta, ["id"], ["city"], "ts")
    found = rows(got, "id", "city", "state", "valid_from", "valid_to", "is_current")
    assert found == sorted(
        [
            ("moved", "A", "VA", T1, T2, False), ("moved", "B", "CO", T2, None, True),
            ("state", "A", "VA", T1, None, True),
            ("same", "A", "VA", T1, None, True),
            ("filled", None, "VA", T1, T2, False), ("filled", "B", "VA", T2, None, True),
            ("late", "A", "VA", T1, None, True),
            ("old", "Z", "VA", T0, T1, False), ("old", "A", "VA", T1, None, True),
            ("new", "N", "VA", T2, None, True),
        ],
        key=repr,
    )
    assert rows(merge.late_changes(dim, delta, ["id"], ["city"], "ts"), "id") == [("late",)]


def test_scd2_replay_changes_nothing(dim, delta):
    once = pin(merge.scd2_apply(dim, delta, ["id"], ["city"], "ts"))
    twice = merge.scd2_apply(once, delta, ["id"], ["city"], "ts")
    assert rows(once) == rows(twice)


def test_scd2_late_applied_on_request(dim, delta):
    got = merge.scd2_apply(dim, delta, ["id"], ["city"], "ts", late="apply")
    late = rows(got.filter("id = 'late'"), "city", "valid_from", "valid_to", "is_current")
    assert late == sorted([("A", T1, T0, False), ("B", T0, None, True)], key=repr)


def test_scd2_missing_instant_uses_run_time(spark, dim):
    delta = spark.createDataFrame([("moved", "B", "VA", None), ("new", "N", "VA", None)], DELTA)
    run = F.lit("2026-05-09 00:00:00").cast("timestamp_ntz")
    got = merge.scd2_apply(dim, delta, ["id"], ["city"], "ts", run_ts=run)
    at = instant("2026-05-09T00:00:00")
    assert rows(got.filter("id = 'moved'"), "valid_from", "valid_to") == sorted([(T1, at), (at, None)], key=repr)


def test_scd2_surrogates_continue(dim, delta):
    keyed = dense_key(dim, ["id", "valid_from"], "sk")
    got = merge.scd2_apply(keyed, delta, ["id"], ["city"], "ts", surrogate="sk")
    kept = {r["sk"] for r in keyed.collect()}
    added = rows(got.filter(~F.col("sk").isin(list(kept))), "sk", "id")
    assert sorted(added) == [(8, "filled"), (9, "moved"), (10, "new")]
    assert got.select("sk").distinct().count() == got.count()


def test_scd2_daily_closes_the_day_before(spark):
    dim = spark.createDataFrame(
        [
            ("up", "X", "c", 1.0, day("2026-05-01"), None, True),
            ("null_price", "X", "c", None, day("2026-05-01"), None, True),
            ("blank", "X", None, 1.0, day("2026-05-01"), None, True),
        ],
        "item string, name string, cat string, price double, valid_from date, valid_to date, is_current boolean",
    )
    delta = spark.createDataFrame(
        [("up", "X", "c", 2.0), ("null_price", "X", "c", 5.0), ("blank", "X", "", 1.0)],
        "item string, name string, cat string, price double",
    ).withColumn("d", F.lit("2026-05-11").cast("date"))
    got = merge.scd2_apply(
        dim, delta, ["item"], changed_tsql("price", ["cat", "name"]), "d", interval="closed_day"
    )
    assert rows(got, "item", "price", "valid_to", "is_current") == sorted(
        [
            ("up", 1.0, day("2026-05-10"), False), ("up", 2.0, None, True),
            ("null_price", None, None, True), ("blank", 1.0, None, True),
        ],
        key=repr,
    )


def test_log_rebuild_equals_stepwise_merges(spark):
    log = spark.createDataFrame(
        [
            (f"k{k}", f"c{(k * b * 7) % 3}", "s", instant(f"2026-01-0{b + 1}T00:00:00"), b)
            for k in range(40)
            for b in range(5)
            if (k + b) % 3
        ],
        "id string, city string, state string, ts timestamp_ntz, batch int",
    )
    dim = merge.open_versions(log.filter("batch = 0").drop("batch"), "ts")
    for b in range(1, 5):
        delta = log.filter(f"batch = {b}").drop("batch")
        dim = pin(merge.scd2_apply(dim, delta, ["id"], ["city"], "ts"))
    rebuilt = merge.scd2_from_log(log, ["id"], ["city"], "ts", "batch")
    assert rows(rebuilt.select(*dim.columns)) == rows(dim)
    current = dim.filter("is_current").groupBy("id").count().filter("count <> 1")
    assert current.count() == 0


def test_upsert_touches_only_update_columns_and_is_idempotent(spark, batch_limit):
    schema = "id string, sk int, status string, total int, _updated_at timestamp_ntz"
    target = spark.createDataFrame([("a", 1, "new", 5, T0), ("b", 2, "new", 6, T0)], schema)
    source = spark.createDataFrame([("a", 9, "done", 7, T1), ("c", 3, "new", 8, T1)], schema)
    run = F.lit("2026-05-03 00:00:00").cast("timestamp_ntz")
    once = merge.upsert(target, source, ["id"], ["status", "total"], run)
    assert rows(once) == [("a", 1, "done", 7, T2), ("b", 2, "new", 6, T0), ("c", 3, "new", 8, T2)]
    assert rows(merge.upsert(once, source, ["id"], ["status", "total"], run)) == rows(once)


def test_merge_actions(dim, delta, batch_limit):
    got = dict(rows(merge.merge_actions(dim, delta, ["id"], ["city"])))
    assert got == {
        "moved": "update", "filled": "update", "late": "update", "new": "insert",
        "state": "none", "same": "none",
    }


def test_state_as_of_boundaries(dim):
    at = F.lit(T1)
    got = merge.state_as_of(dim.filter("id = 'old'"), at.cast("timestamp_ntz"))
    assert rows(got, "city") == [("A",)]


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w")], "k int, v string")
    assert rows(merge.table_diff(a, b, ["k"], ["v"])) == [
        (2, "changed", None, "y"), (3, "only_a", "z", None), (4, "only_b", None, "w"),
    ]
