import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators import quality as Q
from siltstone.plans import daily, retail


def table(spark, bad, total):
    return spark.range(total).select(F.when(F.col("id") >= bad, "x").alias("sku"))


@pytest.mark.parametrize(
    ("bad", "total", "passed"), [(1, 100, True), (2, 100, False), (3, 100, False), (0, 0, False)]
)
def test_null_rate_limit_is_strict(spark, bad, total, passed):
    metrics = Q.gate_null_rate(table(spark, bad, total), "sku")
    row = metrics.first()
    assert (row["failed_rows"], row["total_rows"], row["passed"]) == (bad, total, passed)
    if passed:
        Q.enforce(metrics)
    else:
        with pytest.raises(Q.DataQualityError):
            Q.enforce(metrics)


def test_enforce_rejects_no_metrics_at_all(spark):
    with pytest.raises(Q.DataQualityError):
        Q.enforce(Q.gate_null_rate(table(spark, 0, 0), "sku", by=["sku"]))


def test_null_keys_counts_blank_of_either_part(spark):
    df = spark.createDataFrame([("a", "b"), (" ", "b"), ("a", None), (None, "")], "item string, store string")
    row = Q.gate_null_keys(df, ["item", "store"]).first()
    assert (row["failed_rows"], row["total_rows"]) == (3, 4)


def test_duplicates_count_keys_and_keep_blank_in_the_denominator(spark):
    df = spark.createDataFrame(
        [("s", "a"), (" S", "A "), ("s", "b"), ("s", None), ("s", "")], "store string, item string"
    )
    row = Q.gate_duplicates(df, ["store", "item"], "item").first()
    assert (row["failed_rows"], row["total_rows"], row["passed"]) == (1, 3, False)


def test_referential_counts_nameless_unknown_rows(spark):
    df = spark.createDataFrame(
        [("a", ""), ("a", "n"), ("x", " "), ("x", None), ("y", "named"), ("", "")],
        "item string, name string",
    )
    dim = spark.createDataFrame([("A",)], "item string")
    row = Q.gate_referential(df, dim, "item", "name").first()
    assert (row["failed_rows"], row["total_rows"]) == (2, 6)


def test_reject_reason_precedence(spark):
    deduped = spark.createDataFrame(
        [("1", None, 0), ("2", "nope", 0), ("3", "nope", 1), ("4", "ok", 1), ("5", "ok", None)],
        "id string, sku string, qty int",
    )
    products = spark.createDataFrame([("ok",), ("ok",)], "sku string")
    flagged = retail.flagged_sales(deduped, products)
    assert rows(flagged, "id", "reject_reason") == sorted(
        [("1", "NULL_SKU"), ("2", "BAD_QTY"), ("3", "UNKNOWN_SKU"), ("4", None), ("5", "BAD_QTY")],
        key=repr,
    )
    clean, bad = Q.split_quarantine(flagged)
    assert clean.count() + bad.count() == deduped.count()
    assert "reject_reason" not in clean.columns


def test_dq_log_and_acceptance(spark):
    metrics = [Q.gate_null_rate(table(spark, 0, 10), "sku"), Q.gate_null_rate(table(spark, 9, 10), "sku")]
    log = Q.dq_log(metrics)
    assert set(Q.METRIC_COLUMNS) < set(log.columns) and log.count() == 2
    checks = Q.acceptance({"none": spark.range(0), "two": spark.range(2)})
    assert rows(checks) == [("none", 0, True), ("two", 2, False)]


def test_load_log_names_failures_and_skips_the_rest(spark):
    ran = []

    def broken():
        raise Q.DataQualityError("gate")

    steps = [("one", lambda: 3), ("two", broken), ("three", lambda: ran.append(1))]
    log = Q.load_log(spark, "p", datetime.date(2026, 5, 1), steps)
    found = [(r["step"], r["rows_affected"], r["status"]) for r in log.collect()]
    assert found == [("one", 3, "SUCCESS"), ("two", None, "FAILED"), ("three", None, "SKIPPED")]
    assert ran == []


RAW = (
    "business_date string, store_id string, item_id string, item_name string, category string, "
    "unit_price string, qty_sold string, gross_sales string, txn_count string, _loaded_at int"
)


def test_silver_sales_does_not_fall_back_to_an_older_row(spark):
    raw = spark.createDataFrame(
        [
            ("2026-05-01", "s1", "m1", "n", "c", "2.50", "4", "10.00", "2", 1),
            ("2026-05-01", "S1 ", "M1", "n", "c", "bad", "4", "10.00", "2", 2),
            ("2026-05-01", "s1", "m2", "n", "c", "2.50", "4", "10.00", "2", 1),
            ("2026-05-01", "s1", " ", "n", "c", "2.50", "4", "10.00", "2", 1),
            ("2026-05-01", " ", "m3", "n", "c", "2.50", "4", "10.00", "2", 1),
            ("yesterday", "s1", "m4", "n", "c", "2.50", "4", "10.00", "2", 1),
        ],
        RAW,
    )
    silver = daily.silver_sales(raw, ("_loaded_at",))
    assert rows(silver, "store_id", "item_id") == [("S1", "M2")]
    assert rows(daily.rejected_sales(raw), "reject_reason") == [("BAD_DATE",), ("NULL_ITEM",), ("NULL_STORE",)]
