import decimal

import pytest
from conftest import day, rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import columns as C
from siltstone.functions.masking import mask_email, mask_phone, masked_view
from siltstone.functions.predicates import changed, changed_tsql, in_range, in_set, on_day, only_action, split_null
from siltstone.functions.scoring import score_keywords, score_numeric
from siltstone.functions.typing import cast_to, tolerant, try_cast_to
from siltstone.operators.evaluation import accuracy_by, cohort_gap


def test_strict_cast_raises_and_tolerant_cast_does_not(spark):
    df = spark.createDataFrame([("7",), ("2.5",), ("x",), (None,), (" 3 ",)], "n string")
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    with pytest.raises(PySparkException):
        cast_to(df, schema).collect()
    assert [r["n"] for r in try_cast_to(df, schema).collect()] == [7, 3, None, None, 3]


def test_formats(spark):
    df = spark.createDataFrame([("05/31/2026",), ("31/05/2026",)], "d string")
    schema = T.StructType([T.StructField("d", T.DateType())])
    got = [r["d"] for r in try_cast_to(df, schema, {"d": "MM/dd/yyyy"}).collect()]
    assert got == [day("2026-05-31"), None]


def test_decimal_overflow_is_null(spark):
    df = spark.createDataFrame([("123456789.00",), ("1.005",)], "n string")
    got = [r[0] for r in df.select(tolerant("n", T.DecimalType(8, 2))).collect()]
    assert got == [None, decimal.Decimal("1.01")]


def test_pad_id_never_cuts(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n bigint")
    assert [r[0] for r in df.select(C.pad_id("C", "n", 6)).collect()] == ["C000007", "C1234567"]


def test_dates(spark):
    df = spark.createDataFrame([(day("2026-01-01"),), (day("2026-05-03"),)], "d date")
    got = rows(C.calendar_parts(df, "d"))
    assert got == [
        (day("2026-01-01"), 20260101, 5, "Thursday", 1, 1, False),
        (day("2026-05-03"), 20260503, 1, "Sunday", 18, 5, True),
    ]
    with pytest.raises(ValueError):
        C.shift("d", 1, "weeks")


def test_blank_and_defaults(spark):
    df = spark.createDataFrame([(" ",), ("",), (None,), ("a ",)], "v string")
    assert [r["v"] for r in C.blank_to_null(df, ["v"]).collect()] == [None, None, None, "a "]
    assert [r[0] for r in df.select(C.is_blank("v")).collect()] == [True, True, True, False]
    assert [r["v"] for r in C.defaults(df, {"v": "?"}).collect()] == [" ", "", "?", "a "]


def test_map_case_with_and_without_default(spark):
    df = spark.createDataFrame([(0,), (1,), (9,)], "n int")
    got = df.select(C.map_case("n", {0: "a", 1: "b"}, "z"), C.map_case("n", {0: "a"})).collect()
    assert [tuple(r) for r in got] == [("a", "a"), ("b", None), ("z", None)]


def test_change_predicates(spark):
    df = spark.sql(
        """select * from values
           (1, named_struct('p', 1.0D, 't', 'x'), named_struct('p', 1.0D, 't', 'x')),
           (2, named_struct('p', null, 't', 'x'), named_struct('p', 2.0D, 't', 'x')),
           (3, named_struct('p', 1.0D, 't', null), named_struct('p', 1.0D, 't', '')),
           (4, named_struct('p', 1.0D, 't', 'x'), named_struct('p', 2.0D, 't', 'x')) as v(n, a, b)"""
    )
    got = rows(df.select("n", changed(["p", "t"])("a", "b"), changed_tsql("p", ["t"])("a", "b")))
    assert got == [(1, False, False), (2, True, False), (3, True, False), (4, True, True)]


def test_filters(spark):
    df = spark.createDataFrame([("2026-05-01", 1), ("junk", None)], "d string, n int")
    assert on_day(df, "d", "2026-05-01").count() == 1
    typed = df.withColumn("d", F.col("d").try_cast("date"))
    assert on_day(typed, "d", "2026-05-01").count() == 1
    assert [f.count() for f in split_null(df, "n")] == [1, 1]
    assert in_range(df, "n", 1, 1).count() == 1 and in_set(df, "n", [2, 3]).count() == 0
    assert only_action(df.withColumn("_action", F.lit("INSERT"))).count() == 2


def test_masking(spark):
    df = spark.createDataFrame([("ab@x.com", "1"), ("a", "2"), (None, None)], "email string, phone string")
    view = masked_view(df, {"email": mask_email, "phone": mask_phone}, "DE_ANALYST")
    assert [tuple(r) for r in view.collect()] == [
        ("ab****@masked.com", "***-***-****"), ("a****@masked.com", "***-***-****"), (None, "***-***-****"),
    ]
    clear = masked_view(df, {"email": mask_email, "phone": mask_phone}, "DE_ENGINEER")
    assert rows(clear) == rows(df)


def test_scoring(spark):
    df = spark.createDataFrame(
        [("about 105", 100.0), ("106", 100.0), ("-95", -100.0), ("0", 0.0), ("1", 0.0), ("none", 5.0),
         ("1,050 units", 1000.0), (None, 1.0)],
        "pred string, truth double",
    )
    got = [r["correct"] for r in score_numeric(df, "pred", "truth").collect()]
    assert got == [True, False, True, True, False, False, True, False]
    words = spark.createDataFrame(
        [("Red Bar chart", "bar, red"), ("Red", "bar, red"), ("x", ""), (None, "a")], "p string, k string"
    )
    assert [r["correct"] for r in score_keywords(words, "p", "k").collect()] == [True, False, False, False]
    assert [r["correct"] for r in score_keywords(words, "p", "k", "any").collect()] == [True, True, False, False]


def test_accuracy_leaves_failures_out(spark):
    df = spark.createDataFrame(
        [("2d", True, True), ("2d", True, False), ("2d", False, False), ("3d", True, False)],
        "cohort string, ok boolean, correct boolean",
    )
    assert rows(accuracy_by(df, ["cohort"], "ok", "correct")) == [("2d", 3, 2, 1, 50.0), ("3d", 1, 1, 0, 0.0)]
    assert rows(cohort_gap(df, "cohort", "2d", "3d", "ok", "correct")) == [(50.0, 0.0, 50.0)]


def test_unknown_column_is_reported(spark):
    with pytest.raises(AnalysisException):
        C.normalise(spark.range(1), ["missing"]).collect()
