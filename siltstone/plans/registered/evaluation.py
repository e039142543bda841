"""Scoring of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.scoring import score_keywords, score_numeric
from siltstone.operators.dedupe import latest_success
from siltstone.operators.evaluation import accuracy_by, cohort_gap
from siltstone.plans import shapes
from siltstone.plans.registry import query


def scored(spark: SparkSession, d: str) -> DataFrame:
    rows = score_numeric(shapes.predictions(spark, d), "prediction", "truth")
    return rows.withColumn("ok", F.col("status") == "ok")


@query(
    "score_relaxed_numeric",
    "select item_id, attempt, truth, prediction, correct from scored",
)
def relaxed_numeric(spark, d):
    return scored(spark, d).select("item_id", "attempt", "truth", "prediction", "correct")


@query(
    "score_keyword",
    """select doc_id, contains(lower(text), 'the') and contains(lower(text), 'ion') as all_found,
              contains(lower(text), 'the') or contains(lower(text), 'ion') as any_found
       from documents""",
)
def keyword(spark, d):
    documents = shapes.table(spark, d, "documents").select("doc_id", "text")
    rows = documents.withColumn("keywords", F.lit("The, ION"))
    both = score_keywords(rows, "text", "keywords", "all", "all_found")
    return score_keywords(both, "text", "keywords", "any", "any_found").select(
        "doc_id", "all_found", "any_found"
    )


@query(
    "accuracy_by_group",
    """select category, count(*) as attempted, count(*) filter (where status = 'ok') as scored,
              count(*) filter (where status = 'ok' and correct) as correct_rows,
              round(count(*) filter (where status = 'ok' and correct) * 100.0
                    / count(*) filter (where status = 'ok'), 4) as accuracy_pct
       from scored group by 1""",
)
def accuracy(spark, d):
    return accuracy_by(scored(spark, d), ["category"], "ok", "correct")


@query(
    "cohort_gap",
    """select category, round(a, 4) as accuracy_a, round(b, 4) as accuracy_b,
              round(a - b, 4) as gap_points
       from (select category,
                    count(*) filter (where status = 'ok' and cohort = '2d' and correct) * 100.0
                    / count(*) filter (where status = 'ok' and cohort = '2d') as a,
                    count(*) filter (where status = 'ok' and cohort = '3d' and correct) * 100.0
                    / count(*) filter (where status = 'ok' and cohort = '3d') as b
             from scored group by 1)""",
)
def gap(spark, d):
    return cohort_gap(scored(spark, d), "cohort", "2d", "3d", "ok", "correct", ["category"])


@query(
    "latest_success",
    """select item_id, attempt, status, prediction, answered_at from predictions
       qualify row_number() over (partition by item_id
                                  order by status = 'ok' desc, answered_at desc) = 1""",
)
def newest_success(spark, d):
    rows = latest_success(shapes.predictions(spark, d), ["item_id"], "status", "answered_at")
    return rows.select("item_id", "attempt", "status", "prediction", "answered_at")
