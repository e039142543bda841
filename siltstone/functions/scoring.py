"""Automated scoring of predictions against truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Relative tolerance of the "relaxed accuracy" measure of published chart question answering work.
RELAXED_TOLERANCE = 0.05
# First number in free text: optional sign, digits with optional thousands commas and fraction.
NUMBER_PATTERN = r"-?\d[\d,]*(?:\.\d+)?"


def number_in(text: Column) -> Column:
    """First number in the text as DECIMAL(38,6), NULL when there is none."""
    found = F.regexp_extract(text, NUMBER_PATTERN, 0)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("decimal(38,6)")


def score_numeric(
    df: DataFrame, pred: str, truth: str, tol: float = RELAXED_TOLERANCE, name: str = "correct"
) -> DataFrame:
    """True when the prediction is within `tol` of the truth; a zero truth needs equality.

    An unreadable prediction is wrong, not unknown.
    """
    p = number_in(F.col(pred))
    t = F.col(truth).cast("decimal(38,6)")
    bound = F.abs(t) * F.lit(tol).cast("decimal(10,6)")
    return df.withColumn(name, F.coalesce(F.abs(p - t) <= bound, F.lit(False)))


def score_keywords(
    df: DataFrame, pred: str, keywords: str, mode: str = "all", name: str = "correct"
) -> DataFrame:
    """Keyword match on lower-cased text; `keywords` holds a comma-separated list.

    An empty list or a missing prediction is wrong.
    """
    text = F.lower(F.col(pred))
    words = F.filter(
        F.transform(F.split(F.lower(F.col(keywords)), ","), lambda w: F.trim(w)), lambda w: w != ""
    )
    found = {
        "all": F.forall(words, lambda w: text.contains(w)),
        "any": F.exists(words, lambda w: text.contains(w)),
    }[mode]
    return df.withColumn(name, F.coalesce((F.size(words) > 0) & found, F.lit(False)))
