"""Row filters and the two notions of "changed"."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Builds a predicate from the aliases of the old and the new row.
Differs = Callable[[str, str], Column]


def split_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows where the column is NULL, rows where it is set)."""
    return df.filter(F.col(column).isNull()), df.filter(F.col(column).isNotNull())


def in_range(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Both ends included; stays a plain comparison so that it reaches the scan."""
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))


def in_set(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def on_day(df: DataFrame, column: str, day: Any) -> DataFrame:
    """Rows of one day. A DATE column is compared as is (pushed down, prunes partitions); text is
    cast tolerantly."""
    if df.schema[column].dataType.typeName() == "date":
        return df.filter(F.col(column) == F.lit(day).cast("date"))
    return df.filter(F.col(column).try_cast("date") == F.lit(day).cast("date"))


def only_action(df: DataFrame, action: str = "INSERT", column: str = "_action") -> DataFrame:
    return df.filter(F.col(column) == action)


def changed(columns: Sequence[str]) -> Differs:
    """Null-safe inequality over the listed columns."""

    def differs(old: str, new: str) -> Column:
        return reduce(
            or_, [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in columns]
        )

    return differs


def changed_tsql(price: str, text: Sequence[str]) -> Differs:
    """Price inequality that NULL never satisfies; text inequality where NULL equals blank."""

    def differs(old: str, new: str) -> Column:
        tests = [F.coalesce(F.col(f"{old}.{price}") != F.col(f"{new}.{price}"), F.lit(False))]
        tests += [
            F.coalesce(F.col(f"{old}.{c}"), F.lit("")) != F.coalesce(F.col(f"{new}.{c}"), F.lit(""))
            for c in text
        ]
        return reduce(or_, tests)

    return differs
