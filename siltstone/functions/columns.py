"""Scalar column helpers. All of them stay inside generated code; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normal_key(value: str | Column) -> Column:
    """Business keys compare trimmed and in upper case."""
    return F.upper(F.trim(as_column(value)))


def normalise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: normal_key(c) for c in columns})


def blank_as_null(value: str | Column) -> Column:
    col = as_column(value)
    return F.when(F.trim(col) != "", col)


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: blank_as_null(c) for c in columns})


def is_blank(value: str | Column) -> Column:
    """True for NULL and for text of spaces only."""
    return F.coalesce(F.trim(as_column(value)) == "", F.lit(True))


def date_key(value: str | Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic: no formatter and no time zone involved."""
    col = as_column(value)
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def to_day(value: str | Column) -> Column:
    return F.to_date(as_column(value))


def hour_of(value: str | Column) -> Column:
    return F.date_trunc("hour", as_column(value)).cast("timestamp_ntz")


def weekend(value: str | Column) -> Column:
    """Day numbers start at 1 on Sunday."""
    return F.dayofweek(as_column(value)).isin(1, 7)


def calendar_parts(df: DataFrame, column: str) -> DataFrame:
    day = F.col(column)
    return df.withColumns(
        {
            "date_key": date_key(day),
            "day_of_week": F.dayofweek(day),
            "day_name": F.date_format(day, "EEEE"),
            "week_of_year": F.weekofyear(day),
            "month": F.month(day),
            "is_weekend": weekend(day),
        }
    )


def shift(value: str | Column, amount: int | Column, unit: str) -> Column:
    """Move a date by days or a timestamp by days, hours or minutes."""
    col = as_column(value)
    step = F.lit(amount) if isinstance(amount, int) else amount
    if unit == "date":
        return F.date_add(col, step)
    parts = {"days": "days", "hours": "hours", "minutes": "mins"}
    if unit not in parts:
        raise ValueError(f"unit {unit!r} is not one of date, {', '.join(parts)}")
    return col + F.make_dt_interval(**{parts[unit]: step})


def amount(
    quantity: str | Column, price: str | Column, precision: int = 18, scale: int = 2
) -> Column:
    """Quantity times price at a fixed decimal type."""
    return (as_column(quantity) * as_column(price)).cast(f"decimal({precision},{scale})")


def money(value: str | Column, scale: int = 2) -> Column:
    return F.round(as_column(value), scale).cast(f"decimal(18,{scale})")


def map_case(value: str | Column, cases: Mapping[Any, Any], default: Any = None) -> Column:
    """Replace listed values; everything else gets `default`."""
    col = as_column(value)
    chain = F
    for match, result in cases.items():
        chain = chain.when(col == F.lit(match), F.lit(result))
    return chain.otherwise(F.lit(default)) if default is not None else chain


def pad_id(prefix: str, value: str | Column, width: int) -> Column:
    """Prefix plus the zero-padded number. A number wider than `width` keeps all its digits."""
    text = as_column(value).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def defaults(df: DataFrame, mapping: Mapping[str, Any]) -> DataFrame:
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v))
            for c, v in mapping.items()
        }
    )


def stamp(df: DataFrame, run_ts: Column | None = None, name: str = "_updated_at") -> DataFrame:
    """Add the load instant; pass `run_ts` where a rerun has to reproduce it."""
    return df.withColumn(name, F.localtimestamp() if run_ts is None else run_ts)
