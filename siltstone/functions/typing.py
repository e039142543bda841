"""Strict and tolerant casting against a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project exactly the declared columns, strictly cast: a bad value fails the query."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def tolerant(column: str | Column, data_type: T.DataType) -> Column:
    """Cast that yields NULL for a bad value.

    Whole numbers that do not parse as such are read through DECIMAL(38,0), so `2.5` becomes 3 and is
    not lost. The plain parse comes first since it is the cheap and usual case.
    """
    col = F.col(column) if isinstance(column, str) else column
    if isinstance(data_type, T.StringType):
        return col.cast("string")  # text stays as it is
    text = F.trim(col.cast("string"))
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        rounded = text.try_cast("decimal(38,0)").try_cast(data_type)
        return F.coalesce(text.try_cast(data_type), rounded)
    return text.try_cast(data_type)


def try_cast_to(
    df: DataFrame, schema: T.StructType, formats: dict[str, str] | None = None
) -> DataFrame:
    """Project the declared columns, bad values becoming NULL.

    `formats` names a datetime pattern for columns that are not in ISO form.
    """
    formats = formats or {}

    def one(field: T.StructField) -> Column:
        if field.name in formats:
            parsed = F.try_to_timestamp(F.col(field.name), F.lit(formats[field.name]))
            return parsed.cast(field.dataType).alias(field.name)
        return tolerant(field.name, field.dataType).alias(field.name)

    return df.select(*[one(f) for f in schema.fields])
