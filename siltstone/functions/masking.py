"""Role-dependent masking. A projection choice, not a security boundary."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import as_column

# Fixed values of the masking rules.
CLEAR_ROLES = ("ACCOUNTADMIN", "DE_ENGINEER")
EMAIL_MASK = "****@masked.com"
PHONE_MASK = "***-***-****"

Policy = Callable[[str, str], Column]


def mask_email(column: str | Column, role: str) -> Column:
    """Two leading characters stay visible; NULL stays NULL."""
    col = as_column(column)
    return col if role in CLEAR_ROLES else F.concat(F.left(col, F.lit(2)), F.lit(EMAIL_MASK))


def mask_phone(column: str | Column, role: str) -> Column:
    return as_column(column) if role in CLEAR_ROLES else F.lit(PHONE_MASK)


def masked_view(df: DataFrame, policies: Mapping[str, Policy], role: str) -> DataFrame:
    """What `role` may read: every column with a policy goes through it."""
    return df.select(
        *[policies[c](c, role).alias(c) if c in policies else F.col(c) for c in df.columns]
    )
