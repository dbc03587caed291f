"""String clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.functions._col import as_col


def is_blank(c: str | Column) -> Column:
    """True when the value is NULL or only spaces (never NULL itself)."""
    c = as_col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def clean_lower(c: str | Column) -> Column:
    """Trimmed, lower-cased text (status codes, customer types)."""
    return F.lower(F.trim(as_col(c)))


def clean_upper(c: str | Column) -> Column:
    """Trimmed, upper-cased text (currency codes)."""
    return F.upper(F.trim(as_col(c)))


def has_lower_case(c: str | Column) -> Column:
    """Whether upper-casing changes the text; false for NULL."""
    return ~F.upper(as_col(c)).eqNullSafe(as_col(c))
