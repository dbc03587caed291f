"""Calendar attributes of a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.functions._col import as_col


def date_key(c: str | Column) -> Column:
    """Integer surrogate key ``yyyyMMdd``; sorts like the date."""
    return F.date_format(as_col(c), K.DATE_KEY_FORMAT).cast("int")


def month_name(c: str | Column) -> Column:
    return F.date_format(as_col(c), K.MONTH_NAME_FORMAT)


def day_name(c: str | Column) -> Column:
    return F.date_format(as_col(c), K.DAY_NAME_FORMAT)


def is_weekend(c: str | Column) -> Column:
    """Saturday or Sunday (``dayofweek``: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(as_col(c)).isin(1, 7)
