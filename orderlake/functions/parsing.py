"""Tolerant parsing of source text.

Spark 4 runs with ANSI mode on, where a plain ``cast`` or ``to_date`` raises
on malformed input.  Every parse here is a ``try_*`` form: bad input becomes
NULL and the null gates decide whether the run stops.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.functions._col import as_col


def parse_us_date(c: str | Column) -> Column:
    """``M/d/yyyy`` text (surrounding blanks ignored) -> DATE."""
    return F.try_to_date(F.trim(as_col(c)), K.US_DATE)


def parse_iso_date(c: str | Column) -> Column:
    """``yyyy-MM-dd`` text -> DATE."""
    return F.try_to_date(as_col(c), K.ISO_DATE)


def parse_us_timestamp(c: str | Column) -> Column:
    """``M/d/yyyy H:mm`` text -> TIMESTAMP_NTZ (wall-clock time, no zone).

    Parsed once, as a time of the zone written behind it, and counted from the epoch
    without a zone: every wall clock stays as written under any session zone, also one
    that a daylight-saving change skips.
    """
    at = F.try_to_timestamp(F.concat(F.trim(as_col(c)), F.lit("Z")), F.lit(K.US_TIMESTAMP + "X"))
    seconds = F.unix_seconds(at).cast("decimal(18,6)")
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds))


def to_bigint(c: str | Column) -> Column:
    return as_col(c).try_cast("bigint")


def to_double_num(c: str | Column) -> Column:
    return as_col(c).try_cast("double")


def to_whole_int(c: str | Column) -> Column:
    """Text holding a whole number, also written as ``2.0``, -> INT.

    Parsed through DOUBLE first: ``try_cast('2.0' as int)`` is NULL.  A
    fraction is not cut off: it gives NULL.
    """
    value = as_col(c).try_cast("double")
    return F.when(value == F.floor(value), value).try_cast("int")


def yes_no_flag(c: str | Column) -> Column:
    """``y``/``n`` (any case, blanks ignored) -> BOOLEAN, anything else NULL."""
    v = F.lower(F.trim(as_col(c)))
    return (F.when(v == "y", F.lit(True))
             .when(v == "n", F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))
