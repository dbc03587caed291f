"""Daily series: calendar spine, forward fill with provenance, latest value.

No bounds or date lists travel through the driver: the bounds are scalar
subqueries planned by Spark, date membership is a join.

Size note: the spine has (days in range) x (series) rows, bounded by the
calendar, not by the number of input rows; the forward fill is computed per
(series, year) segment plus a carry over the per-segment summary, so no
window partition holds more than one year of one series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake import constants as K


def date_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """One row: ``min_date``, ``max_date``."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def _bounds(df: DataFrame, date_col: str):
    """First and last date of ``df`` as ONE scalar subquery (a global min/max
    aggregate, partial per task); Spark runs it once and inlines the result."""
    b = df.select(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))).scalar()
    return b["lo"], b["hi"]


def calendar_spine(df: DataFrame, date_col: str, series_col: str,
                   bounds=None) -> DataFrame:
    """Every day from the first to the last date of ``df``, for every series
    (``bounds``: the (first, last) pair of ``_bounds`` when already built)."""
    lo, hi = bounds or _bounds(df, date_col)
    days = F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY")))
    return (df.select(series_col).distinct()
              .select(days.alias(date_col), F.col(series_col)))


def calendar_years(df: DataFrame, date_col: str, series_col: str,
                   bounds=None) -> DataFrame:
    """Every (series, year) of the spine, as ``_seg``: one row per series and year."""
    lo, hi = bounds or _bounds(df, date_col)
    return (df.select(series_col).distinct()
              .select(F.col(series_col),
                      F.explode(F.sequence(F.year(lo), F.year(hi))).alias("_seg")))


def forward_fill(df: DataFrame, series_col: str, date_col: str, value_col: str,
                 out_col: str | None = None, known: DataFrame | None = None,
                 segments: DataFrame | None = None) -> DataFrame:
    """Last non-null ``value_col`` on or before each row's date, per series.

    Computed in bounded pieces: first within (series, year) segments, then
    each segment takes the last known value of the segments before it from a
    per-segment summary (one row per series and year).  No window partition
    ever holds more than one year of one series, however long the range, and
    the carry step works on the small summary.

    ``known`` (series, date, value rows) and ``segments`` (series, ``_seg``
    = year, one row per segment of ``df``) default to being derived from
    ``df``; callers that have them cheaper pass them in.
    """
    out_col = out_col or value_col
    base = df.withColumn("_seg", F.year(F.col(date_col)))
    in_seg = (Window.partitionBy(series_col, "_seg").orderBy(date_col)
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = base.withColumn("_in_seg", F.last(value_col, ignorenulls=True).over(in_seg))
    if known is None:
        known = df.select(series_col, date_col, value_col)
    if segments is None:
        segments = base.select(series_col, "_seg").distinct()
    summary = (known.filter(F.col(value_col).isNotNull())
                    .groupBy(series_col, F.year(F.col(date_col)).alias("_seg"))
                    .agg(F.max_by(value_col, date_col).alias("_seg_last")))
    before = (Window.partitionBy(series_col).orderBy("_seg")
                    .rowsBetween(Window.unboundedPreceding, -1))
    carry = (segments.join(summary, [series_col, "_seg"], "left")
                     .withColumn("_carry", F.last("_seg_last", ignorenulls=True).over(before))
                     .select(series_col, "_seg", "_carry"))
    return (filled.join(carry, [series_col, "_seg"], "left")
                  .withColumn(out_col, F.coalesce(F.col("_in_seg"), F.col("_carry")))
                  .drop("_seg", "_in_seg", "_carry"))


def fill_daily_rates(typed: DataFrame, date_col: str = "rate_date",
                     series_col: str = "currency", value_col: str = "rate_to_usd",
                     method_col: str = "_fx_fill_method",
                     per_series: bool = False) -> DataFrame:
    """Gap-filled daily series with the provenance of each value.

    Each (day, series) takes the last known value on or before that day.
    ``method_col``: ``no_rate_available`` before the first known value,
    ``actual`` when the day has a source row, else ``forward_filled``.
    By default "has a source row" is decided by date alone (any series),
    as in the source pipeline; ``per_series=True`` decides per series.
    """
    known = typed.select(date_col, series_col, value_col)
    if per_series:
        known = known.withColumn("_actual", F.lit(True))
    bounds = _bounds(typed, date_col)            # one subquery for spine and segments
    spine = calendar_spine(typed, date_col, series_col, bounds)
    joined = spine.join(known, [date_col, series_col], "left")
    if not per_series:
        dates = typed.select(date_col).distinct().withColumn("_actual", F.lit(True))
        joined = joined.join(dates, date_col, "left")
    filled = forward_fill(joined, series_col, date_col, value_col,
                          known=typed.select(series_col, date_col, value_col),
                          segments=calendar_years(typed, date_col, series_col, bounds))
    return (filled.select(date_col, series_col, value_col,
                          F.coalesce(F.col("_actual"), F.lit(False)).alias("_actual"))
                  .withColumn(method_col,
                              F.when(F.col(value_col).isNull(), F.lit(K.FILL_NONE))
                               .when(F.col("_actual"), F.lit(K.FILL_ACTUAL))
                               .otherwise(F.lit(K.FILL_FORWARD)))
                  .drop("_actual"))


def latest_value_per_series(df: DataFrame, series_col: str = "currency",
                            date_col: str = "rate_date", value_col: str = "rate_to_usd",
                            out_col: str = "latest_rate") -> DataFrame:
    """Per series, the non-null value at the latest date that has one."""
    return (df.filter(F.col(value_col).isNotNull())
              .groupBy(series_col)
              .agg(F.max_by(value_col, date_col).alias(out_col)))
