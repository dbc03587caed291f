"""Row classification, quarantine tagging and data-quality gates.

Classification is one projection: every raw row gets at most one error code,
so clean rows and quarantined rows come from the same scan and the two can
never overlap or miss a row silently (see ``conservation``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.functions.text import is_blank

CODE = "_error_code"
CLEAN = "_is_clean"
CORRUPT = "_corrupt_line"        # file scans: the whole line if it does not fit the schema
INTERNAL = (CODE, CLEAN, CORRUPT)
CLASSES = ("clean", "quarantined", "unclassified")


class QualityGateError(ValueError):
    """Raised by a gate in ``raise`` mode."""


def classify_orders(df: DataFrame, cust_col: str = "cust_id",
                    qty_col: str = "quantity_raw",
                    flag_missing_qty: bool = False) -> DataFrame:
    """Add ``_error_code`` and ``_is_clean``.

    Precedence: a malformed line (``CORRUPT`` set by the scan), then a missing or
    blank customer id, then a bad quantity.
    A quantity is bad when it parses as a number with a fractional part.
    A quantity that is missing or not a number is, by default, neither clean
    nor quarantined (the source pipeline's behaviour: such rows disappear);
    ``flag_missing_qty=True`` quarantines them as ``MISSING_QTY`` instead.
    """
    qty = F.col(qty_col).try_cast("double")
    frac = qty % 1
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    code = (F.when(broken, F.lit(K.MALFORMED))
             .when(is_blank(cust_col), F.lit(K.NULL_CUST_ID))
             .when(frac != 0, F.lit(K.INVALID_QTY)))
    if flag_missing_qty:
        code = code.when(qty.isNull(), F.lit(K.MISSING_QTY))
    return (df.withColumn(CODE, code)
              .withColumn(CLEAN, F.col(CODE).isNull() & F.coalesce(frac == 0, F.lit(False))))


def _message(code: Column, messages: dict[str, str] | None = None) -> Column:
    msg = F.lit(None).cast("string")
    known = messages or {**K.ERROR_MESSAGES, K.MISSING_QTY: K.MISSING_QTY_MESSAGE,
                         K.MALFORMED: K.MALFORMED_MESSAGE}
    for c, text in known.items():
        msg = F.when(code == c, F.lit(text)).otherwise(msg)
    return msg


def error_message(classified: DataFrame, messages: dict[str, str] | None = None) -> Column:
    """The message of a row's code, and the text of a malformed line."""
    text = _message(F.col(CODE), messages)
    if CORRUPT in classified.columns:
        text = F.when(F.col(CODE).isNotNull(), F.concat_ws(" ", text, F.col(CORRUPT)))
    return text


def row_class() -> Column:
    """What becomes of a classified row: ``CLASSES``."""
    return (F.when(F.col(CLEAN), CLASSES[0]).when(F.col(CODE).isNotNull(), CLASSES[1])
             .otherwise(CLASSES[2]))


def split_counts(written: DataFrame, copies: str) -> dict[str, int]:
    """The ``conservation`` counts and ``duplicate_rows``, from the written split: two
    narrow columns of committed files, which no retried task can change."""
    rows = {r["_class"]: r for r in written.groupBy("_class").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(copies).alias("raw")).collect()}  # three at most
    kept, raw = ({c: int(rows[c][n]) if c in rows else 0 for c in CLASSES} for n in ("rows", "raw"))
    return {"raw_rows": sum(raw.values()), "clean_rows": raw[CLASSES[0]],
            "quarantined_rows": kept[CLASSES[1]], "unclassified_rows": kept[CLASSES[2]],
            "duplicate_rows": raw[CLASSES[0]] - kept[CLASSES[0]]}


def tag_quarantine(classified: DataFrame, source_file: str | Column,
                   run_ts: Column | None = None,
                   messages: dict[str, str] | None = None) -> DataFrame:
    """Quarantined rows with code, message (of ``messages``, else the fixed ones),
    source file and run time."""
    src = F.lit(source_file) if isinstance(source_file, str) else source_file
    if "_source_file" in classified.columns:      # file scans carry their own path
        src = F.col("_source_file")
    text = error_message(classified, messages)
    base = [c for c in classified.columns if c not in (*INTERNAL, "_source_file")]
    out = (classified.filter(F.col(CODE).isNotNull())
                     .select(*base, F.col(CODE),
                             text.alias("_error_message"),
                             src.alias("_source_file")))
    if run_ts is not None:
        out = out.withColumn("_ingested_at", run_ts)
    return out


def fitting_lines(df: DataFrame) -> DataFrame:
    """The rows whose line had the declared columns, without the scan's ``CORRUPT``."""
    if CORRUPT not in df.columns:
        return df
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def broken_lines(feeds: dict[str, DataFrame]) -> DataFrame | None:
    """The other rows of all ``feeds`` whose scan keeps them: feed, the first column as
    far as it was read, the line and its file; None if no scan does."""
    parts = [df.where(F.col(CORRUPT).isNotNull()).select(
                 F.lit(name).alias("feed"), F.col(df.columns[0]).alias("first_field"),
                 F.col(CORRUPT).alias("line"), F.lit(K.MALFORMED).alias(CODE),
                 F.col("_source_file") if "_source_file" in df.columns
                 else F.lit(name).alias("_source_file"))
             for name, df in feeds.items() if CORRUPT in df.columns]
    return reduce(DataFrame.unionByName, parts) if parts else None


def clean_rows(classified: DataFrame) -> DataFrame:
    base = [c for c in classified.columns if c not in INTERNAL]
    return classified.filter(F.col(CLEAN)).select(*base)


def quarantine_counts(classified: DataFrame) -> DataFrame:
    """Rows per error code (codes that occur only)."""
    return (classified.filter(F.col(CODE).isNotNull())
                      .groupBy(F.col(CODE).alias("error_code"))
                      .agg(F.count(F.lit(1)).alias("rows")))


def _conservation() -> list[Column]:
    return [F.count(F.lit(1)).alias("raw_rows"),
            F.count_if(F.col(CLEAN)).alias("clean_rows"),
            F.count_if(F.col(CODE).isNotNull()).alias("quarantined_rows"),
            F.count_if(~F.col(CLEAN) & F.col(CODE).isNull()).alias("unclassified_rows")]


def conservation(classified: DataFrame) -> DataFrame:
    """One row: raw, clean, quarantined and unclassified row counts."""
    return classified.agg(*_conservation())


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of each column, one row per column, from ONE aggregation."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (wide.unpivot([], list(columns), "column_name", "null_count")
                .select("column_name", F.col("null_count").cast("bigint")))


def check_nulls(df: DataFrame, columns: Sequence[str], label: str,
                mode: str = "raise") -> dict[str, int]:
    """Gate: no NULLs in ``columns``.  One job for all columns.

    ``mode='raise'`` stops the run with the per-column counts;
    ``mode='report'`` returns the counts and lets the run continue.
    """
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    counts = {c: int(row[c]) for c in columns}
    if mode == "raise":
        check_nulls_counts(counts, label)
    return counts


def check_nulls_counts(counts: dict[str, int], label: str) -> None:
    """Raise when any of the given NULL counts is positive."""
    missing = sorted(c for c, n in counts.items() if n > 0)
    if missing:
        raise QualityGateError(
            f"{label}: NULLs in required columns " +
            "; ".join(f"{c} in {counts[c]} rows" for c in missing))


def check_unique(df: DataFrame, keys: Sequence[str], label: str) -> None:
    """Gate: no two rows of ``df`` share ``keys``."""
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").first()
    if again is not None:
        raise QualityGateError(f"{label}: several rows for {again.asDict()}")


def check_conserved(counts: dict[str, int], label: str, mode: str = "raise") -> None:
    """Gate: every raw row is clean or quarantined (``conservation`` counts)."""
    lost = counts["unclassified_rows"]
    if lost and mode == "raise":
        raise QualityGateError(f"{label}: {lost} of {counts['raw_rows']} raw rows are neither "
                               "clean nor quarantined")


def check_row_count(df_or_count: DataFrame | int, min_rows: int, label: str) -> int:
    """Gate: at least ``min_rows`` rows.  Accepts a count already observed
    during a write, so no extra job is needed."""
    rows = df_or_count if isinstance(df_or_count, int) else df_or_count.count()
    short = min_rows - rows
    if short > 0:
        raise QualityGateError(f"{label}: {rows} rows, {short} fewer than required")
    return rows
