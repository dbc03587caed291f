"""Ingest stage: decide per raw row to keep, fix later, or quarantine.

Input: the five raw feeds (text columns, see ``sources.schemas``).
Output: lazily defined frames; nothing is computed here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.functions import clean_upper, has_lower_case, parse_us_date
from orderlake.operators import dedup, quality
from orderlake.sources.readers import WRITE_ORDER


def latest_customers(raw: DataFrame) -> DataFrame:
    """Newest snapshot per customer (by ``created_at``, ties by the other
    columns)."""
    return dedup.keep_one_per_key(raw, ["cust_id"], order=parse_us_date("created_at"),
                                  descending=True)


def classified_orders(raw: DataFrame, flag_missing_qty: bool = False) -> DataFrame:
    return quality.classify_orders(raw, "cust_id", "quantity_raw",
                                   flag_missing_qty=flag_missing_qty)


def split_orders(classified: DataFrame, source_file: str,
                 run_ts: Column | None = None) -> DataFrame:
    """Clean rows without exact copies, and all others, in one pass: the columns of
    both tables, ``_class`` and ``_copies`` (raw rows that a clean row stands for).

    Lines of one order with different products are different rows and all stay.
    Lineage columns (``_source_file``, ...) are not part of the comparison; the least
    path of equal rows is kept.
    """
    data = [c for c in classified.columns if not c.startswith("_")]
    files = "_source_file" if "_source_file" in classified.columns else None
    rows = classified.select(
        *data, F.col(quality.CODE), quality.error_message(classified).alias("_error_message"),
        quality.row_class().alias("_class"), *([files] if files else []))
    out = dedup.distinct_rows(rows, [*data, quality.CODE, "_error_message", "_class"],
                              F.col("_class") != quality.CLASSES[0], files)
    if not files:
        out = out.withColumn("_source_file", F.lit(source_file))
    if run_ts is not None:
        out = out.withColumn("_ingested_at", run_ts)
    return out


def clean_orders(classified: DataFrame, tasks: int | None = None) -> DataFrame:
    """The clean rows of the split, with their lineage if they have one.

    All of them have the same code, message and class, so they are equal if their data
    are: the others are left out before, and the aggregate holds the data alone.  With
    ``tasks`` (``joins.tasks_for`` the feed) the rows are dealt over so many before, and
    a task's hash table does not grow with the feed; else Spark combines them in each
    map task first, and the session's shuffle width says how many meet in one.
    """
    rows = quality.clean_rows(classified)
    data = [c for c in rows.columns if not c.startswith("_")]
    if tasks:
        rows = rows.repartition(tasks, *data)
    files = "_source_file" if "_source_file" in rows.columns else None
    return dedup.distinct_rows(rows, data, file_col=files).select(*rows.columns)


def quarantined_orders(classified: DataFrame, source_file: str,
                       run_ts: Column | None = None) -> DataFrame:
    return quality.tag_quarantine(classified, source_file, run_ts)


def flag_currency_case(raw_products: DataFrame) -> DataFrame:
    """Note rows whose currency code is not upper case (fixed in silver)."""
    return raw_products.select(
        "*", F.when(has_lower_case("currency"), K.CURRENCY_NOTE).alias("_currency_note"))


def latest_fx(raw_fx: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Last written rate per date and cleaned currency code: codes that differ
    by case or blanks only are one currency.  The row keeps its code as received.
    Files are in the order of ``sources.with_write_order`` where the feed has it."""
    order = [c for c in WRITE_ORDER if c in raw_fx.columns]
    coded = raw_fx.withColumn("_code", clean_upper("currency"))
    return dedup.last_write_wins(coded, ["date", "_code"], [*order, seq_col]) \
        .drop("_code", *order)


@dataclass
class Bronze:
    customers: DataFrame
    orders: DataFrame
    products: DataFrame
    categories: DataFrame
    fx_rates: DataFrame
    errors: DataFrame
    classified: DataFrame
    split: DataFrame            # both, in one pass
    broken: DataFrame | None    # lines of the other feeds without the declared columns


def build(feeds: dict[str, DataFrame], source_file: str = "raw_orders",
          run_ts: Column | None = None, flag_missing_qty: bool = False,
          order_tasks: int | None = None) -> Bronze:
    classified = classified_orders(feeds["orders"], flag_missing_qty)
    others = {name: df for name, df in feeds.items() if name != "orders"}
    good = {name: quality.fitting_lines(df) for name, df in others.items()}
    return Bronze(
        customers=latest_customers(good["customers"]),
        orders=clean_orders(classified, order_tasks),
        products=flag_currency_case(good["products"]),
        categories=good["categories"],
        fx_rates=latest_fx(good["fx_rates"]),
        errors=quarantined_orders(classified, source_file, run_ts),
        classified=classified,
        split=split_orders(classified, source_file, run_ts),
        broken=quality.broken_lines(others),
    )
