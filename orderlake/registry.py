"""Registered queries: one per operator of the inventory, each paired with an
independent DuckDB statement over the same parquet tables.

A query takes ``(spark, sf_dir)`` and returns a lazy DataFrame built by the
library operators from the driver tables; it always covers the whole tables.
For comparison, decimals are shown as DOUBLE and sorted arrays as
comma-joined text (``comparable``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType

from orderlake import constants as K
from orderlake.functions import (
    clean_lower, clean_upper, money_avg, money, parse_iso_date, parse_us_date,
    parse_us_timestamp, round_money, to_bigint, to_double_num, to_whole_int, yes_no_flag)
from orderlake.operators import dedup, quality, timeseries
from orderlake.operators.hierarchy import resolve_top_category
from orderlake.operators.joins import tasks_for
from orderlake.oracle import sql_for
from orderlake.plans import bronze, gold, metrics, silver
from orderlake.session import scratch_path
from orderlake.sinks.tables import AuditLog, counts_frame
from orderlake.sources import fixtures, readers, schemas

AS_OF = "2002-01-01"          # fixed reference date for tenure
RAW_ORDER_COLUMNS = [f.name for f in schemas.ORDERS_SCHEMA.fields]


class Frames:
    """All layers of one run over ``sf_dir``, defined lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def feeds(self) -> dict[str, DataFrame]:
        return fixtures.sources(self.spark, self.sf_dir)

    @cached_property
    def order_tasks(self) -> int | None:
        return tasks_for(self.spark, fixtures.order_bytes(self.spark, self.sf_dir))

    @cached_property
    def bronze(self) -> bronze.Bronze:
        return bronze.build(self.feeds, "raw_orders", order_tasks=self.order_tasks)

    @cached_property
    def typed_fx(self) -> DataFrame:
        return silver.typed_fx(self.bronze.fx_rates)

    @cached_property
    def silver(self) -> silver.Silver:
        b = self.bronze
        return silver.build(b.customers, b.orders, b.products, b.categories, b.fx_rates,
                            many_lines=self.order_tasks is not None)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.silver.order_items)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_orders(self.silver.order_items, self.dim_date)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.silver.customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.silver.products, self.silver.fx_rates)

    def layer_frames(self) -> list[tuple[str, str, DataFrame]]:
        b, s = self.bronze, self.silver
        return [
            ("bronze", "customer", b.customers), ("bronze", "orders", b.orders),
            ("bronze", "product", b.products), ("bronze", "cat_tree", b.categories),
            ("bronze", "fx_rates", b.fx_rates),
            ("silver", "customer", s.customers), ("silver", "orders", s.orders),
            ("silver", "product", s.products), ("silver", "fx_rates", s.fx_rates),
            ("silver", "order_items", s.order_items),
            ("gold", "dim_customer", self.dim_customer),
            ("gold", "dim_product", self.dim_product),
            ("gold", "dim_date", self.dim_date), ("gold", "fact_orders", self.fact),
            ("error_tables", "err_orders", b.errors),
        ]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, arrays as comma-joined text (already sorted)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[Frames], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Frames(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql_for(sql)
        return fn
    return deco


# ======================================================================
# 2.1 scans
# ======================================================================
@register("scan_csv", "SELECT * FROM raw_orders")
def _scan_csv(fr: Frames) -> DataFrame:
    """Orders feed written as CSV under other header names, read back by position
    with the declared all-text schema (blanks preserved)."""
    path = scratch_path(fr.spark, "csv-orders")
    headed = fr.feeds["orders"].withColumnsRenamed(
        {"order_date_raw": "order date", "quantity_raw": "quantity"})
    (headed.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
    return readers.read_csv_source(fr.spark, path, schemas.ORDERS_SCHEMA)


def _json_documents(fr: Frames) -> str:
    """FX feed written as JSON array documents, one per file and at most 10,000
    sequence numbers each."""
    path = scratch_path(fr.spark, "json-fx")
    fx = fr.feeds["fx_rates"]
    row = F.to_json(F.struct(*fx.columns))
    documents = fx.groupBy(F.floor(F.col("seq") / 10_000).alias("doc")).agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list(row)), F.lit("]")).alias("value"))
    documents.repartition("doc").write.mode("overwrite").partitionBy("doc").text(path)
    return path


@register("scan_json", "SELECT * FROM raw_fx")
def _scan_json(fr: Frames) -> DataFrame:
    """The documents read back whole under their schema."""
    got = readers.read_json_source(fr.spark, _json_documents(fr), schemas.FX_SEQ_SCHEMA,
                                   multi_line=True)
    return got.select(*schemas.FX_SEQ_SCHEMA.names)


@register("scan_json_array", "SELECT * FROM raw_fx")
def _scan_json_array(fr: Frames) -> DataFrame:
    """The documents read back in splits, record by record."""
    return readers.read_json_array(fr.spark, _json_documents(fr), schemas.FX_SEQ_SCHEMA)


@register("scan_table", "SELECT * FROM clean_orders")
def _scan_table(fr: Frames) -> DataFrame:
    """Bronze orders saved as a catalog table and scanned by name."""
    # a table and a folder for each call: earlier calls' frames stay readable
    path = scratch_path(fr.spark, "table-orders")
    name = "orderlake_scan_orders_" + path.rsplit("-", 1)[1]
    fr.bronze.orders.write.format("parquet").option("path", path).saveAsTable(name)
    return readers.read_table(fr.spark, name)


@register("calendar_spine", "SELECT rate_date, currency FROM fx_spine")
def _calendar_spine(fr: Frames) -> DataFrame:
    return timeseries.calendar_spine(fr.typed_fx, "rate_date", "currency")


# ======================================================================
# 2.3 projections, filters, predicates
# ======================================================================
@register("filter_blank_key", f"""
    SELECT order_id, cust_id, order_date_raw, prod_id, quantity_raw, status
    FROM classified_orders WHERE _error_code = '{K.NULL_CUST_ID}'""")
def _filter_blank_key(fr: Frames) -> DataFrame:
    c = fr.bronze.classified
    return c.filter(F.col(quality.CODE) == K.NULL_CUST_ID).select(*RAW_ORDER_COLUMNS)


@register("filter_fractional_qty", f"""
    SELECT order_id, cust_id, order_date_raw, prod_id, quantity_raw, status
    FROM classified_orders WHERE _error_code = '{K.INVALID_QTY}'""")
def _filter_fractional_qty(fr: Frames) -> DataFrame:
    c = fr.bronze.classified
    return c.filter(F.col(quality.CODE) == K.INVALID_QTY).select(*RAW_ORDER_COLUMNS)


@register("case_activity_flag", f"""
    SELECT cust_id, active,
           CASE WHEN lower(trim(active)) = 'y' THEN TRUE
                WHEN lower(trim(active)) = 'n' THEN FALSE END AS is_active,
           CASE WHEN lower(trim(active)) = 'y' THEN '{K.STATUS_ACTIVE}'
                ELSE '{K.STATUS_INACTIVE}' END AS customer_status
    FROM bronze_customer""")
def _case_activity_flag(fr: Frames) -> DataFrame:
    flag = yes_no_flag("active")
    return fr.bronze.customers.select(
        "cust_id", "active", flag.alias("is_active"),
        F.when(flag, K.STATUS_ACTIVE).otherwise(K.STATUS_INACTIVE).alias("customer_status"))


@register("having_multi_line", """
    SELECT order_id, COUNT(*) AS line_count FROM fact_orders
    GROUP BY order_id HAVING COUNT(*) > 1""")
def _having_multi_line(fr: Frames) -> DataFrame:
    return metrics.multi_line_orders(fr.fact).select("order_id", "line_count")


@register("currency_case_note",
          "SELECT prod_id, currency, _currency_note FROM bronze_product")
def _currency_case_note(fr: Frames) -> DataFrame:
    return fr.bronze.products.select("prod_id", "currency", "_currency_note")


@register("scalar_string_clean", """
    SELECT order_id, prod_id, trim(cust_id) AS cust_id_trimmed,
           lower(trim(status)) AS status_lower, upper(trim(status)) AS status_upper
    FROM raw_orders""")
def _scalar_string_clean(fr: Frames) -> DataFrame:
    return fr.feeds["orders"].select(
        "order_id", "prod_id", F.trim("cust_id").alias("cust_id_trimmed"),
        clean_lower("status").alias("status_lower"),
        clean_upper("status").alias("status_upper"))


# ======================================================================
# 2.9 parsing and casts
# ======================================================================
@register("parse_us_date", """
    SELECT cust_id, created_at,
           CAST(try_strptime(trim(created_at), '%m/%d/%Y') AS DATE) AS created_date
    FROM bronze_customer""")
def _parse_us_date(fr: Frames) -> DataFrame:
    return fr.bronze.customers.select("cust_id", "created_at",
                                      parse_us_date("created_at").alias("created_date"))


@register("parse_iso_date", """
    SELECT date, currency, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS rate_date
    FROM bronze_fx""")
def _parse_iso_date(fr: Frames) -> DataFrame:
    return fr.bronze.fx_rates.select("date", "currency",
                                     parse_iso_date("date").alias("rate_date"))


@register("parse_us_timestamp", """
    SELECT order_id, prod_id, order_date_raw,
           try_strptime(trim(order_date_raw), '%m/%d/%Y %H:%M') AS order_timestamp,
           CAST(try_strptime(trim(order_date_raw), '%m/%d/%Y %H:%M') AS DATE) AS order_date
    FROM clean_orders""")
def _parse_us_timestamp(fr: Frames) -> DataFrame:
    ts = parse_us_timestamp("order_date_raw")
    return fr.bronze.orders.select("order_id", "prod_id", "order_date_raw",
                                   ts.alias("order_timestamp"),
                                   F.to_date(ts).alias("order_date"))


@register("cast_typed_orders", """
    SELECT order_id, TRY_CAST(cust_id AS BIGINT) AS cust_id,
           TRY_CAST(prod_id AS BIGINT) AS prod_id,
           TRY_CAST(quantity_raw AS DOUBLE) AS quantity_num,
           CASE WHEN TRY_CAST(quantity_raw AS DOUBLE) % 1 = 0
                THEN TRY_CAST(TRY_CAST(quantity_raw AS DOUBLE) AS INTEGER) END AS quantity
    FROM raw_orders""")
def _cast_typed_orders(fr: Frames) -> DataFrame:
    raw = fr.feeds["orders"]
    num = to_double_num("quantity_raw")
    return raw.select("order_id", to_bigint("cust_id").alias("cust_id"),
                      to_bigint("prod_id").alias("prod_id"), num.alias("quantity_num"),
                      F.when(num % 1 == 0, to_whole_int("quantity_raw")).alias("quantity"))


@register("date_key", "SELECT full_date, date_key FROM dim_date")
def _date_key(fr: Frames) -> DataFrame:
    return fr.dim_date.select("full_date", "date_key")


# ======================================================================
# 2.6 keep-one-per-key family
# ======================================================================
@register("latest_per_key", """
    SELECT user_id, ts, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
                     event_type DESC NULLS LAST) AS rn
        FROM customer_snapshots) WHERE rn = 1""")
def _latest_per_key(fr: Frames) -> DataFrame:
    snaps = fixtures.customer_snapshots(fr.spark, fr.sf_dir)
    return dedup.keep_one_per_key(snaps, ["user_id"], order=["ts", "event_id"],
                                  descending=True)


@register("earliest_per_key", """
    SELECT user_id, ts, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST,
                     event_type ASC NULLS FIRST) AS rn
        FROM customer_snapshots) WHERE rn = 1""")
def _earliest_per_key(fr: Frames) -> DataFrame:
    snaps = fixtures.customer_snapshots(fr.spark, fr.sf_dir)
    return dedup.keep_one_per_key(snaps, ["user_id"], order=["ts", "event_id"],
                                  descending=False)


@register("exact_dedup", "SELECT DISTINCT * FROM raw_orders")
def _exact_dedup(fr: Frames) -> DataFrame:
    return dedup.exact_dedup(fr.feeds["orders"])


@register("last_write_wins", "SELECT * FROM bronze_fx")
def _last_write_wins(fr: Frames) -> DataFrame:
    return fr.bronze.fx_rates


@register("clean_orders", "SELECT * FROM clean_orders")
def _clean_orders(fr: Frames) -> DataFrame:
    return fr.bronze.orders


# ======================================================================
# quarantine
# ======================================================================
@register("quarantine_rows", "SELECT * FROM err_orders")
def _quarantine_rows(fr: Frames) -> DataFrame:
    return fr.bronze.errors


@register("quarantine_counts", """
    SELECT _error_code AS error_code, COUNT(*) AS rows
    FROM classified_orders WHERE _error_code IS NOT NULL GROUP BY _error_code""")
def _quarantine_counts(fr: Frames) -> DataFrame:
    return quality.quarantine_counts(fr.bronze.classified)


# ======================================================================
# FX series
# ======================================================================
@register("fx_forward_fill", "SELECT * FROM fx_rates")
def _fx_forward_fill(fr: Frames) -> DataFrame:
    return fr.silver.fx_rates


@register("fx_fill_flag", """
    SELECT currency, _fx_fill_method, COUNT(*) AS days
    FROM fx_rates GROUP BY currency, _fx_fill_method""")
def _fx_fill_flag(fr: Frames) -> DataFrame:
    return (fr.silver.fx_rates.groupBy("currency", "_fx_fill_method")
              .agg(F.count(F.lit(1)).alias("days")))


@register("agg_date_bounds", "SELECT * FROM fx_bounds")
def _agg_date_bounds(fr: Frames) -> DataFrame:
    return timeseries.date_bounds(fr.typed_fx, "rate_date")


@register("agg_latest_rate", "SELECT * FROM latest_rates")
def _agg_latest_rate(fr: Frames) -> DataFrame:
    return timeseries.latest_value_per_series(fr.silver.fx_rates)


@register("distinct_dates", "SELECT DISTINCT rate_date FROM typed_fx")
def _distinct_dates(fr: Frames) -> DataFrame:
    return fr.typed_fx.select("rate_date").distinct()


@register("join_fx_by_date", """
    SELECT order_id, prod_id, order_date, currency, rate_to_usd, _fx_fill_method
    FROM order_items""")
def _join_fx_by_date(fr: Frames) -> DataFrame:
    return fr.silver.order_items.select("order_id", "prod_id", "order_date", "currency",
                                        "rate_to_usd", "_fx_fill_method")


@register("revenue_usd", """
    SELECT order_id, prod_id, quantity, price, rate_to_usd,
           CAST(revenue_usd AS DOUBLE) AS revenue_usd
    FROM order_items""")
def _revenue_usd(fr: Frames) -> DataFrame:
    return fr.silver.order_items.select("order_id", "prod_id", "quantity", "price",
                                        "rate_to_usd", "revenue_usd")


_ITEM_COLS = ", ".join(c if c != "revenue_usd" else "CAST(revenue_usd AS DOUBLE) AS revenue_usd"
                       for c in silver.ORDER_ITEM_COLUMNS)


@register("order_items", f"SELECT {_ITEM_COLS} FROM order_items")
def _order_items(fr: Frames) -> DataFrame:
    return fr.silver.order_items


# ======================================================================
# categories, products, silver tables
# ======================================================================
@register("category_rollup", "SELECT * FROM category_tree")
def _category_rollup(fr: Frames) -> DataFrame:
    return resolve_top_category(fr.bronze.categories)


@register("join_product_category", """
    SELECT prod_id, cat_id, category_name, top_category FROM silver_product""")
def _join_product_category(fr: Frames) -> DataFrame:
    return fr.silver.products.select("prod_id", "cat_id", "category_name", "top_category")


@register("silver_product", "SELECT * FROM silver_product")
def _silver_product(fr: Frames) -> DataFrame:
    return fr.silver.products


@register("join_orders_products", """
    SELECT o.order_id, o.prod_id, p.prod_name, p.price, p.currency, o.quantity
    FROM silver_orders o JOIN silver_product p ON o.prod_id = p.prod_id""")
def _join_orders_products(fr: Frames) -> DataFrame:
    return (silver.known_products(fr.silver.orders, fr.silver.products,
                                  many_lines=fr.order_tasks is not None)
                  .select("order_id", "prod_id", "prod_name", "price", "currency", "quantity"))


@register("silver_customer", "SELECT * FROM silver_customer")
def _silver_customer(fr: Frames) -> DataFrame:
    return fr.silver.customers


@register("silver_orders", "SELECT * FROM silver_orders")
def _silver_orders(fr: Frames) -> DataFrame:
    return fr.silver.orders


# ======================================================================
# gold
# ======================================================================
@register("dim_customer", "SELECT * FROM dim_customer")
def _dim_customer(fr: Frames) -> DataFrame:
    return fr.dim_customer


@register("dim_product", """
    SELECT prod_key, prod_id, prod_name, category_name, top_category,
           CAST(price_usd AS DOUBLE) AS price_usd FROM dim_product""")
def _dim_product(fr: Frames) -> DataFrame:
    return fr.dim_product


@register("dim_date", "SELECT * FROM dim_date")
def _dim_date(fr: Frames) -> DataFrame:
    return fr.dim_date


@register("fact_orders", """
    SELECT order_id, cust_key, prod_key, date_key, quantity,
           CAST(revenue_usd AS DOUBLE) AS revenue_usd, status FROM fact_orders""")
def _fact_orders(fr: Frames) -> DataFrame:
    return fr.fact


# ======================================================================
# 2.5 aggregates
# ======================================================================
@register("agg_count_distinct", """
    SELECT date_key, COUNT(DISTINCT cust_key) AS customers,
           COUNT(DISTINCT order_id) AS orders
    FROM fact_orders GROUP BY date_key""")
def _agg_count_distinct(fr: Frames) -> DataFrame:
    """Two distinct counts hash each line twice before the shuffle.  Lines of a large feed
    are dealt over tasks first, as those of the product join are as few as the cores."""
    lines = fr.fact.select("date_key", "cust_key", "order_id")
    if fr.order_tasks:
        lines = lines.repartition(fr.order_tasks, *lines.columns)
    return lines.groupBy("date_key").agg(F.count_distinct("cust_key").alias("customers"),
                                         F.count_distinct("order_id").alias("orders"))


@register("agg_sum_qty", """
    SELECT prod_key, CAST(SUM(quantity) AS BIGINT) AS total_quantity
    FROM fact_orders GROUP BY prod_key""")
def _agg_sum_qty(fr: Frames) -> DataFrame:
    return fr.fact.groupBy("prod_key").agg(
        F.sum("quantity").cast("bigint").alias("total_quantity"))


@register("agg_sum_revenue", """
    SELECT cust_key, CAST(ROUND(SUM(revenue_usd), 2) AS DOUBLE) AS total_revenue_usd
    FROM fact_orders GROUP BY cust_key""")
def _agg_sum_revenue(fr: Frames) -> DataFrame:
    return fr.fact.groupBy("cust_key").agg(
        round_money(F.sum(money("revenue_usd"))).alias("total_revenue_usd"))


_AVG_CENTS = """CAST((2 * SUM(CAST(revenue_usd * 10000 AS BIGINT)) + 100 * COUNT(revenue_usd))
               // (200 * COUNT(revenue_usd)) AS DOUBLE) / 100"""


@register("agg_avg_revenue", f"""
    SELECT prod_key, {_AVG_CENTS} AS avg_revenue_usd
    FROM fact_orders GROUP BY prod_key""")
def _agg_avg_revenue(fr: Frames) -> DataFrame:
    return fr.fact.groupBy("prod_key").agg(money_avg("revenue_usd").alias("avg_revenue_usd"))


@register("agg_collect_set", """
    SELECT order_id, array_to_string(list_sort(list(DISTINCT prod_key)), ',') AS prod_keys
    FROM fact_orders GROUP BY order_id""")
def _agg_collect_set(fr: Frames) -> DataFrame:
    return fr.fact.groupBy("order_id").agg(
        F.sort_array(F.collect_set("prod_key")).alias("prod_keys"))


# ======================================================================
# 2.11 business metrics
# ======================================================================
@register("metric_daily_active", """
    SELECT d.full_date AS order_date, c.region, COUNT(DISTINCT f.cust_key) AS active_users
    FROM fact_orders f
    JOIN dim_date d ON f.date_key = d.date_key
    JOIN dim_customer c ON f.cust_key = c.cust_key
    GROUP BY d.full_date, c.region""")
def _metric_daily_active(fr: Frames) -> DataFrame:
    return metrics.daily_active_customers(fr.fact, fr.dim_date, fr.dim_customer)


@register("metric_category_sales", """
    SELECT year, month_name, top_category, order_count, total_quantity,
           CAST(total_revenue_usd AS DOUBLE) AS total_revenue_usd
    FROM metric_category_sales_dec""")
def _metric_category_sales(fr: Frames) -> DataFrame:
    return metrics.category_sales(fr.fact, fr.dim_date, fr.dim_product)


@register("category_totals", """
    SELECT CAST(SUM(total_revenue_usd) AS DOUBLE) AS total_revenue_usd,
           CAST(SUM(total_quantity) AS BIGINT) AS total_quantity
    FROM metric_category_sales_dec""")
def _category_totals(fr: Frames) -> DataFrame:
    return metrics.category_totals(
        metrics.category_sales(fr.fact, fr.dim_date, fr.dim_product))


@register("metric_top_products", """
    WITH ranked AS (
        SELECT c.region, p.prod_name, p.top_category,
               SUM(f.revenue_usd) AS rev,
               RANK() OVER (PARTITION BY c.region
                            ORDER BY SUM(f.revenue_usd) DESC NULLS LAST) AS revenue_rank
        FROM fact_orders f
        JOIN dim_customer c ON f.cust_key = c.cust_key
        JOIN dim_product p ON f.prod_key = p.prod_key
        GROUP BY c.region, p.prod_name, p.top_category)
    SELECT region, CAST(revenue_rank AS INTEGER) AS revenue_rank, prod_name, top_category,
           CAST(ROUND(rev, 2) AS DOUBLE) AS total_revenue_usd
    FROM ranked WHERE revenue_rank <= 3""")
def _metric_top_products(fr: Frames) -> DataFrame:
    return metrics.top_products_by_region(fr.fact, fr.dim_customer, fr.dim_product)


_CUSTOMER_VALUE = f"""
    SELECT c.cust_key, c.region, c.customer_type,
           CASE WHEN c.is_active THEN '{K.STATUS_ACTIVE}' ELSE '{K.STATUS_INACTIVE}' END
               AS customer_status,
           COUNT(DISTINCT f.order_id) AS total_orders,
           CAST(SUM(f.quantity) AS BIGINT) AS total_units,
           CAST(ROUND(SUM(f.revenue_usd), 2) AS DOUBLE) AS lifetime_revenue_usd,
           {_AVG_CENTS.replace('revenue_usd', 'f.revenue_usd')} AS avg_order_line_value_usd
           {{extra}}
    FROM dim_customer c
    LEFT JOIN fact_orders f ON c.cust_key = f.cust_key
    {{join}}
    GROUP BY c.cust_key, c.region, c.customer_type, c.is_active"""


@register("metric_customer_value", _CUSTOMER_VALUE.format(extra="", join=""))
def _metric_customer_value(fr: Frames) -> DataFrame:
    return metrics.customer_value(fr.fact, fr.dim_customer)


@register("customer_tenure", _CUSTOMER_VALUE.format(
    extra=f""", ROUND(CAST(datediff('day', MIN(d.full_date), DATE '{AS_OF}') AS DOUBLE)
                     / 30.0, 1) AS tenure_months""",
    join="LEFT JOIN dim_date d ON f.date_key = d.date_key"))
def _customer_tenure(fr: Frames) -> DataFrame:
    return metrics.customer_value(fr.fact, fr.dim_customer, fr.dim_date, AS_OF)


@register("metric_order_audit", f"""
    SELECT '{K.MULTI_LINE_FLAG}' AS flag_type, order_id, COUNT(*) AS line_count,
           array_to_string(list_sort(list(DISTINCT prod_key)), ',') AS prod_keys,
           CAST(ROUND(SUM(revenue_usd), 2) AS DOUBLE) AS total_revenue_usd,
           CAST(NULL AS VARCHAR) AS error_reason
    FROM fact_orders GROUP BY order_id HAVING COUNT(*) > 1
    UNION ALL
    SELECT _error_code, order_id, 1, NULL, NULL, _error_message FROM err_orders""")
def _metric_order_audit(fr: Frames) -> DataFrame:
    return metrics.order_audit(fr.fact, fr.bronze.errors)


# ======================================================================
# 2.12 quality, audit, run reporting
# ======================================================================
_PROFILED = ["order_id", "cust_id", "prod_id", "order_timestamp", "quantity",
             "rate_to_usd", "revenue_usd"]


@register("null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count "
    f"FROM order_items" for c in _PROFILED))
def _null_profile(fr: Frames) -> DataFrame:
    return quality.null_profile(fr.silver.order_items, _PROFILED)


_GOLD_TABLES = [("dim_customer", "customer dimension"), ("dim_product", "product dimension"),
                ("dim_date", "date dimension"), ("fact_orders", "orders fact")]


@register("row_counts", " UNION ALL ".join(
    f"SELECT '{label}' AS label, COUNT(*) AS row_count, 1 AS min_rows, "
    f"COUNT(*) >= 1 AS passed FROM {t}" for t, label in _GOLD_TABLES))
def _row_counts(fr: Frames) -> DataFrame:
    frames = {"dim_customer": fr.dim_customer, "dim_product": fr.dim_product,
              "dim_date": fr.dim_date, "fact_orders": fr.fact}
    counts = counts_frame(fr.spark, [({"label": label}, frames[t]) for t, label in _GOLD_TABLES])
    return counts.select("label", "row_count", F.lit(1).alias("min_rows"),
                         (F.col("row_count") >= 1).alias("passed"))


def _layer_counts(fr: Frames) -> DataFrame:
    return counts_frame(fr.spark, [({"layer": layer, "table_name": f"{layer}.{t}"}, df)
                                   for layer, t, df in fr.layer_frames()])


_LAYER_SQL = {
    "bronze.customer": "bronze_customer", "bronze.orders": "clean_orders",
    "bronze.product": "bronze_product", "bronze.cat_tree": "cat_tree",
    "bronze.fx_rates": "bronze_fx", "silver.customer": "silver_customer",
    "silver.orders": "silver_orders", "silver.product": "silver_product",
    "silver.fx_rates": "fx_rates", "silver.order_items": "order_items",
    "gold.dim_customer": "dim_customer", "gold.dim_product": "dim_product",
    "gold.dim_date": "dim_date", "gold.fact_orders": "fact_orders",
    "error_tables.err_orders": "err_orders",
}


@register("layer_row_counts", " UNION ALL ".join(
    f"SELECT '{t.split('.')[0]}' AS layer, '{t}' AS table_name, COUNT(*) AS row_count "
    f"FROM {v}" for t, v in _LAYER_SQL.items()))
def _layer_row_counts(fr: Frames) -> DataFrame:
    return _layer_counts(fr)


@register("audit_records", "SELECT 'run-1' AS run_id, 'ecommerce_etl' AS pipeline, "
          "'1.0.0' AS version, CASE layer WHEN 'error_tables' THEN 'ERROR' ELSE upper(layer) END "
          "AS layer, table_name, row_count, 'SUCCESS' AS status, '' AS notes, "
          f"'{AS_OF} 00:00:00' AS logged_at FROM (" + " UNION ALL ".join(
              f"SELECT '{t.split('.')[0]}' AS layer, '{t}' AS table_name, COUNT(*) AS row_count "
              f"FROM {v}" for t, v in _LAYER_SQL.items()) + ")")
def _audit_records(fr: Frames) -> DataFrame:
    """One audit record per layer table, as the audit log writes them, under a
    fixed run id and time."""
    log = AuditLog("run-1", clock=lambda: f"{AS_OF} 00:00:00")
    for r in _layer_counts(fr).collect():              # one row per table of the layout
        log.record(r["layer"], r["table_name"], r["row_count"])
    return log.frame(fr.spark)


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship: daily active customers by region, through every layer."""
    return QUERIES["metric_daily_active"](spark, sf_dir)

