"""Star schema: customer, product and date dimensions, orders fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import date_key, day_name, is_weekend, month_name, price_at_rate
from orderlake.operators import broadcast_if_small, latest_value_per_series


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per customer; the stable id doubles as surrogate key."""
    return customers.select(
        F.col("cust_id").alias("cust_key"), "cust_id", "country", "region",
        "customer_type", "zip", "is_active", "created_at")


def dim_product(products: DataFrame, fx_rates: DataFrame,
                fx_rows: int | None = None) -> DataFrame:
    """Products with a display price in USD at the latest known rate.

    The latest rates have one row per currency, never more rows than the FX
    table: with the FX table's measured row count ``fx_rows`` they are
    broadcast when small, so the products are never shuffled onto the few
    currency keys.
    """
    latest = broadcast_if_small(
        latest_value_per_series(fx_rates, "currency", "rate_date", "rate_to_usd",
                                "latest_rate"), fx_rows)
    return (products.join(latest, "currency", "left")
                    .select(F.col("prod_id").alias("prod_key"), "prod_id", "prod_name",
                            "category_name", "top_category",
                            price_at_rate("price", "latest_rate").alias("price_usd")))


def dim_date(order_items: DataFrame, date_col: str = "order_date") -> DataFrame:
    """One row per date that occurs in the order lines."""
    d = F.col("full_date")
    return (order_items.select(F.col(date_col).alias("full_date")).distinct()
                       .select(d, date_key(d).alias("date_key"),
                               F.year(d).alias("year"), F.quarter(d).alias("quarter"),
                               F.month(d).alias("month"), month_name(d).alias("month_name"),
                               F.dayofmonth(d).alias("day"), day_name(d).alias("day_of_week"),
                               is_weekend(d).alias("is_weekend")))


def fact_orders(order_items: DataFrame, dates: DataFrame,
                date_rows: int | None = None) -> DataFrame:
    """Grain: one row per order line, with the date dimension's key.

    The date dimension has one row per calendar day that occurs; with its
    measured row count it is broadcast when small.
    """
    keys = broadcast_if_small(dates, date_rows).select("full_date", "date_key")
    return (order_items.join(keys, F.col("order_date") == F.col("full_date"), "left")
                       .select("order_id", F.col("cust_id").alias("cust_key"),
                               F.col("prod_id").alias("prod_key"), "date_key",
                               "quantity", "revenue_usd", "status"))
