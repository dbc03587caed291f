"""The five business metrics and the dashboard counters, over the star schema.

Each metric reduces the fact table on its own keys BEFORE joining the
dimensions whenever the result allows it (distinct customer-days for M1,
region x product sums for M3, per-customer totals for M4), so the large
joins see aggregated rows instead of order lines.  All money is exact
decimal; ``ordered=True`` applies the presentation order of the original
queries (a global sort, only for display).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.functions import money, round_money


def daily_active_customers(fact: DataFrame, dates: DataFrame, customers: DataFrame,
                           ordered: bool = False) -> DataFrame:
    """M1: distinct customers with an order, per day and region."""
    # a customer has one region, so the distinct pairs can be counted as they
    # are; the dates join the few counts
    pairs = fact.select("date_key", "cust_key").distinct()
    counts = (pairs.join(customers.select("cust_key", "region"), "cust_key")
                   .groupBy("date_key", "region")
                   .agg(F.count(F.lit(1)).alias("active_users")))
    out = counts.join(dates.select("date_key", F.col("full_date").alias("order_date")),
                      "date_key").select("order_date", "region", "active_users")
    return out.orderBy("order_date", "region") if ordered else out


def category_sales(fact: DataFrame, dates: DataFrame, products: DataFrame,
                   category: str = K.HEADLINE_CATEGORY, ordered: bool = False) -> DataFrame:
    """M2: per month, orders, units and revenue of one top category
    (case-insensitive match)."""
    prods = (products.filter(F.lower(F.col("top_category")) == category.lower())
                     .select("prod_key", "top_category"))
    cal = dates.select("date_key", "year", "month_name", "month")
    out = (fact.select("date_key", "prod_key", "order_id", "quantity", "revenue_usd")
               .join(prods, "prod_key")
               .join(cal, "date_key")
               .groupBy("year", "month_name", "month", "top_category")
               .agg(F.count_distinct("order_id").alias("order_count"),
                    F.sum("quantity").cast("bigint").alias("total_quantity"),
                    round_money(F.sum(money("revenue_usd"))).alias("total_revenue_usd")))
    if ordered:
        out = out.orderBy("year", "month")
    return out.drop("month")


def category_totals(sales: DataFrame) -> DataFrame:
    """M6: the dashboard counters, summed over the months of M2."""
    return sales.agg(F.sum("total_revenue_usd").alias("total_revenue_usd"),
                     F.sum("total_quantity").cast("bigint").alias("total_quantity"))


def top_products_by_region(fact: DataFrame, customers: DataFrame, products: DataFrame,
                           n: int = K.TOP_N_PRODUCTS, ordered: bool = False) -> DataFrame:
    """M3: products ranked by revenue within each region, ranks <= n.

    ``rank`` semantics: tied products share a rank, so a region can return
    more than ``n`` rows.  Spark plans the rank filter as a partial
    per-partition limit before the region shuffle (WindowGroupLimit), so a
    region never gathers all its products in one task.
    """
    by_region = (fact.select("cust_key", "prod_key", "revenue_usd")
                     .join(customers.select("cust_key", "region"), "cust_key")
                     .groupBy("region", "prod_key")
                     .agg(F.sum(money("revenue_usd")).alias("_rev")))
    named = (by_region.join(products.select("prod_key", "prod_name", "top_category"),
                            "prod_key")
                      .groupBy("region", "prod_name", "top_category")
                      .agg(F.sum("_rev").alias("_rev")))
    w = Window.partitionBy("region").orderBy(F.col("_rev").desc_nulls_last())
    out = (named.withColumn("revenue_rank", F.rank().over(w))
                .filter(F.col("revenue_rank") <= n)
                .select("region", "revenue_rank", "prod_name", "top_category",
                        round_money(F.col("_rev")).alias("total_revenue_usd")))
    return out.orderBy("region", "revenue_rank") if ordered else out


def _per_customer(fact: DataFrame, dates: DataFrame | None) -> DataFrame:
    f = fact
    aggs: list[Column] = [
        F.count_distinct("order_id").alias("_orders"),
        F.sum("quantity").cast("bigint").alias("total_units"),
        F.sum(money("revenue_usd")).alias("_rev_sum"),
        F.count("revenue_usd").alias("_rev_n"),
    ]
    if dates is not None:
        f = f.join(dates.select("date_key", "full_date"), "date_key", "left")
        aggs.append(F.min("full_date").alias("_first_date"))
    return f.groupBy("cust_key").agg(*aggs)


def customer_value(fact: DataFrame, customers: DataFrame, dates: DataFrame | None = None,
                   as_of: str | Column | None = None, ordered: bool = False) -> DataFrame:
    """M4 (and M4b with ``dates``): lifetime value per customer, active or not.

    Customers without orders stay, with 0 orders and NULL sums.  With
    ``dates`` the result adds ``tenure_months``: days from the first order
    date to ``as_of`` (default: today) / 30, rounded to one decimal.
    """
    per = _per_customer(fact, dates)
    status = (F.when(F.col("is_active"), F.lit(K.STATUS_ACTIVE))
               .otherwise(F.lit(K.STATUS_INACTIVE)))
    avg = F.round(F.col("_rev_sum") / F.when(F.col("_rev_n") > 0, F.col("_rev_n")), 2)
    cols = [F.col("cust_key"), F.col("region"), F.col("customer_type"),
            status.alias("customer_status"),
            F.coalesce(F.col("_orders"), F.lit(0)).alias("total_orders"),
            F.col("total_units"),
            round_money(F.col("_rev_sum")).alias("lifetime_revenue_usd"),
            avg.alias("avg_order_line_value_usd")]
    if dates is not None:
        ref = F.current_date() if as_of is None else (
            F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of)
        cols.append(F.round(F.datediff(ref, F.col("_first_date")) / F.lit(30.0), 1)
                     .alias("tenure_months"))
    out = (customers.select("cust_key", "region", "customer_type", "is_active")
                    .join(per, "cust_key", "left")
                    .select(*cols))
    return out.orderBy(F.col("lifetime_revenue_usd").desc_nulls_last()) if ordered else out


def multi_line_orders(fact: DataFrame) -> DataFrame:
    """Orders with more than one line, their line count and product set."""
    return (fact.groupBy("order_id")
                .agg(F.count(F.lit(1)).alias("line_count"),
                     F.sort_array(F.collect_set("prod_key")).alias("prod_keys"),
                     round_money(F.sum(money("revenue_usd"))).alias("total_revenue_usd"))
                .filter(F.col("line_count") > 1))


def order_audit(fact: DataFrame, errors: DataFrame, ordered: bool = False) -> DataFrame:
    """M5: multi-line orders together with the quarantined rows."""
    multi = multi_line_orders(fact)
    money_t = multi.schema["total_revenue_usd"].dataType
    keys_t = multi.schema["prod_keys"].dataType
    a = multi.select(F.lit(K.MULTI_LINE_FLAG).alias("flag_type"), "order_id",
                     "line_count", "prod_keys", "total_revenue_usd",
                     F.lit(None).cast("string").alias("error_reason"))
    b = errors.select(F.col("_error_code").alias("flag_type"), "order_id",
                      F.lit(1).cast("bigint").alias("line_count"),
                      F.lit(None).cast(keys_t).alias("prod_keys"),
                      F.lit(None).cast(money_t).alias("total_revenue_usd"),
                      F.col("_error_message").alias("error_reason"))
    out = a.unionByName(b)
    return out.orderBy("flag_type", "order_id") if ordered else out
