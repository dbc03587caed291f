"""Skew safety of the metric plans: one customer and one product each hold a
third of the order lines.  Every shuffle that moves fact rows must sit on a
partial aggregate (or a partial top-k), so the hot keys leave each input
partition as one row; results are checked against brute force."""

import contextlib
import io
import re
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.plans import metrics

N = 3000


@pytest.fixture(scope="module")
def star(spark):
    i = F.col("id")
    hot_cust = i % 3 == 0
    hot_prod = i % 3 == 1
    fact = spark.range(N).select(
        F.concat(F.lit("A-"), (i % 900).cast("string")).alias("order_id"),
        F.when(hot_cust, F.lit(1)).otherwise(i % 50 + 2).cast("bigint").alias("cust_key"),
        F.when(hot_prod, F.lit(7)).otherwise(i % 40 + 8).cast("bigint").alias("prod_key"),
        (F.lit(20200101) + i % 20).cast("int").alias("date_key"),
        (i % 4 + 1).cast("int").alias("quantity"),
        ((i % 97) / F.lit(4)).cast("decimal(18,4)").alias("revenue_usd"),
        F.lit("paid").alias("status")).repartition(6)
    dates = spark.range(20).select(
        (F.lit(20200101) + F.col("id")).cast("int").alias("date_key"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("full_date"),
        F.lit(2020).alias("year"), F.lit(1).alias("month"), F.lit("January").alias("month_name"))
    customers = spark.range(1, 52).select(
        F.col("id").alias("cust_key"),
        F.when(F.col("id") % 2 == 0, "EAST").otherwise("WEST").alias("region"),
        F.lit("retail").alias("customer_type"), (F.col("id") % 5 != 0).alias("is_active"))
    products = spark.range(7, 48).select(
        F.col("id").alias("prod_key"), F.concat(F.lit("p"), F.col("id").cast("string"))
        .alias("prod_name"), F.when(F.col("id") % 2 == 0, "Sweet").otherwise("salt")
        .alias("top_category"))
    return fact, dates, customers, products


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


FACT_SCAN = f"Range (0, {N}, "


def unreduced_exchanges(plan: str) -> list[str]:
    """Hash exchanges over fact rows whose input is not a partial aggregate or
    a partial top-k.  (Dimension sides, one row per key, may move as they are.)"""
    lines = plan.splitlines()
    bad = []
    for n, line in enumerate(lines):
        if not re.search(r"Exchange (hashpartitioning|SinglePartition)", line):
            continue
        depth = line.find("+- ")
        subtree = []
        for below in lines[n + 1:]:
            d = below.find("+- ")
            if d != -1 and d <= depth:
                break
            subtree.append(below)
        if not any(FACT_SCAN in b for b in subtree):
            continue
        child = subtree[0] if subtree else ""
        if not re.search(r"(Hash|ObjectHash|Sort)Aggregate|WindowGroupLimit", child):
            bad.append(line.strip() + "  <-  " + child.strip())
    return bad


def test_every_metric_shuffle_moves_reduced_rows(spark, star):
    fact, dates, customers, products = star
    frames = {
        "daily_active": metrics.daily_active_customers(fact, dates, customers),
        "category_sales": metrics.category_sales(fact, dates, products),
        "top_products": metrics.top_products_by_region(fact, customers, products),
        "customer_value": metrics.customer_value(fact, customers),
        "customer_tenure": metrics.customer_value(fact, customers, dates, "2021-01-01"),
        "multi_line": metrics.multi_line_orders(fact),
    }
    for name, df in frames.items():
        assert unreduced_exchanges(plan_of(df)) == [], name
    # control: a per-customer window moves every fact row and is caught
    from pyspark.sql import Window
    moved = fact.withColumn("_s", F.sum("quantity").over(Window.partitionBy("cust_key")))
    assert len(unreduced_exchanges(plan_of(moved))) == 1


def test_hot_customer_and_product_results(spark, star):
    fact, dates, customers, products = star
    rows = fact.collect()                      # 3,000 rows: brute force in Python
    per_cust = defaultdict(lambda: [set(), 0, Decimal(0)])
    for r in rows:
        acc = per_cust[r.cust_key]
        acc[0].add(r.order_id)
        acc[1] += r.quantity
        acc[2] += r.revenue_usd
    got = {r.cust_key: r for r in metrics.customer_value(fact, customers).collect()}
    hot = got[1]
    assert hot.total_orders == len(per_cust[1][0])
    assert hot.total_units == per_cust[1][1]
    assert hot.lifetime_revenue_usd == per_cust[1][2].quantize(Decimal("0.01"))
    assert sum(1 for r in rows if r.cust_key == 1) == N // 3

    by_region_prod = defaultdict(Decimal)
    region = {c.cust_key: c.region for c in customers.collect()}
    for r in rows:
        by_region_prod[(region[r.cust_key], f"p{r.prod_key}")] += r.revenue_usd
    top = metrics.top_products_by_region(fact, customers, products).collect()
    for reg in ("EAST", "WEST"):
        best = max(v for (g, _), v in by_region_prod.items() if g == reg)
        first = [r for r in top if r.region == reg and r.revenue_rank == 1]
        assert [r.total_revenue_usd for r in first] == [best.quantize(Decimal("0.01"))]
    # the hot product p7 (a third of all lines, spread over the customers) leads
    assert any(r.prod_name == "p7" and r.revenue_rank == 1 for r in top)
