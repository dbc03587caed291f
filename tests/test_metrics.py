import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.plans import gold, metrics

D = dt.date


@pytest.fixture(scope="module")
def star(spark):
    cust = spark.createDataFrame(
        [(1, "EUROPE", "retail", True), (2, "EUROPE", "retail", None),
         (3, "ASIA", "corporate", False), (4, "ASIA", "retail", True)],
        "cust_key long, region string, customer_type string, is_active boolean")
    prod = spark.createDataFrame(
        [(2, "toffee", "Sweet"), (3, "fudge", "Sweet"), (4, "crisps", "salt"),
         (7, "toffee", "Sweet"), (11, "nuts", "salt")],
        "prod_key long, prod_name string, top_category string")
    items = spark.createDataFrame(
        [(D(2020, 1, 5),), (D(2020, 2, 1),), (D(2020, 1, 6),)], "order_date date")
    dates = gold.dim_date(items)
    money = "decimal(18,4)"
    fact = spark.createDataFrame(
        [("A-005", 1, 2, 20200105, 2, Decimal("10.0000")),
         ("A-005", 1, 3, 20200105, 1, Decimal("5.5000")),
         ("A-009", 2, 4, 20200201, 3, Decimal("7.0000")),
         ("A-009", 2, 7, 20200201, 1, Decimal("3.0000")),
         ("A-009", 2, 11, 20200201, 1, Decimal("1.0000")),
         ("A-010", 3, 2, 20200106, 4, Decimal("15.5000")),
         ("A-011", 1, 7, 20200201, 1, None)],
        f"order_id string, cust_key long, prod_key long, date_key int, quantity int, "
        f"revenue_usd {money}")
    return fact, dates, cust, prod


def test_daily_active(star):
    fact, dates, cust, prod = star
    got = [tuple(r) for r in metrics.daily_active_customers(fact, dates, cust, True).collect()]
    assert got == [(D(2020, 1, 5), "EUROPE", 1), (D(2020, 1, 6), "ASIA", 1),
                   (D(2020, 2, 1), "EUROPE", 2)]


def test_category_sales_case_insensitive_and_ordered(star):
    fact, dates, cust, prod = star
    out = metrics.category_sales(fact, dates, prod, "SWEET", ordered=True)
    assert out.columns == ["year", "month_name", "top_category", "order_count",
                           "total_quantity", "total_revenue_usd"]
    got = [tuple(r) for r in out.collect()]
    assert got == [(2020, "January", "Sweet", 2, 7, Decimal("31.00")),
                   (2020, "February", "Sweet", 2, 2, Decimal("3.00"))]
    tot = metrics.category_totals(out).first()
    assert (tot.total_revenue_usd, tot.total_quantity) == (Decimal("34.00"), 9)


def test_top_products_rank_with_ties(star, spark):
    fact, dates, cust, prod = star
    got = [tuple(r) for r in metrics.top_products_by_region(fact, cust, prod, 3, True).collect()]
    # EUROPE: toffee = 10 + 3 (prod 2 and 7 share the name), fudge 5.5, crisps 7
    assert got[0] == ("ASIA", 1, "toffee", "Sweet", Decimal("15.50"))
    eu = [g for g in got if g[0] == "EUROPE"]
    assert [g[1:3] for g in eu] == [(1, "toffee"), (2, "crisps"), (3, "fudge")]
    tie = spark.createDataFrame([("X", 1, 1, Decimal("1")), ("X", 1, 2, Decimal("1"))],
                                "order_id string, cust_key long, prod_key long, "
                                "revenue_usd decimal(18,4)")
    p2 = spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], "prod_key long, prod_name string, top_category string")
    c2 = spark.createDataFrame([(1, "R")], "cust_key long, region string")
    ranks = sorted(r.revenue_rank for r in metrics.top_products_by_region(tie, c2, p2, 1).collect())
    assert ranks == [1, 1]                           # ties share rank, both kept


def test_customer_value_keeps_customers_without_orders(star):
    fact, dates, cust, prod = star
    out = metrics.customer_value(fact, cust, dates, "2020-03-01", ordered=True)
    got = {r.cust_key: r for r in out.collect()}
    assert got[4].total_orders == 0 and got[4].total_units is None
    assert got[4].lifetime_revenue_usd is None and got[4].tenure_months is None
    assert got[2].customer_status == K.STATUS_INACTIVE          # NULL flag -> inactive
    assert got[1].total_orders == 2 and got[1].total_units == 4
    assert got[1].lifetime_revenue_usd == Decimal("15.50")
    assert got[1].avg_order_line_value_usd == Decimal("7.75")   # NULL line ignored
    assert float(got[1].tenure_months) == 1.9                   # 56 days / 30
    order = [r.cust_key for r in out.collect()]
    assert order[-1] == 4                                       # NULL revenue last


def test_order_audit_union(star, spark):
    fact, dates, cust, prod = star
    errs = spark.createDataFrame(
        [("A-21", K.NULL_CUST_ID, "m1"), ("A-013", K.INVALID_QTY, "m2")],
        "order_id string, _error_code string, _error_message string")
    out = metrics.order_audit(fact, errs, ordered=True)
    got = [tuple(r) for r in out.collect()]
    assert got == [
        (K.INVALID_QTY, "A-013", 1, None, None, "m2"),
        (K.NULL_CUST_ID, "A-21", 1, None, None, "m1"),
        (K.MULTI_LINE_FLAG, "A-005", 2, [2, 3], Decimal("15.50"), None),
        (K.MULTI_LINE_FLAG, "A-009", 3, [4, 7, 11], Decimal("11.00"), None)]
