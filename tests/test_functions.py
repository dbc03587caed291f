import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderlake.functions import (
    clean_lower, clean_upper, date_key, day_name, is_blank, is_weekend, line_revenue,
    money_avg, month_name, parse_iso_date, parse_us_date, parse_us_timestamp,
    price_at_rate, to_bigint, to_whole_int, yes_no_flag)


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_us_date_and_timestamp_parse_and_tolerate_garbage(spark):
    rows = [(" 1/2/2020 ", "1/2/2020 7:05"), ("13/45/2020", "garbage"), (None, None)]
    got = one(spark, rows, "d string, t string",
              parse_us_date("d").alias("d"), parse_us_timestamp("t").alias("t"))
    assert got[0] == (dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 7, 5))
    assert got[1] == (None, None)          # ANSI mode would raise on a plain parse
    assert got[2] == (None, None)


def test_iso_date(spark):
    got = one(spark, [("2020-01-28",), ("2020-1-x",)], "d string", parse_iso_date("d"))
    assert got == [(dt.date(2020, 1, 28),), (None,)]


def test_whole_number_text_goes_through_double(spark):
    # '2.0' is a whole number; a direct int cast would give NULL
    got = one(spark, [("2",), ("2.0",), ("abc",), (None,)], "q string", to_whole_int("q"))
    assert got == [(2,), (2,), (None,), (None,)]


def test_bigint_cast_of_blank_is_null(spark):
    got = one(spark, [(" ",), ("17",), ("x1",)], "c string", to_bigint("c"))
    assert got == [(None,), (17,), (None,)]


def test_yes_no_flag_and_text_cleanup(spark):
    got = one(spark, [(" Y ", " Shipped"), ("n", "PAID"), ("maybe", None)],
              "a string, s string", yes_no_flag("a"), clean_lower("s"), clean_upper("s"))
    assert got == [(True, "shipped", "SHIPPED"), (False, "paid", "PAID"), (None, None, None)]


def test_is_blank(spark):
    got = one(spark, [(None,), ("",), ("  ",), ("a",)], "c string", is_blank("c"))
    assert got == [(True,), (True,), (True,), (False,)]


def test_calendar_attributes(spark):
    rows = [(dt.date(2021, 3, 6),), (dt.date(2021, 3, 8),)]
    got = one(spark, rows, "d date", date_key("d"), month_name("d"), day_name("d"),
              is_weekend("d"))
    assert got == [(20210306, "March", "Saturday", True), (20210308, "March", "Monday", False)]


def test_revenue_is_exact_and_rounds_half_up(spark):
    # 1.25 * 1 * 0.333 = 0.41625 exactly -> 0.4163 (half up); a double product
    # 0.41624999.. would round down.
    got = one(spark, [(1.25, 1, 0.333), (10.0, 3, None)], "p double, q int, r double",
              line_revenue("p", "q", "r"), price_at_rate("p", "r"))
    assert got == [(Decimal("0.4163"), Decimal("0.4163")), (None, None)]


def test_money_avg_half_up_and_ignores_nulls(spark):
    df = spark.createDataFrame([(0.0050,), (0.0100,), (0.0000,), (None,)], "v double")
    # mean of 0.005, 0.01, 0 = 0.005 -> 0.01 half up
    assert df.agg(money_avg("v")).first()[0] == Decimal("0.01")
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.agg(money_avg("v")).first()[0] is None
