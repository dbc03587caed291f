"""Exact money: no digit of a rate is lost, nothing out of range ends a job."""

import datetime as dt
from decimal import Decimal

import pytest

from orderlake.functions import line_revenue, price_at_rate


@pytest.mark.parametrize("price, qty, rate, want", [
    (1_000_000.0, 100, 0.0000395123, "3951.2300"),
    (150_000_000.0, 3, 0.0000395123, "17780.5350"),
    (150_000_000.0, 100, 12_000.5, "180007500000000.0000"),
    (1.0, 1, 3.95123e-8, "0.0000"),
    (123456.789, 10, 3.95123e-8, "0.0488"),
    (0.00005, 1, 1.0, "0.0001"),
    (2.5, 1, 0.00002, "0.0001"),
    (-2.5, 1, 0.00002, "-0.0001"),
    (None, 1, 1.0, None), (1.0, None, 1.0, None), (1.0, 1, None, None),
    (1e15, 1, 1.0, None), (1.0, 1, 1e13, None), (9e11, 2_000_000_000, 9e11, None),
])
def test_line_revenue(spark, price, qty, rate, want):
    df = spark.createDataFrame([(price, qty, rate)], "p double, q long, r double")
    got = df.select(line_revenue("p", "q", "r").alias("x")).first()["x"]
    assert got == (None if want is None else Decimal(want))


def test_price_at_rate(spark):
    df = spark.createDataFrame([(150_000_000.0, 0.0000395123)], "p double, r double")
    assert df.select(price_at_rate("p", "r").alias("x")).first()["x"] == Decimal("5926.8450")


def test_whole_numbers_and_wall_clocks(spark):
    from orderlake.functions import parse_us_timestamp, to_whole_int
    df = spark.createDataFrame([("2.7",), ("0.1",), ("2.0",), ("3",), ("abc",), (None,), ("1e99",)],
                               "q string")
    assert [r[0] for r in df.select(to_whole_int("q")).collect()] == [
        None, None, 2, 3, None, None, None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = spark.createDataFrame([(" 3/10/2019 2:30",), ("3/10/2019 24:00",), ("3/10/2019 2:3",),
                                   ("13/45/2019 2:30",), (None,)], "t string")
        got = [r[0] for r in t.select(parse_us_timestamp("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2019, 3, 10, 2, 30), None, None, None, None]
