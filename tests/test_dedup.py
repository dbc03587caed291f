import contextlib
import io

from pyspark.sql import functions as F

from orderlake.functions import parse_us_date
from orderlake.operators import exact_dedup, keep_one_per_key, last_write_wins
from orderlake.sources import with_sequence


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_newest_snapshot_per_customer(spark):
    # 4 customers x 3 snapshots, conflicting flags; dates as M/d/yyyy
    data = []
    for c in range(1, 5):
        for i, d in enumerate(["1/5/2020", "12/31/2020", "3/1/2020"]):
            data.append((str(c), d, "y" if i == 1 else "n"))
    df = spark.createDataFrame(data, "cust_id string, created_at string, active string")
    out = keep_one_per_key(df, ["cust_id"], order=parse_us_date("created_at"))
    assert out.columns == df.columns
    assert rows(out, "cust_id") == [(str(c), "12/31/2020", "y") for c in range(1, 5)]


def test_earliest_and_null_ordering(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 5, "y"), ("a", 3, "z")],
                               "k string, o int, v string")
    # descending: NULL loses (DESC NULLS LAST); ascending: NULL wins (ASC NULLS FIRST)
    assert rows(keep_one_per_key(df, ["k"], "o", True), "k") == [("a", 5, "y")]
    assert rows(keep_one_per_key(df, ["k"], "o", False), "k") == [("a", None, "x")]


def test_ties_are_broken_by_the_other_columns(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 1, "q"), ("a", 1, "b")],
                               "k string, o int, v string")
    for parts in (1, 3):
        got = keep_one_per_key(df.repartition(parts), ["k"], "o")
        assert rows(got, "k") == [("a", 1, "q")]


def test_exact_dedup_keeps_multi_line_orders(spark):
    df = spark.createDataFrame(
        [("A-005", "2"), ("A-005", "3"), ("A-005", "3"), ("A-009", "4"), ("A-009", "7"),
         ("A-009", "11")], "order_id string, prod_id string")
    once = exact_dedup(df)
    assert once.count() == 5
    assert exact_dedup(once).count() == 5          # idempotent


def test_last_write_wins_uses_sequence_from_scan(spark):
    df = spark.createDataFrame(
        [("2020-01-28", "USD", 1.0), ("2020-01-28", "USD", 1.1), ("2020-01-29", "USD", 1.2)],
        "date string, currency string, conversion double").coalesce(1)
    seq = with_sequence(df, "seq")
    got = rows(last_write_wins(seq, ["date", "currency"], "seq").drop("seq"), "date")
    assert got == [("2020-01-28", "USD", 1.1), ("2020-01-29", "USD", 1.2)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # one key holds most rows; the plan must combine map-side
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("o"))
    out = keep_one_per_key(df, ["k"], "o")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    # aggregate below the exchange = rows combined before they move
    below = plan.split("Exchange", 1)[1]
    assert "Aggregate" in below
    assert out.filter("k = 0").first()["o"] == 19998
    assert out.count() == df.select("k").distinct().count()


def test_all_columns_as_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert keep_one_per_key(df, ["k", "v"], "v").count() == 2
    assert exact_dedup(df, ["k", "v"]).count() == 2
