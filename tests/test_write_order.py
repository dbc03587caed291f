"""The last written row over several files, and order times under any format and zone."""

import datetime as dt
import json
import os

import pytest

from orderlake.functions import parse_us_timestamp
from orderlake.plans import bronze
from orderlake.sources import FX_SCHEMA, read_json_source, with_write_order


def write(folder, name, rates, age, lines):
    os.makedirs(folder, exist_ok=True)
    rows = [{"date": "2020-01-01", "currency": c, "conversion": r} for c, r in rates]
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(map(json.dumps, rows)) if lines else json.dumps(rows))
    os.utime(f"{folder}/{name}", (1_600_000_000 - age, 1_600_000_000 - age))


@pytest.mark.parametrize("lines", [False, True])
@pytest.mark.parametrize("names", [("a.json", "b.json"), ("b.json", "a.json")])
def test_the_later_file_wins_whatever_its_name(spark, tmp_root, names, lines):
    folder = tmp_root.replace("file:", "") + "/fx"
    write(folder, names[0], [("USD", 1.0), ("YEN", 5.0), ("EUR", 7.0)], 1000, lines)
    write(folder, names[1], [("USD", 2.0), ("usd ", 3.0), ("EUR", 8.0)], 10, lines)
    feed = with_write_order(read_json_source(spark, folder, FX_SCHEMA, multi_line=not lines), "seq")
    got = bronze.latest_fx(feed)
    assert got.columns == ["date", "currency", "conversion", "seq"]
    assert {(r.currency, r.conversion) for r in got.collect()} == {
        ("usd ", 3.0), ("YEN", 5.0), ("EUR", 8.0)}


def test_blocks_of_a_split_file_are_in_order(spark, tmp_root):
    folder = tmp_root.replace("file:", "") + "/fx"
    write(folder, "one.json", [("USD", float(i)) for i in range(4000)], 0, True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        feed = with_write_order(read_json_source(spark, folder, FX_SCHEMA), "seq")
        assert feed.rdd.getNumPartitions() > 3
        (row,) = bronze.latest_fx(feed.repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert row.conversion == 3999.0


def test_order_times_in_every_zone(spark):
    texts = ["1/2/2020 7:05", " 12/31/1969 23:59 ", "6/30/2021 0:00", "2/29/2021 1:00", "1/2/2020",
             "1/2/2020 7:5", "1/2/2020 7:05Z", "x", "", None]
    want = [dt.datetime(2020, 1, 2, 7, 5), dt.datetime(1969, 12, 31, 23, 59),
            dt.datetime(2021, 6, 30), *[None] * 7]
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame([(t,) for t in texts], "t string")
            assert [r[0] for r in df.select(parse_us_timestamp("t")).collect()] == want, zone
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
