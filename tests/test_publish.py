"""Staged publish, the one-scan split of the raw orders, and counts from written files."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from orderlake.operators import QualityGateError, dedup, quality
from orderlake.plans import bronze, pipeline
from orderlake.session import scratch_path
from orderlake.sinks import TableStore
from orderlake.sources import fixtures
from orderlake.sources import read_csv_source
from orderlake.sources.schemas import ORDERS_SCHEMA

SF = "/root/testdata/sf0.001"


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def ids(store, layer, table):
    return sorted(r[0] for r in store.read(layer, table).select("id").collect())


def refuse(rows, nulls, written):
    assert written.count() == rows                    # the gate sees the new rows
    raise QualityGateError(f"{rows} rows, {nulls}")


@pytest.mark.parametrize("declared", [False, True])
def test_a_failed_gate_leaves_the_rows_of_before(spark, tmp_root, declared):
    store = TableStore(spark, tmp_root, prefix=f"pub{int(declared)}_")
    if declared:
        store.create_table("silver", "t", "id BIGINT COMMENT 'number'")
    assert store.publish(spark.range(5), "silver", "t", keep_definition=declared) == (5, {})
    with pytest.raises(QualityGateError, match="3 rows, {'id': 0}"):
        store.publish(spark.range(10, 13), "silver", "t", refuse, null_columns=["id"],
                      keep_definition=declared)
    assert ids(store, "silver", "t") == list(range(5))
    assert len(store.versions("silver", "t")) == 1    # what the gate refused is gone
    store.publish(spark.range(10, 13), "silver", "t", keep_definition=declared)
    assert ids(store, "silver", "t") == [10, 11, 12]
    if declared:
        assert [c.description for c in spark.catalog.listColumns(store.name("silver", "t"))] \
            == ["number"]


def test_a_write_that_dies_leaves_the_rows_of_before(spark, tmp_root):
    store = TableStore(spark, tmp_root, prefix="pubd_")
    store.publish(spark.range(5), "silver", "t")
    broken = spark.range(8).withColumn("id", F.when(F.col("id") < 7, F.col("id")).otherwise(
        F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        store.publish(broken, "silver", "t")
    assert ids(store, "silver", "t") == list(range(5))
    assert len(store.versions("silver", "t")) == 1
    names = [t.name for t in spark.catalog.listTables("pubd_silver")]
    assert names == ["t"]                             # no staged table is left


def test_columns_may_change_and_readers_keep_the_version_before(spark, tmp_root):
    store = TableStore(spark, tmp_root, prefix="pubc_")
    store.publish(spark.range(3), "silver", "t")
    early = store.read("silver", "t")
    store.publish(spark.range(4).withColumn("more", F.lit("x")), "silver", "t")
    assert store.read("silver", "t").columns == ["id", "more"]
    assert early.count() == 3                         # files of the version before
    for n in (5, 6, 7):
        store.publish(spark.range(n).withColumn("more", F.lit("x")), "silver", "t")
    assert store.read("silver", "t").count() == 7
    assert len(store.versions("silver", "t")) == 2
    store.publish(spark.range(9), "silver", "b", bucket_by=(["id"], 2))
    store.publish(spark.range(8), "silver", "b", bucket_by=(["id"], 2))
    assert ids(store, "silver", "b") == list(range(8))
    assert [c.isBucket for c in spark.catalog.listColumns(store.name("silver", "b"))] == [True]


def test_a_run_that_a_gate_stops_keeps_the_tables_of_the_run_before(spark):
    store = TableStore(spark, scratch_path(spark, "keep"), prefix="keep_")
    feeds = fixtures.sources(spark, SF)
    first = pipeline.run(spark, feeds, store, null_gate_mode="report", as_of="2002-01-01")
    assert first.lost_lines == {"unknown_product":
                                first.counts["silver.orders"] - first.counts["silver.order_items"]}
    assert first.lost_lines["unknown_product"] == 62
    bad = dict(feeds)
    bad["orders"] = feeds["orders"].withColumn("quantity_raw", F.when(
        F.col("order_id") == "A-879", "abc").otherwise(F.col("quantity_raw")))
    with pytest.raises(QualityGateError):
        pipeline.run(spark, bad, store, null_gate_mode="raise")
    for key in ("bronze.orders", "error_tables.err_orders", "silver.customer",
                "gold.fact_orders"):
        assert store.read(*key.split(".")).count() == first.counts[key], key


def test_a_product_that_is_there_twice_stops_the_run(spark):
    store = TableStore(spark, scratch_path(spark, "twice"), prefix="twice_")
    feeds = dict(fixtures.sources(spark, SF))
    feeds["products"] = feeds["products"].union(feeds["products"].where("prod_id = '1'"))
    feeds["orders"] = feeds["orders"].where("prod_id in ('1', '2')")
    with pytest.raises(QualityGateError, match="more lines than orders have"):
        pipeline.run(spark, feeds, store, null_gate_mode="report")


# ---- the split --------------------------------------------------------------
def raw(spark, rows):
    return spark.createDataFrame(rows, ORDERS_SCHEMA)


def test_the_split_scans_the_feed_once(spark):
    b = bronze.build(fixtures.sources(spark, SF), "raw_orders", F.lit("2020-01-01").cast("timestamp"))
    text = plan(b.split)
    assert text.count("lineitem.parquet") == 1 and "CollectMetrics" not in text
    # the two tables apart would scan it once each
    assert plan(b.orders).count("lineitem.parquet") + plan(b.errors).count("lineitem.parquet") == 2


def test_clean_rows_are_combined_on_their_data_alone(spark):
    lines = [("A", "1", "1/1/2020 1:00", "5", "1", "x", "f2"), ("A", "1", "1/1/2020 1:00", "5", "1", "x", "f1"),
             ("A", "1", None, "5", "1", "x", "f3"), ("B", None, None, "5", "1", "x", "f1"),
             ("C", "1", None, "5", None, "x", "f1")]
    df = spark.createDataFrame(lines, ", ".join(
        f"{c} string" for c in [*ORDERS_SCHEMA.names, "_source_file"]))
    classified = bronze.classified_orders(df)
    clean = bronze.clean_orders(classified)
    assert "_error" not in next(x for x in plan(clean).splitlines() if "HashAggregate(keys" in x
                                or "SortAggregate(key" in x)
    split = bronze.split_orders(classified, "feed").where("_class = 'clean'")
    assert sorted(map(str, clean.collect())) == sorted(
        map(str, split.select(*clean.columns).collect()))
    assert sorted(r._source_file for r in clean.collect()) == ["f1", "f3"]


def test_equal_bad_rows_all_stay_and_counts_come_from_files(spark, tmp_root):
    good, blank = ("A", "1", "1/1/2020 1:00", "5", "1", "x"), ("B", " ", "1/1/2020 1:00", "5", "1", "x")
    odd = ("C", "1", "1/1/2020 1:00", "5", "abc", "x")
    df = raw(spark, [good] * 4000 + [blank] * 1500 + [odd] * 7 + [(*good[:5], "y")]).repartition(7)
    split = bronze.split_orders(bronze.classified_orders(df), "feed")
    split.write.partitionBy("_class").parquet(tmp_root)
    written = spark.read.schema(split.schema).parquet(tmp_root)
    want = {"raw_rows": 5508, "clean_rows": 4001, "quarantined_rows": 1500,
            "unclassified_rows": 7, "duplicate_rows": 3999}
    assert quality.split_counts(written, dedup.COPIES) == want
    assert quality.split_counts(written, dedup.COPIES) == want
    part = spark.read.schema(split.schema).parquet(f"{tmp_root}/_class=quarantined")
    assert part.count() == 1500 and {r._source_file for r in part.collect()} == {"feed"}


def test_file_feeds_are_combined_in_hash_tables(spark, tmp_root):
    folder = tmp_root.replace("file:", "") + "/in put#1%"
    os.makedirs(folder)
    line = "A-1,1,1/1/2020 1:00,5,1,x\n"
    for name, body in (("b é.csv", line * 3 + "A-2, ,1/1/2020 1:00,5,1,x\n"),
                       ("a+1.csv", line + "A-3,1,1/1/2020 1:00,5\n")):
        os.makedirs(f"{folder}/orders.csv", exist_ok=True)
        with open(f"{folder}/orders.csv/{name}", "w") as f:
            f.write("order_id,cust_id,date,prod_id,quantity,status\n" + body)
    feed = read_csv_source(spark, f"{folder}/orders.csv", ORDERS_SCHEMA,
                           corrupt_column=quality.CORRUPT) \
        .withColumn("_source_file", F.col("_metadata.file_path"))
    split = bronze.split_orders(bronze.classified_orders(feed), "feed")
    text = plan(split)
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert "ObjectHashAggregate" not in text
    rows = {(r.order_id, r._class): r for r in split.collect()}
    assert rows["A-1", "clean"]._copies == 4
    assert rows["A-1", "clean"]._source_file.endswith("/a+1.csv")       # the least path
    assert rows["A-2", "quarantined"]._source_file.endswith(".csv")
    assert "A-3" in rows["A-3", "quarantined"]._error_message
    assert sorted(r._class for r in split.collect()) == ["clean", "quarantined", "quarantined"]
    renamed = feed.withColumn("_source_file", F.lit("elsewhere"))
    with pytest.raises(Exception, match="is no file that is read"):
        bronze.split_orders(bronze.classified_orders(renamed), "feed").collect()


def test_distinct_rows_without_files(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d"), (None, "e")],
                               "k int, f string")
    got = dedup.distinct_rows(df, ["k"], file_col="f").collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 'a', 2)", "(2, 'c', 1)", "(None, 'd', 2)"]
    apart = dedup.distinct_rows(df, ["k"], F.col("k").isNull(), "f")
    assert apart.columns == ["k", "f", "_copies"]
    assert sorted(r.f for r in apart.collect()) == ["a", "c", "d", "e"]
