import json
import os

import pytest
from pyspark.sql import functions as F

from orderlake.sinks import AuditLog, TableStore, layer_row_counts, write_table
from orderlake.sources import (
    FX_SCHEMA, ORDERS_SCHEMA, read_csv_source, read_json_source, read_table)


def local(path):
    return path.replace("file:", "")


def test_csv_positional_schema_keeps_blanks(spark, tmp_root):
    d = local(tmp_root)
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/orders.csv", "w") as f:
        f.write("order_id,cust_id,order date,prod_id,quantity,status\n")
        f.write("A-1, ,1/5/2020 0:00,2,3, Shipped\n")
        f.write("A-2,,1/6/2020 0:00,3,0.1,PAID\n")
    df = read_csv_source(spark, d, ORDERS_SCHEMA)
    assert df.columns == ["order_id", "cust_id", "order_date_raw", "prod_id",
                          "quantity_raw", "status"]
    got = [tuple(r) for r in df.orderBy("order_id").collect()]
    assert got == [("A-1", " ", "1/5/2020 0:00", "2", "3", " Shipped"),
                   ("A-2", None, "1/6/2020 0:00", "3", "0.1", "PAID")]


def test_csv_malformed_record_is_kept_in_corrupt_column(spark, tmp_root):
    d = local(tmp_root)
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/orders.csv", "w") as f:
        f.write("order_id,cust_id,order date,prod_id,quantity,status\n")
        f.write("A-1,1,1/5/2020 0:00,2,3,PAID\n")
        f.write("A-2,1,1/5/2020 0:00,2,3,PAID,extra,fields\n")
    df = read_csv_source(spark, d, ORDERS_SCHEMA, corrupt_column="_corrupt_record").cache()
    bad = [r for r in df.collect() if r._corrupt_record is not None]
    assert df.count() == 2 and len(bad) == 1
    assert bad[0]._corrupt_record.startswith("A-2,")


def test_json_array_document_and_json_lines(spark, tmp_root):
    d = local(tmp_root)
    os.makedirs(f"{d}/array", exist_ok=True)
    os.makedirs(f"{d}/lines", exist_ok=True)
    rows = [{"date": "2020-01-28", "currency": "USD", "conversion": 1.0},
            {"date": "2020-01-28", "currency": "Yen", "conversion": 0.009}]
    with open(f"{d}/array/fx.json", "w") as f:
        json.dump(rows, f, indent=2)
    with open(f"{d}/lines/fx.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    a = read_json_source(spark, f"{d}/array", FX_SCHEMA, multi_line=True)
    b = read_json_source(spark, f"{d}/lines", FX_SCHEMA)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() == 2


def test_write_table_counts_and_is_idempotent(spark, tmp_root):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    name = "t_idem"
    assert write_table(df, name, f"{tmp_root}/idem") == 10
    assert write_table(df, name, f"{tmp_root}/idem") == 10      # overwrite, no duplicates
    assert read_table(spark, name).count() == 10


def test_store_layers_quarantine_overwrite_and_audit(spark, tmp_root):
    store = TableStore(spark, tmp_root, prefix="tst_")
    bad = spark.createDataFrame([("A-1", "NULL_CUST_ID")], "order_id string, _error_code string")
    assert store.write(bad, "error_tables", "err") == 1
    # next run quarantines nothing: one overwrite clears the stale row
    assert store.write(bad.limit(0), "error_tables", "err") == 0
    assert store.read("error_tables", "err").count() == 0
    log = AuditLog("run-1")
    log.record("BRONZE", "tst_bronze.x", 5)
    log.record("ERROR", "tst_error_tables.err", 0)
    assert log.flush(store) == 2
    log.record("GOLD", "tst_gold.y", 7)
    assert log.flush(store) == 1                                  # append
    assert store.read("audit", "pipeline_run_log").count() == 3
    counts = {r.table_name: r.row_count for r in layer_row_counts(
        store, {"error_tables": [("err", "e")], "gold": [("missing", "m")]}).collect()}
    assert counts == {"tst_error_tables.err": 0, "tst_gold.missing": None}


def test_typed_ddl_with_comments(spark, tmp_root):
    store = TableStore(spark, tmp_root, prefix="ddl_")
    store.create_table("audit", "log", "a STRING COMMENT 'first', n BIGINT", "audit table")
    store.create_table("audit", "log", "a STRING, n BIGINT", "again")   # IF NOT EXISTS
    cols = {c.name: c.description for c in spark.catalog.listColumns("ddl_audit.log")}
    assert cols == {"a": "first", "n": None}


def test_literal_frame_keeps_text_types_and_empty_sets(spark):
    import datetime as dt

    from pyspark.sql.types import (BooleanType, DateType, DoubleType, LongType, StringType,
                                   StructField, StructType)

    from orderlake.sources.literals import literal_frame
    schema = StructType([StructField("s", StringType()), StructField("n", LongType()),
                         StructField("x", DoubleType()), StructField("b", BooleanType()),
                         StructField("d", DateType())])
    rows = [('quote " apostrophe \' backslash \\ newline\n', 2**40, 1.5, True,
             dt.date(2020, 2, 29)),
            (None, None, None, None, None)]
    df = literal_frame(spark, rows, schema)
    assert df.schema == schema
    assert [tuple(r) for r in df.collect()] == rows
    empty = literal_frame(spark, [], schema)
    assert empty.schema == schema and empty.count() == 0
