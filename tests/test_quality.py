import pytest
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.operators import quality

RAW = "order_id string, cust_id string, quantity_raw string"


def classified(spark, data, **kw):
    return quality.classify_orders(spark.createDataFrame(data, RAW), **kw)


def test_precedence_and_codes(spark):
    df = classified(spark, [("A-21", None, "1"), ("A-22", " ", "0.1"), ("A-013", "3", "0.1"),
                            ("A-1", "1", "2"), ("A-2", "1", "2.0")])
    got = {r.order_id: (r._error_code, r._is_clean) for r in df.collect()}
    assert got["A-21"] == (K.NULL_CUST_ID, False)
    assert got["A-22"] == (K.NULL_CUST_ID, False)   # missing customer wins
    assert got["A-013"] == (K.INVALID_QTY, False)
    assert got["A-1"] == (None, True)
    assert got["A-2"] == (None, True)


def test_conservation_with_missing_quantity(spark):
    data = [("A-1", "1", None), ("A-2", "1", "x"), ("A-3", "1", "4"), ("A-4", None, "1")]
    c = classified(spark, data).cache()
    r = quality.conservation(c).first()
    assert (r.raw_rows, r.clean_rows, r.quarantined_rows, r.unclassified_rows) == (4, 1, 1, 2)
    opt = classified(spark, data, flag_missing_qty=True)
    codes = sorted(x._error_code or "-" for x in opt.collect())
    assert codes == ["-", K.MISSING_QTY, K.MISSING_QTY, K.NULL_CUST_ID]


def test_quarantine_tagging(spark):
    c = classified(spark, [("A-21", None, "1"), ("A-013", "3", "0.1"), ("A-1", "1", "2")])
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    err = quality.tag_quarantine(c, "orders.csv", ts)
    assert err.columns == ["order_id", "cust_id", "quantity_raw", "_error_code",
                           "_error_message", "_source_file", "_ingested_at"]
    got = {r.order_id: r for r in err.collect()}
    assert set(got) == {"A-21", "A-013"}
    assert got["A-013"]._error_message == K.ERROR_MESSAGES[K.INVALID_QTY]
    assert got["A-21"]._source_file == "orders.csv"
    assert [tuple(r) for r in quality.clean_rows(c).collect()] == [("A-1", "1", "2")]


def test_null_gate_raise_and_report(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 1.0)], "a int, b double")
    with pytest.raises(quality.QualityGateError, match="a in 1 rows; b in 2 rows"):
        quality.check_nulls(df, ["a", "b"], "t")
    assert quality.check_nulls(df, ["a", "b"], "t", mode="report") == {"a": 1, "b": 2}
    prof = {r.column_name: r.null_count for r in quality.null_profile(df, ["a", "b"]).collect()}
    assert prof == {"a": 1, "b": 2}


def test_row_count_gate(spark):
    assert quality.check_row_count(spark.range(3), 1, "t") == 3
    assert quality.check_row_count(5, 5, "t") == 5
    with pytest.raises(quality.QualityGateError):
        quality.check_row_count(spark.range(0), 1, "empty")
