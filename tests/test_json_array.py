"""A JSON array read in splits gives the rows of the whole document."""

import json
import os

import pytest
from pyspark.sql import functions as F

from orderlake.session import scratch_path
from orderlake.sources import readers
from orderlake.sources.schemas import FX_SCHEMA


def folder(spark, texts):
    path = scratch_path(spark, "json-array").replace("file:", "")
    os.makedirs(path)
    for i, text in enumerate(texts):
        with open(f"{path}/part{i}.json", "w", encoding="utf-8") as f:
            f.write(text)
    return path


def records(n):
    return [{"date": f"2020-{1 + i % 12:02}-{1 + i % 28:02}", "conversion": i / 7,
             "currency": ["USD", "YÉN", "a \"b\" [c], {d", "", None][i % 5]} for i in range(n)]


def both(spark, path):
    return [df.select(*FX_SCHEMA.names) for df in (
        readers.read_json_array(spark, path, FX_SCHEMA),
        readers.read_json_source(spark, path, FX_SCHEMA, multi_line=True))]


@pytest.mark.parametrize("indent", [None, 2])
def test_equal_rows_by_several_tasks(spark, indent):
    rows = records(4000)
    path = folder(spark, [json.dumps(rows, indent=indent, ensure_ascii=False)])
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "16384")
    try:
        split, whole = both(spark, path)
        assert split.rdd.getNumPartitions() > 10 and whole.rdd.getNumPartitions() == 1
        assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
        numbered = readers.with_write_order(readers.read_json_array(spark, path, FX_SCHEMA), "seq")
        got = numbered.orderBy(*readers.WRITE_ORDER, "seq").select("date", "conversion").collect()
        assert [r["date"] for r in got] == [r["date"] for r in rows]       # the order written
    finally:
        spark.conf.set(key, before)


def test_small_documents(spark):
    path = folder(spark, ["[]", " [ ]\n", "", '﻿[{"date": "2020-01-01", "currency": "USD"}]\n\n',
                          '[\n{"currency" :"X", "more": [1, 2]} ,{} ]'])
    got = readers.read_json_array(spark, path, FX_SCHEMA).select("date", "currency").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("2020-01-01", "USD"), (None, "X"), (None, None)], key=str)


@pytest.mark.parametrize("text", [
    '[{"date": "a}b", "currency": "X"}]', '[{"date": "a},{b", "currency": "X"}]',
    '[{"date": {"y": 1}, "currency": "X"}]', '[{"date": "a" "currency": "X"}]',
    '[{"date": "a"} {"date": "b"}]', '[{"date": "a"}, x {"date": "b"}]', '[{"date": "a"}], 5 ]'])
def test_seams_are_checked(spark, text):
    with pytest.raises(Exception, match="no flat record"):
        readers.read_json_array(spark, folder(spark, [text]), FX_SCHEMA).collect()


@pytest.mark.parametrize("text", ['[{"date": "a", "conversion": 1.3', '[{"date": "a"}', "[", '{"a": 1}'])
def test_cut_off_files_are_refused(spark, text):
    with pytest.raises(ValueError, match="no whole JSON array"):
        readers.read_json_array(spark, folder(spark, [text]), FX_SCHEMA)


def test_columns_are_pruned_in_the_parse(spark):
    path = folder(spark, [json.dumps(records(10))])
    df = readers.read_json_array(spark, path, FX_SCHEMA).where(F.col("currency") == "USD")
    assert df.count() == 2
