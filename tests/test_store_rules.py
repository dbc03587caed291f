"""What a table store refuses: another root under a known name, undeclared
columns, counts that a write did not deliver; and FX currencies after clean-up."""

import pytest

from orderlake.operators import QualityGateError
from orderlake.operators.quality import check_unique
from orderlake.plans import bronze
from orderlake.session import scratch_path, work_root
from orderlake.sinks import TableStore
from orderlake.sinks.tables import _observed


def test_a_second_root_under_the_same_names_is_refused(spark):
    first = TableStore(spark, scratch_path(spark, "one"), prefix="roots_")
    first.create_table("bronze", "t", "a INT")
    again = TableStore(spark, first.root, prefix="roots_")
    again.create_table("bronze", "t", "a INT")
    second = TableStore(spark, scratch_path(spark, "two"), prefix="roots_")
    with pytest.raises(ValueError, match="is registered at"):
        second.create_table("bronze", "t", "a INT")


def test_undeclared_columns_raise(spark, tmp_root):
    store = TableStore(spark, tmp_root, prefix="extra_")
    store.create_table("bronze", "t", "a INT")
    with pytest.raises(ValueError, match="undeclared columns \\['b'\\]"):
        store.write_observed(spark.sql("SELECT 1 AS a, 2 AS b"), "bronze", "t",
                             keep_definition=True)


def test_a_missing_count_raises():
    class Seen:
        get = {"rows": 1}

    assert _observed(Seen, []) == (1, {})
    with pytest.raises(KeyError):
        _observed(Seen, ["a"])


def test_currencies_that_differ_by_case_are_one(spark):
    raw = spark.createDataFrame([("2020-01-01", "Yen", 1.0, 1), ("2020-01-01", "YEN ", 2.0, 2),
                                 ("2020-01-01", "USD", 1.0, 3)],
                                "date string, currency string, conversion double, seq long")
    got = sorted(tuple(r) for r in bronze.latest_fx(raw).collect())
    assert got == [("2020-01-01", "USD", 1.0, 3), ("2020-01-01", "YEN ", 2.0, 2)]
    check_unique(raw, ["date", "currency"], "fx")
    with pytest.raises(QualityGateError, match="fx: several rows"):
        check_unique(raw, ["date"], "fx")


def test_no_local_work_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_root(Session)
