"""Every registered query stays inside the rules: no Python UDFs, no cross
or nested-loop joins, nothing gathered into one partition except global
aggregates of already-reduced rows."""

import contextlib
import io
import re

import pytest

from orderlake.registry import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"]


def physical_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_rules(spark, key):
    plan = physical_plan(QUERIES[key](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"
    # a single-partition exchange may only feed a global aggregate's final step
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            above = "\n".join(lines[max(0, i - 2):i])
            assert re.search(r"HashAggregate\(keys=\[\]", above), f"{key}: {above}"
