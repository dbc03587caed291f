import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from orderlake.session import build_session, work_root
    s = build_session("local[4]", 8, "orderlake-tests")
    work_root(s)          # registers a local checkpoint folder only if none is set
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from orderlake.session import scratch_path
    return scratch_path(spark, "t")
