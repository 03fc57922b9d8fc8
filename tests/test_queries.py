"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import compare, connect

from __spark_entry__ import entry
from tidemill.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name)) == ""


def test_entry(spark):
    assert entry(spark).columns == ["c_mktsegment", "count_rows", "sum_o_totalprice"]


def test_no_python_in_the_data_path(spark):
    """No registered batch query plans a Python UDF, a cartesian product or a nested loop."""
    for name, run in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, f"{name}: {word}"
