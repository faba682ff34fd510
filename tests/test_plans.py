"""Plan shape guards: no registered query may plan a cartesian product, a
nested-loop join or Python evaluation."""

import os

import pytest

import __spark_entry__ as entry
from orderlake import plans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_no_forbidden_operators(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name} plans {found}"
