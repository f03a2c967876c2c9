"""Plan shape of every registered query: no pair-producing joins, no row-at-a-time
Python, no full outer sort-merge joins (they cannot be split by AQE)."""

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SortMergeJoin FullOuter",
             "FullOuter"]


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_plan_has_no_forbidden_operators(spark, key):
    df = entry.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, (key, bad)
