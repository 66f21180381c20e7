"""Plan guards over every registered query: no cartesian product or nested-loop
join, no Python evaluation node. The queries are planned, not run; those that
write staged tables, snapshots or streams do that work while they are built."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("st")))
def test_plan_has_no_pairs_or_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"
