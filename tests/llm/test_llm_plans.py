"""Plans of the queries of this folder: no pairs of everything, no Python where only SQL functions are due."""

import pytest

from paneloom.llm import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
NATIVE = {"op5_chat", "op9_licenses", "op10_order_minhash"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
