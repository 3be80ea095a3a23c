"""Plans of all queries: no pairs of everything, no window in a single task."""

import pytest

from paneloom import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()

#: String similarity, matrix solves, cycles over a group's rows, pages as text; everything else stays in the JVM.
WITH_PYTHON = {
    "fuzzy_block", "fuzzy_ratio", "fuzzy_tokens", "grouped_ridge", "category_weights", "category_importance",
    "chained_impute", "impute_by_bin", "impute_eras", "impute_three_cycles", "page_items", "page_table_rows", "redistribute",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for upper, lower in zip(lines, lines[1:]):
        # A single partition may only receive partial aggregates.
        if "Exchange SinglePartition" in upper:
            assert "partial" in lower or "HashAggregate(keys=[]" in lower, name
    if name not in WITH_PYTHON:
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name


def test_scans_read_only_needed_columns(spark):
    plan = QUERIES["modal_value"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in plan
    plan = QUERIES["scan_season"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(o_orderdate" in plan
