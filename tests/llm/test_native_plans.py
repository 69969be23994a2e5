"""The native operators stay on DataFrame functions: no Python, pandas or Arrow node in their plans.

A checkpoint shows as a scan of an existing RDD, and what ran before it is not in
the plan, so the plans of all tables that a query writes on its way are held too.
"""

import pytest

from learner_scoring.llm import common, mixing, queries

from tests.conftest import SF001


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("prefix, written", [("op2_", 0), ("op3_", 5), ("op7_", 2)])
def test_native_operator_has_no_python_node(spark, monkeypatch, prefix, written):
    (name,) = [n for n in queries.queries() if n.startswith(prefix)]
    plans, cut = [], common.cut

    def noted(df):
        plans.append(plan_of(df))
        return cut(df)

    for module in (common, mixing):
        monkeypatch.setattr(module, "cut", noted)
    plans.append(plan_of(queries.queries()[name](spark, SF001)))
    assert len(plans) == written + 1 and any("FileScan parquet" in p for p in plans)
    for plan in plans:
        for bad in ("Python", "InPandas", "InArrow", "MapPartitions", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)
