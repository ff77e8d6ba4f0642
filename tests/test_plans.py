"""Plan shape of every registered query: built-in operators only, no
cartesian or nested-loop join, no window (so no single-task OVER ())."""
import pytest
from helpers import SF_SMALL, plan_text

from adlens.plans.queries import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
             "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window [")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_uses_builtin_operators(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = plan_text(df, "extended")
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
