"""Every named query equals its DuckDB statement, in a plan without Python code or products of rows."""

import pytest

from tests.compare import difference
from txlake.workload import ORACLES, QUERIES

BANNED = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in BANNED if node in plan]
    assert difference(df, duck, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
