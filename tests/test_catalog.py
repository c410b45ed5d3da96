"""Every query runs, and those with a SQL twin equal it."""

import pytest

import catalog
import oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_query_equals_sql(spark, duck, name):
    result = catalog.queries()[name](spark, SF_DIR)
    assert oracle.compare(result, duck, catalog.oracles()[name]) is None
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracles())))
def test_query_without_twin_returns_rows(spark, name):
    assert catalog.queries()[name](spark, SF_DIR).count() > 0
