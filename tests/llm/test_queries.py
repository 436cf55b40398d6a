"""The operators' registered queries against their SQL, and the plans of those without Python."""

import compare
import pytest

import __spark_entry__ as entry
from footfall.llm.oracle import llm_oracles
from footfall.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", [*llm_queries(), "pipeline"])
def test_query_equals_sql(spark, con, name):
    assert compare.compare(spark, con, name, entry.queries()[name], llm_oracles().get(name), SF) is None


@pytest.mark.parametrize("name", ["op9_pii", "op10_quality_rules"])
def test_native_queries_have_no_python(spark, name):
    plan = llm_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "Python", "InPandas", "InArrow"):
        assert word not in plan
