import re

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference
from tillgrain.plans.catalog import QUERIES
from tillgrain.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
WITHOUT_SQL = {"churn_model_scores", "churn_model_importances", "category_reach"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert difference(df, duck, ORACLE[name]) is None
    else:
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas", plan)


def test_every_query_but_the_fitted_and_the_approximate_has_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
