"""What is registered, and the queries that have SQL."""

import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.compare import connect, difference
from tillgrain.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    registered = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered) and registered["pipeline"] is corpus_pipeline.run
    assert set(ORACLE) <= set(contract.oracle_sql()) and "pipeline" not in contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op11_phrases"}))
def test_one_row_for_every_row_of_the_table(spark, name):
    table = "pages" if name in ("op6_html", "op13_urls") else "documents"
    found = QUERIES[name](spark, SF_DIR)
    assert found.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_no_cross_join_and_no_local_checkpoint(spark):
    for name, query in QUERIES.items():
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan), name
