"""Every registered query gives the rows its SQL gives in DuckDB, by a plan without cross joins."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import __spark_entry__ as registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


PYTHON_QUERIES = {  # the block products
    "r1_batch_similarity", "r3_block_scores", "r4_top_candidates", "r5_retrieval_evaluation", "r6_batch_loss",
    "r6_whole_batch_loss",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def check_plan(name, frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    assert name in PYTHON_QUERIES or not ("Python" in plan or "InPandas" in plan)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    check_plan(name, frame)
    difference = differences(frame, duck, SQL[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert registry.entry(spark).count() > 0
