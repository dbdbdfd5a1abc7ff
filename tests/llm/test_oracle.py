"""Queries with oracle SQL equal DuckDB; every query runs on the smallest tables."""

import pytest

from tablewise.llm.queries import ORACLES, QUERIES
from tests.oracle_harness import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf01, name):
    ok, msg = compare(QUERIES[name](spark, sf01).toPandas(), duck(sf01).execute(ORACLES[name]).df())
    assert ok, msg


def test_one_query_per_operator():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairs_of_everything(spark, sf001, name):
    df = QUERIES[name](spark, sf001)
    assert df.count() >= 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan
