"""Layer 1: every registered query with an oracle equals DuckDB at sf0.01."""

import pytest

from tablewise.plans.queries import ORACLES, QUERIES
from tests.oracle_harness import compare, duck


@pytest.fixture(scope="module")
def con(sf01):
    return duck(sf01)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, sf01, name):
    sp = QUERIES[name](spark, sf01).toPandas()
    dp = con.execute(ORACLES[name]).df()
    ok, msg = compare(sp, dp)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["entity", "instance", "name", "value"]


def test_every_query_has_callable():
    import __spark_entry__ as e
    q = e.queries()
    assert set(e.oracle_sql()) <= set(q)
    assert all(callable(f) for f in q.values())


@pytest.mark.parametrize("name", ["slice_at_hour", "slice_three_days", "latest_slice",
                                  "slice_minute_all_days", "label_counts", "corrupt_mixed"])
def test_time_queries_do_not_depend_on_the_session_zone(spark, con, sf01, name):
    """Slot literals are built from text: the same rows under any session time zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sp = QUERIES[name](spark, sf01).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    ok, msg = compare(sp, con.execute(ORACLES[name]).df())
    assert ok, msg
