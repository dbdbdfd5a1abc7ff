"""Plan hygiene of every registered query: no cartesian products or nested-loop joins,
no row-at-a-time Python UDFs, and slice filters reach the scan."""

import pytest

from tablewise.plans.queries import QUERIES

# queries that train a model: their plans are built inside ML fit calls
MODEL_QUERIES = {"drift_model_metrics", "shap_mean_abs", "drift_report", "quality_report"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_plan_has_no_forbidden_operators(spark, sf001, name):
    df = QUERIES[name](spark, sf001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name", ["slice_at_hour", "slice_three_days", "slice_minute_all_days",
                                  "hash_sample", "profile_by_label"])
def test_slice_ranges_pushed_to_parquet(spark, sf001, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        df = QUERIES[name](spark, sf001)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_profile_plan_is_partial_final_aggregate(spark, sf001):
    df = QUERIES["profile_lineitem"](spark, sf001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("HashAggregate") == 2 and "SinglePartition" in plan
    assert "*(" in plan    # whole-stage codegen present
