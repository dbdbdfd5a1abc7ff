"""Identities and semantics of the operators (small inputs, brute-force references)."""

import json
import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewise.operators.corrupt import corrupt, hit_expr, null_coin
from tablewise.operators.metrics import confusion, rates, roc_auc
from tablewise.operators.profile import profile
from tablewise.operators.sampling import bounded_sample, sample_by_class, stratified_split
from tablewise.operators.slices import latest_slice, slice_at, slice_days


# ------------------------------------------------------------------ AUC

def test_auc_equals_rank_formula(spark):
    rng = np.random.default_rng(1)
    n = 400
    score = rng.integers(0, 30, n).astype(float)       # many ties
    y = (rng.uniform(0, 1, n) < 0.2 + score / 60).astype(int)
    pdf = pd.DataFrame({"y": y, "s": score})
    ranks = pdf["s"].rank(method="average")
    n1, n0 = int(y.sum()), int(n - y.sum())
    expect = (ranks[pdf["y"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    df = spark.createDataFrame(pdf)
    for buckets in (1, 4, 64):
        got = roc_auc(df, "y", "s", buckets=buckets, range_rows=5).first()["roc_auc"]
        assert got == pytest.approx(expect, abs=1e-12)
    assert roc_auc(df, "y", "s").first()["roc_auc"] == pytest.approx(expect, abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [1, 1, 1], "s": [0.1, 0.2, 0.3]}))
    assert roc_auc(df, "y", "s").first()["roc_auc"] is None


def test_rates_zero_division(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [0, 0, 1], "p": [0, 0, 0]}))
    r = rates(confusion(df, "y", "p")).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1_score"] == 0.0
    assert r["accuracy"] == pytest.approx(2 / 3)


# ------------------------------------------------------------------ profile

def _as_map(df):
    return {(r["instance"], r["name"]): r["value"] for r in df.collect()}


def test_profile_of_union_merges(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    a = ev.filter(F.col("event_id") % 2 == 0)
    b = ev.filter(F.col("event_id") % 2 == 1)
    pa, pb, pu = (_as_map(profile(x, approx_distinct=False)) for x in (a, b, ev))
    assert pu[("*", "Size")] == pa[("*", "Size")] + pb[("*", "Size")]
    for c in ("value", "user_id"):
        assert pu[(c, "Sum")] == pytest.approx(pa[(c, "Sum")] + pb[(c, "Sum")])
        assert pu[(c, "Minimum")] == min(pa[(c, "Minimum")], pb[(c, "Minimum")])
        assert pu[(c, "Maximum")] == max(pa[(c, "Maximum")], pb[(c, "Maximum")])


def test_profile_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None), (None, "ab"), (3, "abcd")], "a int, s string")
    m = _as_map(profile(df))
    assert m[("a", "Completeness")] == pytest.approx(2 / 3)
    assert m[("s", "MaxLength")] == 4 and m[("s", "MinLength")] == 2
    assert m[("a", "Mean")] == 2.0
    empty = _as_map(profile(df.filter(F.lit(False))))
    assert empty[("*", "Size")] == 0
    assert ("a", "Minimum") not in empty and ("a", "Completeness") not in empty
    assert empty[("a", "ApproxCountDistinct")] == 0


def test_profile_modes_agree(spark, sf01):
    li = spark.read.parquet(f"{sf01}/lineitem.parquet")
    one = _as_map(profile(li, sketches="shared"))
    two = _as_map(profile(li, sketches="separate"))
    assert one.keys() == two.keys()
    for k in one:
        assert one[k] == pytest.approx(two[k])


def test_grouped_profile(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    sl = slice_days(ev, "ts", "2024-01-30", "day", 3)
    g = profile(sl, approx_distinct=False, group_by=["label"])
    sizes = {r["label"]: r["value"] for r in g.filter("name = 'Size'").collect()}
    counts = {r["label"]: r["count"] for r in sl.groupBy("label").count().collect()}
    assert sizes == {k: float(v) for k, v in counts.items()}


# ------------------------------------------------------------------ slices

def test_slice_predicate_is_pushed_down(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    plan = slice_at(ev, "ts", "2024-01-30 10:00", "hour")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_minute_slice_matches_reference_form(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    at = "2024-01-29 07:13"
    ours = {r[0] for r in slice_at(ev, "ts", at, "minute").select("event_id").collect()}
    ref = {r[0] for r in ev.filter((F.to_date("ts") == F.lit("2024-01-29").cast("date")) &
                                   (F.date_format("ts", "HH:mm") == "07:13"))
           .select("event_id").collect()}
    assert ours == ref


def test_text_times_are_cast_leniently(spark):
    df = spark.createDataFrame([("2025-09-20 10:00:05",), ("garbage",), (None,)], "date_hour string")
    out = slice_at(df, "date_hour", "2025-09-20 10:00", "minute").collect()
    assert len(out) == 1


def test_latest_slice_labels(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    sl = latest_slice(ev, "ts", "day", n_days=2)
    days = {(r["d"], r["label"]) for r in
            sl.select(F.to_date("ts").alias("d"), "label").distinct().collect()}
    assert {str(d) for d, _ in days} == {"2024-01-29", "2024-01-30"}
    assert all((str(d) == "2024-01-30") == (lab == 1) for d, lab in days)


# ------------------------------------------------------------------ sampling

def test_stratified_split_exact(spark):
    """The test rows are the first ones by (hash of the key, key)."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": np.arange(1000), "y": (rng.uniform(0, 1, 1000) < 0.15).astype(int)})
    out = stratified_split(spark.createDataFrame(pdf), "y", "k", 0.2, 42).toPandas()
    assert len(out) == 1000 and out["k"].is_unique
    out["h"] = [int(hashlib.md5(f"{k}:split:42".encode()).hexdigest()[:8], 16) for k in out["k"]]
    for y, g in out.groupby("y"):
        n = math.floor(len(g) * 0.2 + 0.5)
        assert set(g.nsmallest(n, "h")["k"]) == set(g.loc[g.is_test, "k"])


@pytest.mark.parametrize("small_classes", [100_000, 0])
def test_split_and_samples_with_null_and_repeated_keys(spark, monkeypatch, small_classes):
    """No row is lost, quotas hold, and the same rows are chosen under any partitioning."""
    from tablewise.operators import sampling
    monkeypatch.setattr(sampling, "SMALL_CLASSES", small_classes)
    monkeypatch.setattr(sampling, "COPIES_BLOCK", 7)
    rng = np.random.default_rng(5)
    rows = [(None if i < 300 else 7 if i < 1200 else i, None if i % 11 == 0 else i % 3,
             float(rng.integers(0, 40)), None if i % 5 == 0 else f"t{i % 4}") for i in range(2400)]
    df = spark.createDataFrame(rows, "k long, y int, v double, s string")
    chosen = []
    for n in (1, 3, 7):
        out = stratified_split(df.repartition(n), "y", "k", 0.2).toPandas()
        assert len(out) == len(rows)
        for _, g in out.groupby(out["y"].fillna(-1)):
            assert g["is_test"].sum() == math.floor(len(g) * 0.2 + 0.5)
        chosen.append(sorted(map(str, out.itertuples(index=False, name=None))))
        for part in (sample_by_class(df.repartition(n), "y", 0.5, key="k"),
                     bounded_sample(df.repartition(n), 500, "k")):
            got = part.toPandas()
            chosen.append(sorted(map(str, got.itertuples(index=False, name=None))))
            assert 0.3 < got["k"].isna().mean() / (300 / 2400) < 2
    assert chosen[0::3] == [chosen[0]] * 3 and chosen[1::3] == [chosen[1]] * 3
    assert chosen[2::3] == [chosen[2]] * 3


def test_hash_sample_is_reproducible(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet").withColumn("label", F.col("user_id") % 2)
    a = sample_by_class(ev, "label", 0.5, 42, method="hash", key="event_id")
    b = sample_by_class(ev, "label", {0: 0.5, 1: 0.5}, 42, method="hash", key="event_id")
    ka = {r[0] for r in a.select("event_id").collect()}
    kb = {r[0] for r in b.select("event_id").collect()}
    assert ka == kb and 0.45 < len(ka) / ev.count() < 0.55
    full = sample_by_class(ev, "label", 1.0, 42, method="hash", key="event_id")
    assert full.count() == ev.count()


def test_bounded_sample_is_top_k(spark, sf01):
    li = spark.read.parquet(f"{sf01}/orders.parquet")
    s = bounded_sample(li, 100, "o_orderkey")
    assert s.count() == 100
    assert "TakeOrderedAndProject" in s._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ corruption

def test_hit_and_null_coin_are_independent(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    r = ev.agg(F.avg((hit_expr("event_id", "value", 0.5, 7)).cast("double")).alias("h"),
               F.avg((hit_expr("event_id", "value", 0.5, 7) &
                      null_coin("event_id", "value", 0.5, 7)).cast("double")).alias("both")).first()
    assert 0.47 < r["h"] < 0.53 and 0.22 < r["both"] < 0.28


def test_corrupt_only_where(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet").withColumn("cur", F.col("event_id") < 5000)
    bad = corrupt(ev, ["event_type", "value"], "event_id", 0.5, only_where=F.col("cur"))
    j = bad.alias("b").join(ev.alias("e"), "event_id")
    changed_old = j.filter(~F.col("e.cur") & ~F.col("b.event_type").eqNullSafe(F.col("e.event_type")))
    assert changed_old.count() == 0
    changed_new = j.filter(F.col("e.cur") & ~F.col("b.event_type").eqNullSafe(F.col("e.event_type")))
    assert 2000 < changed_new.count() < 3000


@pytest.mark.parametrize("n,frac", [(1, 0.5), (10, 0.3), (997, 0.31), (5000, 0.5), (300, 0.0), (300, 1.0)])
def test_exact_number_of_rows_per_column(spark, n, frac):
    from tablewise.operators.corrupt import exact_limits
    df = spark.range(n).select(F.col("id").alias("k"), F.lit("t").alias("a"), F.lit(1.5).alias("b"))
    df = df.unionByName(df.limit(2).select(F.lit(None).cast("long").alias("k"), "a", "b"))
    bad = corrupt(df, ["a", "b"], "k", frac, null_share=1.0, exact=True).cache()
    assert {c: bad.where(F.col(c).isNull()).count() for c in "ab"} == dict.fromkeys("ab", int(n * frac))
    some = corrupt(df, ["a"], "k", frac, null_share=1.0, exact=True, only_where=F.col("k") % 2 == 0)
    assert some.where("a is null").count() == int(((n + 1) // 2) * frac)
    assert some.where("a is null and (k is null or k % 2 = 1)").isEmpty()
    assert exact_limits(df.limit(0), ["a"], "k", 0.5) == {"a": (1 << 63) - 1}


def test_exact_limits_through_all_steps(spark, monkeypatch):
    """Draws that agree in their upper bits are told apart by the lower ones."""
    from tablewise.operators import corrupt as X
    places = [5, 5 + (1 << 47), 7, 6, (1 << 31) + 1, (1 << 31), 1 << 15, 3 << 15, (3 << 15) + 1]
    df = spark.createDataFrame(list(enumerate(places)), "k long, d long")
    monkeypatch.setattr(X, "draw", lambda key, column, salt: F.col("d"))
    for k in range(1, len(places)):
        limit = X.exact_limits(df, ["c"], "k", k / len(places) + 1e-9)["c"]
        assert sum(p <= limit for p in places) == k


# ------------------------------------------------------------------ drift

def test_drift_detects_corruption(spark, sf01):
    from tablewise.operators.drift import DriftParams, drift_model
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    sl = slice_days(ev, "ts", "2024-01-30", "day", 3)
    params = DriftParams(max_iter=10, max_depth=4)
    bad = corrupt(sl, ["value", "event_type"], "event_id", 0.5, only_where=F.col("label") == 1)
    res = drift_model(bad.cache(), "event_id", "events", exclude=["ts"], params=params,
                      keep_rows=True)
    m = {(r["type"], r["column"] or r["metric"]): r["value"] for r in res.metrics.collect()}
    assert m[("MLMetric", "roc_auc")] > 0.7
    shap = {k[1]: v for k, v in m.items() if k[0] == "SHAP"}
    assert shap["event_type"] > shap["user_id"] and shap["value"] > shap["user_id"]
    # additivity: sum of SHAP + expected value = log-odds of the model
    sv = res.shap.toPandas()
    raw = res.scored.select("event_id", "margin").toPandas()
    j = sv.merge(raw, on="event_id")
    assert np.allclose(j["log_odds"], j["margin"], atol=1e-9)

    clean = drift_model(sl.cache(), "event_id", "events", exclude=["ts"], params=params,
                        with_shap=False)
    auc = [r["value"] for r in clean.metrics.collect() if r["metric"] == "roc_auc"][0]
    assert 0.35 < auc < 0.65


def test_drift_in_a_rare_value(spark):
    """A value beyond the most frequent ones counts: it stands in a quarter of the new rows."""
    from tablewise.operators.drift import DriftParams, drift_model
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"id": range(4000), "c": [f"v{i}" for i in rng.integers(0, 300, 4000)],
                        "label": rng.integers(0, 2, 4000)})
    params = DriftParams(max_iter=20, max_depth=3)

    def auc(frame):
        m = drift_model(spark.createDataFrame(frame), "id", "t", params=params,
                        with_shap=False).metrics
        return m.where("metric = 'roc_auc'").first()["value"]
    assert 0.4 < auc(pdf) < 0.6
    pdf.loc[(pdf["label"] == 1) & (rng.uniform(size=4000) < 0.3), "c"] = "rare"
    assert auc(pdf) > 0.57


def test_boosting_stops_by_patience(spark):
    from tablewise.operators.drift import DriftParams, drift_model
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": range(600), "x": rng.normal(size=600), "label": rng.integers(0, 2, 600)})
    res = drift_model(spark.createDataFrame(pdf), "id", "t", with_shap=False,
                      params=DriftParams(max_depth=2, patience=3))
    losses = res.notes["test_loss"]
    best = min(range(len(losses)), key=losses.__getitem__)
    assert res.notes["trees"] == best + 1 and res.notes["fitted"] == len(losses) == best + 1 + 3


def test_nan_counts_as_missing(spark):
    from tablewise.operators.features import encode, plan_features
    df = spark.createDataFrame([(1, 1.5), (2, float("nan")), (3, None)], "id long, v double")
    plan = plan_features(df, keep=["id"])
    assert plan.null_flags == ["v"]
    rows = {r["id"]: (r["v"], r["v__isnull"]) for r in
            encode(df, plan, keep=["id"], vector_col=None).collect()}
    assert rows == {1: (1.5, 0.0), 2: (0.0, 1.0), 3: (0.0, 1.0)}


def test_drift_single_class_gives_null_metrics(spark, sf01):
    from tablewise.operators.drift import drift_model
    ev = spark.read.parquet(f"{sf01}/events.parquet").withColumn("label", F.lit(1))
    res = drift_model(ev, "event_id", "events", exclude=["ts"])
    vals = [r["value"] for r in res.metrics.collect()]
    assert len(vals) == 5 and all(v is None for v in vals)


# ------------------------------------------------------------------ sinks, sources, config

def test_exposition_escaping_and_numeric_guard(spark):
    from tablewise.sources.sinks import exposition_lines
    df = spark.createDataFrame([('a"b', "x\\y\nz", "1.5"), (None, "q", "oops")],
                               "t string, c string, value string")
    lines = [r[0] for r in exposition_lines(df, "m", [("t", F.col("t")), ("c", F.col("c"))]).collect()]
    assert lines == ['m{t="a\\"b",c="x\\\\y\\nz"} 1.5']


def test_suggestion_documents(spark, sf01):
    from tablewise.operators.suggest import suggest
    from tablewise.sources.sinks import suggestions_by_column, suggestions_document
    s = suggest(spark.read.parquet(f"{sf01}/orders.parquet"))
    doc = json.loads(suggestions_document(s, "orders").first()["json"])
    assert doc["table"] == "orders" and len(doc["suggestions"]) == s.count()
    assert set(doc["suggestions"][0]) == {"constraint_name", "column_name", "current_value",
                                          "description", "suggesting_rule", "rule_description",
                                          "code_for_constraint"}
    per_col = [json.loads(r[0]) for r in suggestions_by_column(s).collect()]
    assert {d["column"] for d in per_col} == set(spark.read.parquet(f"{sf01}/orders.parquet").columns)


def test_type_inference(spark):
    from tablewise.operators.suggest import column_profile
    df = spark.createDataFrame([("1", "1.5", "true", "x", "1"), ("2", "2", "false", "1", "true")],
                               "i string, f string, b string, s string, mixed string")
    t = {r["column"]: r["inferred_type"] for r in column_profile(df).collect()}
    assert t == {"i": "Integral", "f": "Fractional", "b": "Boolean", "s": "String",
                 "mixed": "String"}


def test_run_config_from_conf(spark):
    from tablewise.plans.jobs import RunConfig
    spark.conf.set("spark.tablewise.table", "cdr")
    spark.conf.set("spark.tablewise.sample_frac", "0.25")
    spark.conf.set("spark.tablewise.exclude", "record_id, call_start")
    spark.conf.set("spark.tablewise.run_ts", "2025-09-20T10:00:00")
    try:
        cfg = RunConfig.from_conf(spark, key="record_id")
    finally:
        for k in ("table", "sample_frac", "exclude", "run_ts"):
            spark.conf.unset(f"spark.tablewise.{k}")
    assert cfg.table == "cdr" and cfg.sample_frac == 0.25 and cfg.key == "record_id"
    assert cfg.exclude == ("record_id", "call_start") and cfg.run_ts == "2025-09-20 10:00:00"


def test_jdbc_options():
    from tablewise.sources.readers import jdbc_options
    o = jdbc_options("jdbc:x://h/db", "t", user="u", partition_column="id", lower_bound=0,
                     upper_bound=100, num_partitions=4)
    assert o["numPartitions"] == "4" and "password" not in o
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", "t", partition_column="id")


def test_stratified_split_with_a_hot_key(spark):
    """A third of the rows share one key: counts stay exact, and the split equals the
    order (hash(key), key) on the distinct keys."""
    rng = np.random.default_rng(11)
    n = 3000
    keys = np.where(np.arange(n) < n // 3, 7, np.arange(n) + 100)
    pdf = pd.DataFrame({"k": keys, "y": (rng.uniform(0, 1, n) < 0.3).astype(int),
                        "v": rng.normal(size=n)})
    df = spark.createDataFrame(pdf).repartition(6, "v")
    out = stratified_split(df, "y", "k", 0.2, 42).toPandas()
    assert len(out) == n
    for y, g in out.groupby("y"):
        assert g["is_test"].sum() == math.floor(len(g) * 0.2 + 0.5)
    # keys fully on one side, except at most one boundary key per class
    mixed = out.groupby(["y", "k"])["is_test"].nunique()
    assert (mixed > 1).groupby(level=0).sum().max() <= 1


def test_run_config_loads_and_runs_a_job(spark, sf001):
    from tablewise.plans.jobs import RunConfig, drift_report, table_report
    cfg = RunConfig(table="events", ts_col="ts", key="event_id", grain="day",
                    path=f"{sf001}/events.parquet", max_iter=3, max_depth=3,
                    run_ts="2024-01-31 00:00:00")
    df = cfg.load(spark)
    assert df.count() == 1000
    rows = drift_report(df, cfg, with_shap=False).rows().collect()
    sections = {r["section"] for r in rows}
    assert sections == {"profile", "counts", "drift"}
    t = table_report(df, "events").rows()
    assert t.filter("section = 'suggestions'").count() > 0
    with pytest.raises(ValueError):
        RunConfig(path=None).load(spark)


@pytest.mark.parametrize("fmt", ["orc", "json", "parquet"])
def test_read_path_formats(spark, sf001, fmt):
    from tablewise.session import shared_dir
    from tablewise.sources.readers import read_path
    nation = spark.read.parquet(f"{sf001}/nation.parquet")
    path = shared_dir(spark, f"fmt-{fmt}")
    nation.write.format(fmt).save(path)
    back = read_path(spark, path, fmt, schema=nation.schema)
    assert sorted(back.collect()) == sorted(nation.collect())


def test_array_length_features(spark):
    from tablewise.operators.features import encode, plan_features
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, None, 1), (3, [], 0), (4, [3.0], 1)],
                               "id long, emb array<double>, label int")
    plan = plan_features(df, keep=["id"])
    assert plan.arrays == ["emb"] and plan.null_flags == ["emb"]
    rows = {r["id"]: (r["emb"], r["emb__isnull"]) for r in
            encode(df, plan, keep=["id"], vector_col=None).collect()}
    assert rows == {1: (2.0, 0.0), 2: (0.0, 1.0), 3: (0.0, 0.0), 4: (1.0, 0.0)}


def test_auc_ranges_same_result(spark, sf01):
    lab = spark.read.parquet(f"{sf01}/labels.parquet")
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "n_chars")
    scored = lab.join(docs, "doc_id")
    a = roc_auc(scored, "quality", "n_chars", buckets=8, range_rows=20).first()[0]
    b = roc_auc(scored, "quality", "n_chars").first()[0]
    assert a == pytest.approx(b, abs=1e-12)


def test_run_config_aliases(spark):
    from tablewise.plans.jobs import RunConfig
    keys = {"spark.tableName": "cdr", "spark.sampleFrac": "0.3",
            "spark.ts.value": "2025-09-20T10:00:00", "spark.jdbc.url": "jdbc:x://h/db",
            "spark.jdbc.user": "u", "spark.jdbc.password": "p"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        cfg = RunConfig.from_conf(spark)
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert cfg.table == "cdr" and cfg.sample_frac == 0.3 and cfg.run_ts == "2025-09-20 10:00:00"
    assert cfg.source_format == "jdbc"
    assert cfg.source_options == {"url": "jdbc:x://h/db", "user": "u", "password": "p"}


def test_run_from_conf_writes_sinks(spark, sf001):
    from tablewise.plans.run import run
    from tablewise.session import shared_dir
    out = shared_dir(spark, "run-out")
    keys = {"spark.tablewise.table": "events", "spark.tablewise.path": f"{sf001}/events.parquet",
            "spark.tablewise.ts_col": "ts", "spark.tablewise.key": "event_id",
            "spark.tablewise.grain": "day", "spark.tablewise.at": "2024-01-30",
            "spark.tablewise.max_iter": "3", "spark.tablewise.max_depth": "3",
            "spark.tablewise.run_id": "night/1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        run(spark, job="quality", output=out)
    finally:
        for k in keys:
            spark.conf.unset(k)
    from tablewise.sources.publish import published, read_published
    (folder,) = published(spark, out).values()
    m = read_published(spark, out, "metrics")
    assert {r[0] for r in m.select("section").distinct().collect()} == \
        {"suggestions", "profile", "counts", "drift"}
    doc = json.loads(spark.read.text(f"{folder}/suggestions_flat").first()[0])
    assert doc["table"] == "events" and doc["suggestions"]
    lines = [r[0] for r in spark.read.text(f"{folder}/exposition/profile").collect()]
    assert lines and all(l.startswith('tablewise_profile_metric{table="events",entity="') for l in lines)
    lines = [r[0] for r in spark.read.text(f"{folder}/exposition/ml").collect()]
    assert lines and all(l.startswith('tablewise_ml_metric{path="') and ',metric_type="' in l for l in lines)


def test_states_merge_like_the_rows(spark, sf01):
    """Any set of slots equals the profile of its rows; sketches within their error; odd slots."""
    from tablewise.operators.states import profile_from_states, slot_states
    ev = spark.read.parquet(f"{sf01}/events.parquet")
    ev = ev.withColumn("value", F.when(F.col("event_id") % 7 > 0, F.col("value")))
    states = slot_states(ev, "ts", "hour").cache()
    for where in ("true", "hour(slot) = 3", "slot < timestamp_ntz '2024-01-10 00:00:00'", "false"):
        rows = ev.where(where.replace("slot", "date_trunc('hour', ts)"))
        want = {(r.entity, r.instance, r.name): r.value for r in profile(rows).collect()}
        got = {(r.entity, r.instance, r.name): r.value
               for r in profile_from_states(states.where(where)).collect()}
        if where == "false":
            assert got == {}
            continue
        assert set(got) == set(want)
        exact = rows.agg(*[F.countDistinct(c).alias(c) for c in ev.columns]).first()
        for k, v in got.items():
            if k[2] == "ApproxCountDistinct":
                assert abs(v - exact[k[1]]) <= max(1, 0.06 * exact[k[1]])
            else:
                assert v == pytest.approx(want[k], rel=1e-9)
    text = ev.select(F.col("ts").cast("string").alias("ts"), "user_id").unionByName(
        spark.createDataFrame([(None, 1), ("no time", 2)], "ts string, user_id long"))
    total = {r.instance: r.value for r in profile_from_states(slot_states(text, "ts")).where(
        "name in ('Size', 'Completeness')").collect()}
    assert total == {"*": ev.count(), "ts": 1.0, "user_id": 1.0}


def test_a_killed_run_publishes_nothing_and_a_retry_replaces(spark):
    from tablewise.session import shared_dir
    from tablewise.sources.publish import drop_unpublished, publish_run, published, read_published
    out = shared_dir(spark, "publish")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n long, t string")

    def write(folder, df=rows, dies=False):
        df.write.parquet(f"{folder}/metrics")
        if dies:
            raise RuntimeError("killed between two outputs")
        df.write.parquet(f"{folder}/more")

    assert published(spark, out) == {} and read_published(spark, out, "metrics", "n long").count() == 0
    with pytest.raises(RuntimeError):
        publish_run(spark, out, "monday 1", lambda f: write(f, dies=True))
    assert published(spark, out) == {}
    publish_run(spark, out, "monday 1", write)
    publish_run(spark, out, "monday_1", lambda f: write(f, rows.limit(1)))
    assert set(published(spark, out)) == {"monday 1", "monday_1"}
    assert read_published(spark, out, "metrics").count() == 3
    with pytest.raises(RuntimeError):                  # a later attempt that dies changes nothing
        publish_run(spark, out, "monday 1", lambda f: write(f, rows.limit(0), dies=True))
    assert read_published(spark, out, "more", runs=["monday 1"]).count() == 2
    publish_run(spark, out, "monday 1", lambda f: write(f, rows.limit(1)))
    assert read_published(spark, out, "metrics").count() == 2
    assert drop_unpublished(spark, out) == 3
    assert read_published(spark, out, "metrics").count() == 2


def test_bernoulli_sample_by_class(spark, sf01):
    ev = spark.read.parquet(f"{sf01}/events.parquet").withColumn("label", F.col("user_id") % 2)
    s = sample_by_class(ev, "label", 0.5, 42, method="bernoulli")
    n = s.count()
    assert 0.4 < n / ev.count() < 0.6
    assert sample_by_class(ev, "label", 1.0, 42, method="bernoulli").count() == ev.count()


def test_value_summary_decides_by_exact_counts(spark):
    """Around the limit, with nulls, with very many values and with very long ones."""
    from tablewise.operators.suggest import column_profile, exact_values
    n = 6000
    ids = spark.range(n).repartition(5)
    names = {"few": 3, "at": 120, "over": 121, "near": 300, "many": n}
    df = ids.select(*[(F.col("id") % k).cast("string").alias(c) for c, k in names.items()],
                    F.when(F.col("id") % 2 == 0, (F.col("id") % 240).cast("string")).alias("half"),
                    F.concat(F.repeat(F.lit("x"), 2000), (F.col("id") % 4).cast("string")).alias("long"),
                    F.lit(None).cast("string").alias("none"))
    got = {r["column"]: exact_values(r, 120) for r in column_profile(df).collect()}
    assert {c: len(v) for c, v in got.items() if v} == {"few": 3, "at": 120, "half": 120}
    assert got["over"] == got["near"] == got["many"] == got["none"] == [] and got["long"] is None
    assert dict(got["at"]) == {str(i): n // 120 for i in range(120)}


def test_long_values_are_counted_in_a_scan_of_their_own(spark):
    from tablewise.operators.suggest import suggest
    df = spark.range(400).select(
        F.concat(F.repeat(F.lit("x"), 2000), (F.col("id") % 4).cast("string")).alias("long"),
        F.concat(F.repeat(F.lit("y"), 2000), (F.col("id") % 130).cast("string")).alias("over"))
    rules = suggest(df).where("rule = 'categorical'").collect()
    assert [r["column_name"] for r in rules] == ["long"] and len(rules[0]["value_list"]) == 4


def test_column_profile_chunks_agree(spark, sf01):
    from tablewise.operators.suggest import column_profile
    o = spark.read.parquet(f"{sf01}/orders.parquet")
    key = lambda rows: sorted(tuple(r) for r in rows)
    assert key(column_profile(o, chunk=3).collect()) == key(column_profile(o).collect())
