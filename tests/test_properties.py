"""Property tests: bucketed AUC and the stratified split against brute force."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewise.operators.metrics import roc_auc
from tablewise.operators.sampling import stratified_split

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(n=st.integers(4, 300), levels=st.integers(1, 50), buckets=st.sampled_from([1, 3, 32]),
       seed=st.integers(0, 10_000))
def test_auc_property(spark, n, levels, buckets, seed):
    rng = np.random.default_rng(seed)
    s = rng.integers(0, levels, n).astype(float)
    y = rng.integers(0, 2, n)
    got = roc_auc(spark.createDataFrame(pd.DataFrame({"y": y, "s": s})), "y", "s",
                  buckets=buckets, range_rows=4).first()["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        assert got is None
        return
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert math.isclose(got, brute, abs_tol=1e-12)


@SETTINGS
@given(n=st.integers(1, 400), classes=st.integers(1, 4), dup=st.floats(0, 0.6),
       share=st.sampled_from([0.1, 0.2, 0.5]), seed=st.integers(0, 10_000))
def test_split_property(spark, n, classes, dup, share, seed):
    rng = np.random.default_rng(seed)
    keys = np.arange(n) + 1000
    keys[: int(n * dup)] = 5          # a group of copies of one key
    pdf = pd.DataFrame({"k": keys, "y": rng.integers(0, classes, n),
                        "v": rng.integers(0, 5, n)})
    df = spark.createDataFrame(pdf).repartition(3)
    out = stratified_split(df, "y", "k", share, 42).toPandas()
    assert len(out) == n
    for _, g in out.groupby("y"):
        assert g["is_test"].sum() == math.floor(len(g) * share + 0.5)
