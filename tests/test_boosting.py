"""Boosted trees and their SHAP values against brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest

from tablewise.operators import boosting as B
from tablewise.operators import shap as S

P = B.BoostParams(rounds=40, patience=5, depth=3, min_hessian=0.0)


def sums_of(rng, slots, filled):
    G, H = np.zeros((slots, B.WIDTH)), np.zeros((slots, B.WIDTH))
    for j in range(slots):
        at = [*range(filled), B.MISSING]
        G[j, at], H[j, at] = rng.normal(size=filled + 1), rng.uniform(0.1, 2.0, filled + 1)
    G[:, 0] += G[0].sum() - G.sum(axis=1)            # every slot sees the same rows
    H[:, 0] += H[0].sum() - H.sum(axis=1) + 3.0 * (slots > 1)
    H[0, 0] += 0.0
    return G, H


def gain(G, H, left, l2):
    tg, th = G.sum(), H.sum()
    lg, lh = G[left].sum(), H[left].sum()
    return 0.5 * (lg ** 2 / (lh + l2) + (tg - lg) ** 2 / (th - lh + l2) - tg ** 2 / (th + l2))


@pytest.mark.parametrize("seed", range(12))
def test_category_prefix_beats_every_subset(seed):
    G, H = sums_of(np.random.default_rng(seed), 1, 7)
    s = B.best_split(G, H, np.array([True]), P)
    every = max(gain(G[0], H[0], list(sub), P.l2) for n in range(1, 8)
                for sub in itertools.combinations([*range(7), B.MISSING], n))
    assert s.gain == pytest.approx(every)
    assert gain(G[0], H[0], np.flatnonzero(s.goes_left), P.l2) == pytest.approx(every)


@pytest.mark.parametrize("seed", range(6))
def test_threshold_and_missing_side(seed):
    G, H = sums_of(np.random.default_rng(seed), 1, 9)
    s = B.best_split(G, H, np.array([False]), P)
    tried = {(b, m): gain(G[0], H[0], [*range(b + 1), *[B.MISSING] * m], P.l2)
             for b in range(9) for m in (0, 1) if b < 8 or not m}
    assert s.gain == pytest.approx(max(tried.values()))
    b, m = max(tried, key=tried.get)
    assert s.goes_left[B.MISSING] == bool(m) and s.goes_left[:9].sum() == b + 1


def test_least_hessian_and_no_gain():
    G, H = np.zeros((1, B.WIDTH)), np.zeros((1, B.WIDTH))
    G[0, :3], H[0, :3] = [5.0, -1.0, -1.0], [0.5, 4.0, 4.0]
    assert B.best_split(G, H, np.array([False]), P).goes_left[:3].tolist() == [True, False, False]
    strict = B.BoostParams(min_hessian=1.0)
    assert B.best_split(G, H, np.array([False]), strict).goes_left[:3].tolist() == [True, True, False]
    assert B.best_split(G * 0.0, H, np.array([False]), P) is None


def block(seed, n=900, test=0.3):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 6, (4, n)).astype(np.uint8)
    bins[1][rng.uniform(size=n) < 0.2] = B.MISSING
    signal = (np.isin(bins[0], [1, 4]) * 1.5 + (bins[1] == B.MISSING) * 1.0 + (bins[2] > 3) * 0.8 - 1.5)
    y = (rng.uniform(size=n) < 1.0 / (1.0 + np.exp(-signal))).astype(float)
    return B.Block(bins, y, rng.uniform(size=n) < test, np.zeros(n))


CATEGORY = np.array([True, False, False, False])


def direct_tree(b, p):
    """The same tree by plain recursion: every node's sums from its own rows."""
    prob = 1.0 / (1.0 + np.exp(-b.margin))

    def value(rows):
        return -p.step * (prob - b.y)[rows].sum() / ((prob * (1 - prob))[rows].sum() + p.l2)

    out = np.zeros(len(b.y))

    def split(rows, every, depth):
        G, H = np.zeros((len(b.bins), B.WIDTH)), np.zeros((len(b.bins), B.WIDTH))
        for j, c in enumerate(b.bins):
            np.add.at(G[j], c[rows], (prob - b.y)[rows])
            np.add.at(H[j], c[rows], (prob * (1 - prob))[rows])
        s = B.best_split(G, H, CATEGORY, p) if depth < p.depth else None
        if s is None:
            out[every] = value(rows)
            return
        for side in (s.goes_left, ~s.goes_left):
            split(rows[side[b.bins[s.slot, rows]]], every[side[b.bins[s.slot, every]]], depth + 1)

    split(np.flatnonzero(~b.test), np.arange(len(b.y)), 0)
    return out


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_tree_equals_plain_recursion(depth):
    p = B.BoostParams(depth=depth)
    b = block(depth)
    tree = B.grow(lambda t, nodes: B.block_sums(b, [], t, nodes)[:2], CATEGORY, p)
    assert tree.depth == depth
    assert np.allclose(tree.margin(b.bins), direct_tree(b, p), atol=1e-12)


def frame(seed=3, n=1200):
    rng = np.random.default_rng(seed)
    x, c = rng.normal(size=n).round(1), rng.integers(0, 5, n).astype(float)
    x[rng.uniform(size=n) < 0.15] = np.nan
    signal = np.where(np.isnan(x), 1.2, x) + np.isin(c, [0, 3]) - 0.5
    y = (rng.uniform(size=n) < 1.0 / (1.0 + np.exp(-signal))).astype(int)
    return pd.DataFrame({"id": range(n), "x": x, "c": c, "y": y, "test": rng.uniform(size=n) < 0.3})


def local_fit(b, category, p, base):
    """Boosting on one block without Spark: losses and margins round by round."""
    margin, losses, margins = np.full(len(b.y), base), [], []
    for _ in range(p.rounds):
        now = B.Block(b.bins, b.y, b.test, margin)
        tree = B.grow(lambda t, nodes: B.block_sums(now, [], t, nodes)[:2], category, p)
        margin = margin + tree.margin(b.bins)
        margins.append(margin)
        losses.append(float(np.mean(np.log1p(np.exp(margin)) - b.y * margin, where=b.test)))
        if len(losses) - 1 - int(np.argmin(losses)) >= p.patience:
            break
    return losses, margins


@pytest.mark.parametrize("direct", [True, False])
def test_fit_equals_a_local_run(spark, monkeypatch, direct):
    """Rounds go on across renewals of the margins, stop by patience and are cut, not fitted again;
    with and without the tree of sums."""
    monkeypatch.setattr(B, "CELLS_PER_TASK", 500)
    if not direct:
        monkeypatch.setattr(B, "DIRECT_BYTES", 0)
    pdf = frame()
    data = spark.createDataFrame(pdf).repartition(5).cache()
    p = B.BoostParams(rounds=40, patience=6, depth=3, step=0.2)
    category = [False, True]
    model = B.fit_boosted(data, ["x", "c"], category, "y", "test", p)
    bins = model.bins_of([pdf["x"].to_numpy(), pdf["c"].to_numpy()])
    b = B.Block(bins, pdf["y"].to_numpy(float), pdf["test"].to_numpy(), None)
    losses, margins = local_fit(b, np.array(category), p, model.base)
    assert np.allclose(model.losses[1:], losses, atol=1e-9) and len(losses) > B.REFRESH
    best = int(np.argmin(losses)) + 1
    assert len(model.trees) == best and model.fitted == min(best + p.patience, p.rounds)
    got = B.with_margin(data, model, ["id"]).toPandas().sort_values("id")
    assert np.allclose(got["margin"], margins[best - 1], atol=1e-9)
    assert np.allclose(got["score"], 1.0 / (1.0 + np.exp(-margins[best - 1])))
    assert ((got["margin"] > 0) == (got["prediction"] == 1.0)).all()


def test_unseen_values_are_missing(spark):
    model = B.BoostedTrees(["x", "c"], [np.array([1.0, 2.0]), None], 0.0, [])
    df = spark.createDataFrame([(0.5, 1.0), (2.0, None), (9.0, 0.0), (None, 0.0), (float("nan"), 0.0)],
                               "x double, c double")
    cols = df.toArrow()
    bins = model.bins_of(B.slot_columns(cols.combine_chunks().to_batches()[0], model.slots))
    assert bins.tolist() == [[0, 1, 2, 255, 255], [1, 255, 0, 0, 0]]


def _expected(tree, x, known, node=0):
    """E[f(x) | x_known] that follows the covers at unknown slots."""
    slot = int(tree.slot[node])
    if slot < 0:
        return float(tree.value[node])
    l, r = int(tree.left[node]), int(tree.right[node])
    if slot in known:
        return _expected(tree, x, known, l if tree.goes_left[node, x[slot]] else r)
    share = tree.cover[l] / tree.cover[node]
    return share * _expected(tree, x, known, l) + (1 - share) * _expected(tree, x, known, r)


def _shapley(tree, x, m):
    phi = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for k in range(m):
            for sub in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                phi[i] += w * (_expected(tree, x, {*sub, i}) - _expected(tree, x, set(sub)))
    return phi


@pytest.mark.parametrize("depth", [1, 4, 6])
def test_pattern_tables_equal_brute_force_shapley(depth):
    """Trees with categories, missing rows and slots that come again on a path."""
    b = block(20 + depth, 2000)
    tree = B.grow(lambda t, nodes: B.block_sums(b, [], t, nodes)[:2], CATEGORY,
                  B.BoostParams(depth=depth, min_hessian=0.1))
    some = b.bins[:, :25]
    phi, expected = S.tree_shap(some, S.leaves_of(tree))
    assert expected == pytest.approx(_expected(tree, some[:, 0], set()))
    for r in range(some.shape[1]):
        assert phi[:, r] == pytest.approx(_shapley(tree, some[:, r], 4), abs=1e-10)
    assert np.allclose(phi.sum(axis=0) + expected, tree.margin(some))


def test_depth_is_bounded():
    from tablewise.operators.drift import DriftParams
    with pytest.raises(ValueError):
        DriftParams(max_depth=S.MAX_DEPTH + 1)


def test_native_plan(spark):
    """Few values: codes; a value for every few rows: label rates; nulls stay null."""
    from tablewise.operators.features import encode, plan_features
    rows = [(i, "ab"[i % 2], str(i % 30), None if i % 4 else float(i), [1] * (i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, few string, many string, v double, a array<int>")
    plan = plan_features(df, keep=["id"], encoding="native")
    assert plan.categorical == {"few": ["a", "b"]} and plan.rated == ["many"] and not plan.null_flags
    out = encode(df.withColumn("many__rate", df["v"]), plan, keep=["id"], vector_col=None)
    more = spark.createDataFrame([(1, "z", "0", float("nan"), None), (2, None, "0", 1.0, [])], df.schema)
    odd = encode(more.withColumn("many__rate", more["v"]), plan, keep=["id"], vector_col=None)
    assert [(r["few"], r["v"], r["a"]) for r in odd.orderBy("id").collect()] == [
        (None, None, None), (None, 1.0, 0.0)]
    assert out.where("few = 0").count() == 100 and out.where("v is null").count() == 150
