import math
import random

import pytest
from pyspark.sql import functions as F

from tablewise.llm import minhash_dedup as op
from tablewise.llm.components import components
from tests.llm.data import edge_docs, edge_rows, empty_docs, prose


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows, percent):
    """All pairs; rows that share an id are one node."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    known = [(i, s) for i, s in sets if s and i is not None]
    for x, (i, a) in enumerate(known):
        for j, b in known[:x]:
            both = len(a & b)
            if root(i) != root(j) and 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    low = {}
    for i, _ in known:
        low[root(i)] = min(low.get(root(i), i), i)
    comp = [i if i is None else low.get(root(i), i) for i, _ in sets]
    return sorted((str(i), len(s), str(c), i == c) for (i, s), c in zip(sets, comp))


def run(df, **kw):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept)
                  for r in op.near_duplicates(df, **kw).collect())


@pytest.mark.parametrize("percent", [80, 85])
def test_edge_rows(spark, percent):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    assert run(edge_docs(spark), percent=percent) == brute(rows, percent)


def test_empty(spark):
    assert run(empty_docs(spark)) == []
    only = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert run(only) == [("1", 0, "1", True), ("2", 0, "2", True)]


def family(n, seed, edits, sub_base=True):
    """Near copies of one text, some through a second text that is itself a far copy."""
    rng = random.Random(seed)
    base = prose(seed, 120).split()
    second = base[:]
    for _ in range(4):
        second[rng.randrange(120)] = f"sub{rng.randrange(99)}"
    out = []
    for i in range(n):
        w = (second if sub_base and i % 3 == 0 else base)[:]
        for _ in range(rng.randrange(edits)):
            at = rng.randrange(len(w))
            kind = rng.randrange(3)
            if kind == 0:
                w[at] = f"w{rng.randrange(6)}"           # few words, so copies share edits
            elif kind == 1:
                del w[at]
            else:
                w.insert(at, f"x{rng.randrange(1000)}")
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small,deep,depth", [(32, 256, 4), (3, 4, 4), (3, 4, 1)])
def test_families_lose_no_component(spark, monkeypatch, small, deep, depth):
    """Long lists go through centres; with tiny list sizes every step of it runs."""
    monkeypatch.setattr(op, "SMALL_LIST", small)
    monkeypatch.setattr(op, "DEEP_LIST", deep)
    monkeypatch.setattr(op, "FAMILY_DEPTH", depth)
    monkeypatch.setattr(op, "CENTRE_ROWS", 7)
    texts = family(90, 11, 7) + family(60, 12, 4, False) + [prose(i, 90) for i in range(200, 220)]
    rows = list(enumerate(texts)) + [(500 + i, t) for i, t in enumerate(texts[:20])]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert run(df, percent=85) == brute(rows, 85)


def test_whole_table(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept)
                 for r in op.op10_minhash_dedup(spark, sf01).collect())
    assert got == brute([tuple(r) for r in docs.collect()], 85)


def test_chance_of_missing_a_link_is_negligible():
    assert op.miss_probability(0.8) < 1e-7
    assert op.miss_probability(0.8, shared=int(op.ESTIMATE * op.SKETCH) + 1) < 1e-6


def test_bounds_follow_percent(spark):
    assert op.bounds(80) == op.bounds(100) == (op.SHARED, op.ESTIMATE)
    assert op.miss_probability(0.5, shared=int(op.ESTIMATE * op.SKETCH) + 1) > 0.1
    for percent in range(40, 80):
        shared, least = op.bounds(percent)
        assert op.miss_probability(percent / 100, shared=shared) < 1e-7
        assert op.miss_probability(percent / 100, shared=math.ceil(least * op.SKETCH)) < 1e-7
    with pytest.raises(ValueError):
        op.near_duplicates(empty_docs(spark), percent=30)
    rng = random.Random(4)                     # pairs of long sets of similarity 0.5
    rows = []
    for i in range(60):
        w = [f"w{rng.randrange(10 ** 9)}" for _ in range(600)]
        rows += [(2 * i, " ".join(w[:453])), (2 * i + 1, " ".join(w[151:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df, percent=49) == brute(rows, 49)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [
        (200, 201), (201, 200), (300, 300), (159, 90)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 90 for i in range(100, 160)}, 90: 90,
                   200: 200, 201: 200}
    assert components(df.limit(0)).count() == 0


def test_texts_that_share_an_id(spark):
    """Each of two texts of one id finds its near copy."""
    a, b = prose(31, 60), prose(32, 60)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, prose(33, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == brute(rows, 80)
    assert {c for i, _, c, _ in run(df) if i in "123"} == {"1"}
    left = sorted((r.doc_id, r.text) for r in op.deduplicate(df).collect())
    assert left == sorted([rows[0], rows[1], rows[4]])


def rows_left(rows, percent):
    """Brute force of ``deduplicate``: each row is a node; ids first, then rows without one."""
    left, sets = [], [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * both >= percent * (
                    len(sets[x]) + len(sets[y]) - both):
                old, new = group[x], group[y]
                group = [new if g == old else g for g in group]
    for g in set(group):
        found = [rows[i] for i in range(len(rows)) if group[i] == g]
        known = [r for r in found if r[0] is not None]
        if known:
            low = min(i for i, _ in known)
            left.append((low, {t for i, t in known if i == low}))
        else:
            left.append((None, {t for _, t in found}))
    return left


@pytest.mark.parametrize("seed", [1, 2])
def test_deduplicate_by_rows(spark, seed):
    rng = random.Random(seed)
    bases = [prose(40 + i, 50) for i in range(6)]
    rows = []
    for _ in range(60):
        w = rng.choice(bases).split()
        if rng.random() < 0.6:
            w[rng.randrange(50)] = f"x{rng.randrange(4)}"
        rows.append((rng.choice([None, *range(8)]), " ".join(w)))
    rows += [(None, None), (None, ""), (3, None), (3, " ")] + rows[:5]
    df = (spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
          .withColumn("n", F.lit(1)).withColumn("kid", F.lit("k")).withColumn("t1", F.rand(seed)))
    out = op.deduplicate(df)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    for row in [(None, None), (None, ""), (3, None), (3, " ")]:
        got.remove(row)                                  # without words: all stay
    want = rows_left([r for r in rows if shingle_set(r[1])], 80)
    assert len(got) == len(want)
    for i, texts in want:
        at = next(n for n, (j, t) in enumerate(got) if j == i and t in texts)
        got.pop(at)


def test_all_rows_without_an_id(spark):
    base = prose(50, 40)
    rows = [(None, base)] * 30 + [(None, prose(51 + i, 40)) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.text for r in op.deduplicate(df).collect())
    assert got == sorted({t for _, t in rows})


def test_documents_are_read_for_texts_once(spark, tmp_path, monkeypatch):
    """The sketches and one table of the wanted texts read the documents, whatever the number of
    rounds; the join of that table has the same plan at every size."""
    path = str(tmp_path / "docs")
    rows = list(enumerate(family(60, 4, 3) + [prose(i, 60) for i in range(8)]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    reads, plans = [], {}

    def cut(df, name, old=op.cut):
        if any("/docs/" in f for f in df.inputFiles()):
            reads.append(name)
            plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return old(df, name)

    monkeypatch.setattr(op, "cut", cut)
    monkeypatch.setattr(op, "SMALL_LIST", 8)
    assert run(spark.read.parquet(path), percent=80) == brute(rows, 80)
    assert reads == ["minhash-sketches", "minhash-wanted"]
    assert "SortMergeJoin" in plans["minhash-wanted"]
