import hashlib
import random

import numpy as np
import pytest
import xxhash

from tablewise.llm import suffix_dedup as op
from tests.llm.data import edge_docs, edge_rows, empty_docs


def made_id(text):
    return -2 ** 63 + xxhash.xxh64_intdigest(text.encode(), 42) % 2 ** 62


def brute(rows, length=100):
    """Rows in corpus order; rows with one id do not remove each other's text."""
    rows = sorted((made_id(t or "") if i is None else i, (t or "").encode()) for i, t in rows)
    first, out = {}, []
    for i, b in rows:
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], i)
    for i, b in rows:
        gone, seen = bytearray(len(b)), set()
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if first[s] < i or s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i if i >= -2 ** 62 else -2 ** 63, len(b), sum(gone), spans,
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(df, **kw):
    return sorted((-2 ** 63 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans,
                   r.kept_sha256) for r in op.deduplicate(df, **kw).collect())


def repetitive(n=60):
    rng = random.Random(5)
    base = "".join(rng.choice("ab ") for _ in range(3000))
    rows = []
    for i in range(n):
        a, j = rng.randrange(2500), rng.randrange(2000)
        rows.append((3 * i, base[a:a + rng.randrange(50, 900)]
                     + "".join(rng.choice("xyz ") for _ in range(rng.randrange(0, 200)))
                     + base[j:j + rng.randrange(20, 400)]))
    return rows


def test_rows_without_an_id_are_documents_of_their_own(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdef ") for _ in range(400))
    rows = [(None, f"{i} " + base + f" {i}") for i in range(40)] + [(None, "7 " + base + " 7"), (5, base)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_edge_rows(spark):
    assert run(edge_docs(spark)) == brute([(i, t) for i, t, *_ in edge_rows()])
    assert run(empty_docs(spark)) == []


@pytest.mark.parametrize("length", [40, 100])
def test_repetitive_texts(spark, monkeypatch, length):
    rows = repetitive()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, length)
    assert run(df, length=length) == want
    monkeypatch.setattr(op, "CHUNK", 64)             # phrases broken at chunk borders
    monkeypatch.setattr(op, "FLUSH_ROWS", 10)
    monkeypatch.setattr(op, "SAMPLE", 1)              # many triggers count as common
    assert run(df, length=length) == want


def test_whole_table(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    got = [tuple(r) for r in op.op7_suffix_dedup(spark, sf001).collect()]
    assert sorted(got) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_kept_text_and_carried_columns(spark):
    rows = [(1, "é" * 120, "x"), (2, "z" + "é" * 60 + "tail" * 30, None), (3, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in op.deduplicate(df, with_kept=True, carry=("kept", "text")).collect()}
    for i, text, extra in rows:
        r = got[i]
        data = (text or "").encode()
        gone = {b for a, z in r.spans for b in range(a, z)}
        assert bytes(r.kept) == bytes(x for j, x in enumerate(data) if j not in gone)
        assert r.kept_text == bytes(r.kept).decode("utf-8", "ignore")
        assert r.row.kept == extra and r.row.text == text
    assert got[1].n_removed > 0 and got[2].spans[0] == [1, 121]


def test_texts_are_shuffled_once(spark):
    """The join with the open phrases and the join at the end use one exchange of the texts."""
    rows = [(i, "x" * 40 + str(i) + "y" * 130) for i in range(30)] + [(None, "y" * 150)]
    before = {k: spark.conf.get(k) for k in
              ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = op.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # the last join's side with the texts is the exchange that the suffixes come from, or the reverse
    assert "ReusedExchange [__id" in plan


def test_members_of_lists():
    values = np.array([5, -3, 2 ** 62, 7, 5], np.int64)
    assert op.among(values, [7, 5, 11]).tolist() == [True, False, False, True, True]
    assert op.among(values, [-3, 2 ** 62, 2 ** 63 - 1]).tolist() == [False, True, True, False, False]
    assert not op.among(values, None).any() and not op.among(values, []).any()
    assert op.among(values[:0], [1]).tolist() == []
