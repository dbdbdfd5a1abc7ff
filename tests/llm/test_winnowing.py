import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from tablewise.llm import winnowing as op
from tests.llm.data import edge_docs, edge_rows, empty_docs, prose


def brute(text, k=op.GRAM, w=op.WINDOW):
    data = (text or "").encode()
    if not data:
        return []
    h = [xxhash.xxh64_intdigest(data[i:i + k], 42) & 0x7FFFFFFF
         for i in range(max(1, len(data) - k + 1))]
    if len(h) < w:
        return list(zip(h, range(len(h))))
    out = []
    for s in range(len(h) - w + 1):
        low = min(h[s:s + w])
        at = s + max(i for i, x in enumerate(h[s:s + w]) if x == low)
        if not out or out[-1] != (low, at):
            out.append((low, at))
    return out


def pairs(df):
    rows = (df.select("text", op.fingerprint(F.col("text")).alias("p"))
            .select("text", "p", op.positions(F.col("p")).alias("q")).collect())
    return [(r.text, [(p >> 32, q) for p, q in zip(r.p, r.q)]) for r in rows]


def test_pairs_equal_brute_force(spark, sf001, monkeypatch):
    texts = [(t,) for _, t, *_ in edge_rows() if t is not None]
    df = spark.createDataFrame(texts, "text string").unionByName(
        spark.read.parquet(f"{sf001}/documents.parquet").select("text").limit(60))
    for text, got in pairs(df):
        assert got == brute(text)
    monkeypatch.setattr(op, "CHUNK", 64)
    for text, got in pairs(df.where("length(text) < 5000")):
        assert got == brute(text)


def test_shared_run_shares_a_fingerprint(spark):
    run = prose(9, 30)[:op.GRAM + op.WINDOW - 1]
    run = run.encode()[:op.GRAM + op.WINDOW + 10].decode("utf-8", "ignore")
    df = spark.createDataFrame([(prose(1, 50) + run + prose(2, 60),), (prose(3, 20) + run,)],
                               "text string")
    a, b = (set(h for h, _ in p) for _, p in pairs(df))
    assert a & b


def expected(rows):
    rows = sorted(((-2 ** 63 if i is None else i, t or "") for i, t in rows))
    out = []
    for j, (i, t) in enumerate(rows):
        nxt = rows[(j + 1) % len(rows)][1]
        m = len(t) // 4
        edited = t[:len(t) - m] + nxt[:m]
        h, e, n = ({x for x, _ in brute(s)} for s in (t, edited, nxt))
        near = [len(h & o) / len(h | o) if h | o else 1.0 for o in (e, n)]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return sorted(out)


def compared(df):
    return sorted((-2 ** 63 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256,
                   r.near_edited, r.near_next) for r in op.edited_comparison(df).collect())


def test_edited_comparison(spark, sf001, monkeypatch):
    want = expected([(i, t) for i, t, *_ in edge_rows()])
    assert compared(edge_docs(spark)) == want
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    sample = docs.where("length(text) < 3000")
    want = expected([(r.doc_id, r.text) for r in sample.collect()])
    for rows in (7, 40, 2_000):                     # several id ranges, and one
        monkeypatch.setattr(op, "RANGE_ROWS", rows)
        assert compared(sample.repartition(5)) == want


def test_edited_fingerprint_is_that_of_the_edited_text(spark):
    texts = [(i, prose(i, 30 + 11 * i)) for i in range(40)] + [(50, prose(0, 30)), (51, "é" * 900)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in op.edited_comparison(df).collect()}
    edited = []
    for j, (i, t) in enumerate(texts):
        m = len(t) // 4
        edited.append((i, t[:len(t) - m] + texts[(j + 1) % len(texts)][1][:m]))
    direct = {r.doc_id: r.d for r in spark.createDataFrame(edited, "doc_id long, text string")
              .select("doc_id", op.fingerprint(F.col("text")).alias("p"))
              .select("doc_id", op.digest("p").alias("d")).collect()}
    assert {i: r.edited_fingerprint for i, r in got.items()} == direct
    assert got[0].fingerprint == got[50].fingerprint != got[1].fingerprint


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    assert compared(one) == expected([(5, "abcdefgh")])
    assert compared(empty_docs(spark)) == []


def test_no_python_in_the_plan(spark, sf001):
    plan = op.op5_winnowing(spark, sf001)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
