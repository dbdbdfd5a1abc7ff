"""Every stage against a plain recomputation on its own input, and the whole run."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipe
from tablewise.llm import toxicity
from tests.llm.data import SCHEMA, edge_docs
from tests.llm.test_decontaminate import brute as contained
from tests.llm.test_minhash_dedup import brute as groups
from tests.llm.test_suffix_dedup import brute as repeats


@pytest.fixture(scope="module")
def stages(spark, sf01):
    """Input and output of every stage, each written and read again."""
    from tablewise.llm.common import cut
    docs, out = spark.read.parquet(f"{sf01}/documents.parquet"), []
    for name, stage in pipe.STAGES:
        done = cut(stage(spark, docs, sf01), f"test-{name}")
        out.append((name, docs, done))
        docs = done
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_order_and_columns(stages, spark, sf01):
    assert [s[0] for s in stages] == ["toxicity", "minhash_dedup", "suffix_dedup",
                                     "decontamination", "byte_bpe"]
    schema = spark.read.parquet(f"{sf01}/documents.parquet").dtypes
    assert all(done.dtypes == schema for _, _, done in stages[:-1])


def test_toxicity(stages, spark, sf01):
    _, docs, done = stages[0]
    model = toxicity.fit(docs, spark.read.parquet(f"{sf01}/labels.parquet"))
    low = {r.doc_id for r in toxicity.score(docs, model)
           .where(F.col("score") < toxicity.THRESHOLD).collect()}
    assert rows(done) == {i: t for i, t in rows(docs).items() if i in low}


def test_near_copies(stages):
    _, docs, done = stages[1]
    kept = {int(i) for i, _, _, k in groups(list(rows(docs).items()), 80) if k}
    assert rows(done) == {i: t for i, t in rows(docs).items() if i in kept}


def test_repeated_passages(stages):
    _, docs, done = stages[2]
    want = {i: (n, sha) for i, _, n, _, sha in repeats(list(rows(docs).items()))}
    got, before = rows(done), rows(docs)
    assert set(got) == set(before)
    for r in done.collect():
        removed, sha = want[r.doc_id]
        assert len(before[r.doc_id].encode()) - len(r.text.encode()) >= removed
        if not removed:
            assert r.text == before[r.doc_id]
        elif r.text.isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() == sha
        assert removed == 0 or r.n_chars == len(r.text)


def test_decontamination(stages, spark, sf01):
    _, docs, done = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{sf01}/benchmark.parquet").collect()]
    bad = {d for d, _ in contained(list(rows(docs).items()), items)}
    assert rows(done) == {i: t for i, t in rows(docs).items() if i not in bad}


def test_tokens(stages):
    _, docs, done = stages[4]
    texts = rows(docs)
    got = done.collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
        assert len(r.token_ids) == r.n_tokens


def test_run(stages, spark, sf01):
    def ids(df):
        return sorted((r.doc_id, r.ids_sha256) for r in df.collect())
    assert ids(pipe.run(spark, sf01)) == ids(stages[-1][2])


def test_edge_rows(spark, sf001):
    """Nulls, repeated rows and clashing columns pass all stages; clean rows stay."""
    docs = edge_docs(spark)
    for name, stage in pipe.STAGES[:-1]:
        out = stage(spark, docs, sf001)
        assert out.columns == docs.columns, name
        docs = out
    left = docs.collect()
    assert {None, 1, 2, 3, 4, 5, 10, 12, 13} <= {r.doc_id for r in left}
    assert [r.doc_id for r in left].count(20) == 1
    assert pipe.tokenize(spark, docs, sf001).count() == len(left)


def test_empty_documents(spark, sf001):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipe.STAGES:
        docs_out = stage(spark, docs, sf001)
        assert docs_out.count() == 0
