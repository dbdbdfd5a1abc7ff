import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewise.llm import toxicity as op
from tests.llm.data import edge_docs, empty_docs


def random_index(n, terms, seed=3):
    rng = np.random.default_rng(seed)
    vectors = []
    for _ in range(n):
        t = np.sort(rng.choice(terms, rng.integers(1, 7), replace=False))
        w = rng.integers(1, 4, len(t)).astype(float)          # many equal cosines
        vectors.append((t, w / math.sqrt(w @ w)))
    labels = rng.integers(0, 2, n).tolist()
    return vectors, labels, op.BlockMaxIndex(vectors, labels, list(range(n)))


def test_block_max_search_is_exact():
    vectors, labels, index = random_index(1500, 40)
    for q in vectors[::50]:
        dense = np.zeros(40)
        dense[q[0]] = q[1]
        sims = np.round([float(dense[t] @ w) for t, w in vectors], 9)
        for skip in (None, 7):
            kept = [(s, i) for i, s in enumerate(sims) if s > 0 and i != skip]
            kth = sorted((s for s, _ in kept), reverse=True)[:15][-1]
            want = {i: s for s, i in kept if s >= kth - 1e-9}
            at, got = index.nearest(*q, 15, skip)
            found = dict(zip(index.ids[at].tolist(), got.tolist()))
            assert set(found) == set(want)
            assert all(abs(found[i] - want[i]) < 1e-8 for i in want)


def test_blocks_are_skipped_and_the_search_stays_exact():
    """Examples of 5 vocabularies: most blocks cannot hold a neighbour and are not visited."""
    rng = np.random.default_rng(11)
    vectors = []
    for i in range(3000):
        t = np.unique(np.concatenate([40 * (i % 5) + rng.integers(0, 40, 12), 200 + rng.integers(0, 9000, 3)]))
        w = rng.uniform(0.5, 2.0, len(t))
        vectors.append((t, w / math.sqrt(w @ w)))
    order = rng.permutation(3000)
    index = op.BlockMaxIndex([vectors[i] for i in order], [0] * 3000, order.tolist())
    queries = [vectors[i] for i in range(0, 3000, 60)]
    found = index.nearest_of(queries, 15, [None] * len(queries))
    assert 0 < index.visited < 0.4 * index.offered
    for (t, w), (at, got) in zip(queries, found):
        dense = np.zeros(10_200)
        dense[t] = w
        sims = np.round([float(dense[u] @ v) for u, v in vectors], 9)
        kth = np.sort(sims)[-15]
        assert set(index.ids[at].tolist()) == set(np.flatnonzero(sims >= kth - 1e-9).tolist())
        assert np.allclose(got, sims[index.ids[at]], atol=2e-9)


def test_monotone_curve():
    assert op.monotone([0.1, 0.5, 0.3, 0.9], [1, 1, 1, 1]) == [0.1, 0.4, 0.4, 0.9]


def test_vector_is_tf_idf():
    terms, w = op.vector("Bad bad word badly", {"bad": 0, "badl*": 1, "none": 2},
                         np.array([2.0, 3.0, 1.0]))
    raw = np.array([(1 + math.log(2)) * 2, 3.0])
    assert terms.tolist() == [0, 1] and np.allclose(w, raw / np.sqrt(raw @ raw))


def test_held_out_quality_and_documents_counts(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    labels = spark.read.parquet(f"{sf01}/labels.parquet")
    rows = op.op6_toxicity(spark, sf01).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    test = [r for r in rows if r.held_out and r.doc_id in truth]
    pos = [r.score for r in test if truth[r.doc_id]]
    neg = [r.score for r in test if not truth[r.doc_id]]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc >= 0.8


def test_idf_counts_all_documents(spark):
    docs = [(i, "vile word here" if i % 5 == 0 else "plain text here") for i in range(400)]
    docs += [(1000 + i, "vile") for i in range(40)] + [(2000, None), (2001, "")]
    labels = [(i, int(i % 5 == 0)) for i in range(400)] + [(0, 1), (None, 1), (5, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    model = op.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    n, df = len(docs), 120
    assert math.isclose(model.idf[model.vocabulary["vile"]], math.log((1 + n) / (1 + df)) + 1e-6)
    got = {r.doc_id: r for r in op.score(d, model).collect()}
    assert got[1000].score > 0.5 > got[1].score and got[2000].score == got[2001].score == got[1].score
    assert got[1000].nearest_cosine > 0 and got[1000].nearest_id % 5 == 0
    marked = op.with_score(d, model).where("doc_id = 1000").first()
    assert marked.toxicity == got[1000].score


def test_scores_do_not_use_ids_or_other_columns(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    model = op.fit(docs, spark.read.parquet(f"{sf001}/labels.parquet"))
    moved = docs.select((F.col("doc_id") + 5000).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    a = {r.doc_id: r.score for r in op.score(docs, model).collect()}
    b = {r.doc_id - 5000: r.score for r in op.score(moved, model).collect()}
    assert a == b


def test_edge_and_empty(spark):
    labels = spark.createDataFrame([(0, 1), (9, 0)], "doc_id long, toxic int")
    none = labels.limit(0)
    for lab in (labels, none):
        model = op.fit(edge_docs(spark), lab)
        got = op.score(edge_docs(spark), model).collect()
        assert len(got) == edge_docs(spark).count() and all(0 <= r.score <= 1 for r in got)
    assert op.score(empty_docs(spark), op.fit(empty_docs(spark), labels)).count() == 0


def test_search_is_exact_with_rare_terms():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(1200):
        t = np.unique(rng.zipf(1.3, 30) % 5000)
        w = rng.integers(1, 4, len(t)).astype(float)
        vectors.append((t, w / math.sqrt(w @ w)))
    index = op.BlockMaxIndex(vectors, [0] * 1200, list(range(1200)))
    assert 0 < len(index.inverted()[5]) < 5000
    for i in range(0, 1200, 40):
        dense = np.zeros(5000)
        dense[vectors[i][0]] = vectors[i][1]
        sims = np.round([float(dense[t] @ w) for t, w in vectors], 9)
        sims[i] = 0
        kth = np.sort(sims)[-15]
        at, got = index.nearest(*vectors[i], 15, i)
        assert set(index.ids[at].tolist()) == set(np.flatnonzero(sims >= kth - 1e-9).tolist())
        assert np.allclose(got, sims[index.ids[at]], atol=2e-9)


@pytest.mark.parametrize("every", [3, 2])
def test_any_share_of_toxic_labels(spark, every):
    docs = [(i, "vile word here" if i % every == 0 else "plain text here") for i in range(60)]
    docs += [(100 + i, "vile") for i in range(40)] + [(200, None), (201, "")]
    labels = [(i, int(i % every == 0)) for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    model = op.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in op.score(d, model).collect()}
    assert all(got[i].score > 0.5 for i in range(0, 60, every)) and got[100].score > 0.5
    assert all(got[i].score < op.THRESHOLD for i in range(60) if i % every)
    assert got[200].score == got[201].score == got[1].score
    assert got[100].nearest_cosine > 0 and got[100].nearest_id % every == 0


def test_toxic_documents_of_a_rare_language(spark):
    """Two toxic examples of a small language share no word with the other toxic ones; a third
    text near them and an exact copy of one are found, plain texts of that language are not."""
    rng = np.random.default_rng(8)
    train = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2]

    def text(language, words, extra=""):
        return " ".join(f"{language}{w}" for w in rng.integers(0, 300, words)) + " " + extra

    docs, labels = [], []
    for at, i in enumerate(train[:300]):
        toxic = at % 10 == 0
        docs.append((i, text("en", 30, "idiot loser" if toxic else "")))
        labels.append((i, int(toxic)))
    for i in train[300:320]:
        docs.append((i, text("de", 30)))
        labels.append((i, 0))
    copied = text("de", 20, "dummkopf versager")
    for i, t in zip(train[320:322], (copied, text("de", 20, "dummkopf versager"))):
        docs.append((i, t))
        labels.append((i, 1))
    docs += [(5000, text("de", 20, "dummkopf versager")), (5001, copied), (5002, text("de", 20)),
             (5003, text("en", 30, "idiot loser")), (5004, text("en", 30))]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    model = op.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in op.score(d, model).collect()}
    assert len(model.index.ids) == len(labels)
    assert got[5001].nearest_id == train[320] and got[5001].nearest_cosine == 1
    assert [int(got[i].score >= op.THRESHOLD) for i in range(5000, 5005)] == [1, 1, 0, 1, 0]


def test_a_word_is_looked_up_once_for_many_texts(spark):
    """The votes of 100 texts of the same words read the vocabulary as often as it has words (and
    its stems once), not for every text again; they are the votes of each text alone."""
    docs = [(i, "vile nasty words here" if i % 3 == 0 else "plain longer words there") for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = op.fit(d, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)],
                                            "doc_id long, toxic int"))
    texts = [" ".join(["vile", "plain", "wordy", "unknown"][:1 + i % 4] + ["there"] * (i % 3))
             for i in range(100)]
    alone = [model.votes([t])[0] for t in texts]

    class Counting(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    model.vocabulary = Counting(model.vocabulary)
    assert model.votes(texts) == alone
    assert 0 < model.vocabulary.asked < 60


def test_vectors_of_texts_are_those_of_their_term_counts(monkeypatch):
    texts = ["", "Bad bad WORDS, words; wordy", "\x00 a\x1cb", "日本語テキスト ÀBCDÉ àbcdéf", "İstanbul ΣΑΣ",
             "no\u00a0break\u3000space\x85x", "words " * 300, " .,", "wordless unseen"]
    terms = sorted(set().union(*map(op.term_counts, texts[:-1])))
    vocabulary = {t: i for i, t in enumerate(terms)}
    idf = np.linspace(1.0, 2.0, len(terms))
    for chars in (1, 40, 1 << 20):
        monkeypatch.setattr(op, "GROUP_CHARS", chars)
        got = op.vectors(texts, vocabulary, idf, op.stems_of(vocabulary))
        assert len(got) == len(texts)
        for text, (at, w) in zip(texts, got):
            want = {vocabulary[t]: (1 + math.log(n)) * idf[vocabulary[t]]
                    for t, n in op.term_counts(text).items() if t in vocabulary}
            norm = math.sqrt(sum(x * x for x in want.values()))
            assert at.tolist() == sorted(want)
            assert np.allclose(w, [want[t] / norm for t in at.tolist()])
    assert {"word*", "日本語テ*", "no\u00a0b*"} <= set(terms) and len(got[-1][0]) == 1
