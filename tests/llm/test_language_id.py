import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewise.llm import language_id as op
from tests.llm.data import edge_docs, empty_docs


@pytest.fixture(scope="module")
def model(spark, sf01):
    return op.fit_text(spark.read.parquet(f"{sf01}/documents.parquet"))


def test_held_out_accuracy(spark, sf01, model):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    got = op.identify(op.document_rows(docs), *model)
    both = got.join(docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("truth")), "id")
    assert got.count() == docs.count()
    share = both.where(op.held_out(F.col("id"))).agg(F.avg((F.col("lang") == F.col("truth"))
                                                          .cast("int"))).first()[0]
    assert share >= 0.97


def test_text_model_is_the_smoothed_count(spark):
    df = spark.createDataFrame([(1, "abcabc", "x"), (3, "zzz abc", "y"), (4, None, "y"),
                                (5, "abc", None)], "doc_id long, text string, lang string")
    names, table = op.fit_text(df)
    kept = [r.doc_id for r in df.where(~op.held_out(F.col("doc_id"))).collect()]
    assert names == sorted({r.lang for r in df.collect() if r.doc_id in kept and r.lang})
    for name, row in zip(names, table):
        counts = np.full(op.BINS, op.SMOOTH_TEXT)
        for r in df.collect():
            if r.doc_id in kept and r.lang == name:
                counts += np.bincount(op.trigram_bins(r.text or ""), minlength=op.BINS)
        assert np.allclose(row, np.log(counts / counts.sum()))


def test_other_evidence_decides_without_text(spark, model):
    en = "the and of this that with for the are was with that the"
    de = "der die das und nicht eine mit von zu ist den auf sich der die"
    page = '<html lang="{}"><body><script>var der = "die das und";</script><p>{}</p></body></html>'
    rows = [(i, f"https://a{i % 3}.site.de/x", page.format("de", de)) for i in range(12)]
    rows += [(20 + i, f"http://b{i % 3}.other.com/y", page.format("en", en)) for i in range(12)]
    rows += [(50, "https://a1.site.de/empty", page.format("de", "")),        # all but the text
             (51, "https://a1.site.de/e", "<p></p>"),                          # host only
             (52, "https://b1.other.com/e", "<html lang='en'></html>"),
             (53, None, None), (54, "no address", ""), (None, None, page.format("de", de))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.id: r for r in op.identify(op.page_rows(pages), *model).collect()}
    assert [got[i].lang for i in (50, 51, 52)] == ["de", "de", "en"]
    assert got[50].text_lang is None and got[50].declared == "de" and got[50].host == "a1.site.de"
    assert all(got[i].lang == ("de" if i < 20 else "en") for i in list(range(12)) + [20, 31])
    assert got[53].lang == got[54].lang and got[None].lang == "de"


def test_parsing():
    assert op.declared_language('<HTML dir=ltr LANG="fr-CA">') == "fr"
    assert op.declared_language('<meta http-equiv="Content-Language" content="es">') == "es"
    assert op.declared_language("<html><p lang=en>") is None
    assert op.host_of("https://user@Www.Example.ORG:80/a?b") == "www.example.org"
    assert op.host_of("mailto:x") is None and op.host_of(None) is None
    assert op.visible_text("a<!-- x --><style>y</style><b>&amp;c</b>").split() == ["a", "&c"]
    assert len(op.trigram_bins("")) == 0 and len(op.trigram_bins("ab")) == 2


def test_edge_and_empty(spark, model):
    got = op.identify(op.document_rows(edge_docs(spark)), *model).collect()
    assert len(got) == edge_docs(spark).count()
    assert all(r.lang in model[0] and 0 < r.probability <= 1 for r in got)
    assert op.identify(op.document_rows(empty_docs(spark)), *model).count() == 0
    names, table = op.fit_text(empty_docs(spark))
    none = op.identify(op.document_rows(edge_docs(spark)), names, table).collect()
    assert {(r.lang, r.probability) for r in none} == {("und", 0.0)}


def test_long_texts_and_pages():
    """Counts per bin give the same sums; tags never closed cost one pass."""
    import time
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(op.BINS, 3))
    bins = op.trigram_bins("the quick brown fox " * 250_000)            # 5 MB
    counts = np.bincount(bins, minlength=op.BINS)
    assert np.allclose(op.summed(weights, bins), (counts[:, None] * weights).sum(axis=0))
    few = bins[:100]
    assert np.allclose(op.summed(weights, few), weights[few].sum(axis=0))
    start = time.time()
    for page in ("<html " * 800_000, "<meta content-language " * 200_000,
                 "<html lang=" + " " * 5_000_000 + "1", "<html <meta content-language " * 150_000):
        assert op.declared_language(page) is None
    assert time.time() - start < 20


def test_declared_language_in_page_order():
    found = op.declared_language
    assert found('<html data-a="x" LANG = " EN-us">') == "en"
    assert found('<meta name=a content="fr"><html lang=de>') == "de"
    assert found('<META http-equiv="content-language" x content="it">') == "it"
    assert found('<html <meta http-equiv=content-language content=es lang=pt>') == "pt"
    assert found('<meta http-equiv=content-language content=es><html lang=pt>') == "es"
    assert found('<html lang="abcd"> lang="fr"') is None and found("") is None
