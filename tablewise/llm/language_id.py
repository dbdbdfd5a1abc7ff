"""Language identification by Bayesian fusion of several kinds of evidence.

Text        Hashed byte trigrams of the visible text; one multinomial per language, trained here on
            labelled documents (all of them but a held-out quarter), as a grouped count.
Markup      The declared language (``lang`` of the html element, or the content-language
            header tag): P(declared | language).
Address     The last label of the host name: P(suffix | language).
Host        P(language | host), smoothed towards its site (last two labels), and that
            towards the corpus: a host with few pages leans on its site, a new site on all.

The tables of the last three are grouped counts over the whole input of what the text alone says;
each row's own count is taken out again before they are applied to it, so no row
confirms itself.  The first pass reads the texts and leaves one narrow row per input row; only those
are joined (a very frequent host is pre-aggregated, and its rows are split by the adaptive skew join).

Log scores: tempered text likelihood + log P(declared | l) + log P(suffix | l) + log P(l | host);
kinds of evidence a row does not have add nothing.  ``probability`` is the normalised score.

Defined results: null or empty text has no text evidence and is not counted; a row without any
evidence gets the corpus prior; without labelled documents the language is ``und`` with
probability 0; ties go to the language first in the alphabet; repeated rows give repeated results.
Whole texts and pages are read, in time linear in their length.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.llm.common import column, cut, load, register, small_batches

BINS = 1 << 12
MAX_LANGUAGES = 256           # bound of the model: the most frequent labels
TEMPER = 0.15                 # neighbouring trigrams are not independent
SMOOTH_TEXT = 0.5
SMOOTH_LABEL = 4.0            # pseudo-counts of declared and suffix tables
SMOOTH_SITE = 8.0             # of the corpus in a site, and of the site in a host
SMOOTH_HOST = 8.0

INVISIBLE = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|$)|<!--.*?(?:-->|$)|<[^>]*>?")
TAG = re.compile(r"(?i)<(?:html|meta)\b[^>]*")            # spans do not overlap: one pass over a page
HTML, META = re.compile(r"(?i)<html\b"), re.compile(r"(?i)<meta\b")
LANG = re.compile(r"(?i)\blang\s*=\s*(?:[\"']\s*)?([a-z]{2,3})(?![a-z])")
HEADER = re.compile(r"(?i)content-language")
CONTENT = re.compile(r"(?i)content\s*=\s*(?:[\"']\s*)?([a-z]{2,3})(?![a-z])")
HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def trigram_bins(text: str) -> np.ndarray:
    """Bins of the byte trigrams of the lower-cased text; marks and digits count as spaces, runs of
    spaces as one."""
    words = re.sub(r"[\W\d_]+", " ", text.lower())
    data = np.frombuffer(f" {words.strip()} ".encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)


def summed(weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Sum of the rows ``bins``; a long text goes by its counts per bin, so memory is bounded by the
    table whatever the text."""
    if len(bins) <= BINS:
        return weights[bins].sum(axis=0)
    return np.bincount(bins, minlength=BINS) @ weights


def visible_text(markup: str) -> str:
    return html.unescape(INVISIBLE.sub(" ", markup))


def declared_language(markup: str) -> str | None:
    """The first declaration in page order; linear in the page, also with tags never closed."""
    for span in TAG.finditer(markup):
        tag, found = span.group(), []
        if at := HTML.search(tag):
            found.append((at.start(), LANG.search(tag, at.end())))
        if at := META.search(tag):
            if header := HEADER.search(tag, at.end()):
                found.append((at.start(), CONTENT.search(tag, header.end())))
        for _, m in sorted(found, key=lambda x: x[0]):
            if m:
                return m.group(1).lower()
    return None


def host_of(url: str) -> str | None:
    m = HOST.match(url or "")
    return m.group(1).lower().strip(".") or None if m else None


def held_out(id_col: Column) -> Column:
    """A quarter of the labelled rows, by id, is left out of the training."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_text(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and log P(bin | language) as a matrix (languages x BINS)."""
    small_batches(documents.sparkSession)
    rows = documents.select(column(label_col).cast("string").alias("l"),
                            F.coalesce(column(text_col).cast("string"), F.lit("")).alias("t"),
                            held_out(column(id_col)).alias("out")).where("l is not null and not out")
    names = sorted(r.l for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l")
                   .limit(MAX_LANGUAGES).collect())
    if not names:
        return [], np.zeros((0, BINS))
    number = {l: i for i, l in enumerate(names)}

    def count(batches):
        for b in batches:
            table = np.zeros((len(names), BINS), np.int64)
            for l, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if l in number:
                    table[number[l]] += np.bincount(trigram_bins(t), minlength=BINS)
            l, at = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(l), pa.array(at), pa.array(table[l, at])],
                                             ["l", "bin", "n"])

    # at most languages x bins rows, whatever the corpus
    found = (rows.select("l", "t").mapInArrow(count, "l bigint, bin bigint, n bigint")
             .groupBy("l", "bin").agg(F.sum("n").alias("n")).collect())
    table = np.full((len(names), BINS), SMOOTH_TEXT)
    for r in found:
        table[r.l, r.bin] += r.n
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def evidence(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """``rows(kind, id, text, markup, url, host)`` -> narrow rows with the text's log likelihoods
    (null without text) and the other evidence as found."""
    small_batches(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))

    def run(batches):
        weights = sent.value
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for text, markup, url, host in zip(*(b.column(i).to_pylist() for i in range(2, 6))):
                if markup is not None:
                    text = visible_text(markup)
                bins = trigram_bins(text or "")
                host = host_of(url) if url is not None else host
                labels = host.split(".") if host else []
                likelihood = (summed(weights, bins) * TEMPER).tolist() if len(bins) else None
                named = len(labels) > 1 and not labels[-1].isdigit()
                for col, v in zip(cols, (
                        likelihood, declared_language(markup) if markup is not None else None,
                        labels[-1] if named else None,
                        ".".join(labels[-2:]) if named else host, host)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cols[0], pa.list_(pa.float64()))]
                + [pa.array(c, pa.string()) for c in cols[1:]],
                ["kind", "id", "likelihood", "declared", "suffix", "site", "host"])

    return rows.select("kind", "id", "text", "markup", "url", "host").mapInArrow(
        run, "kind string, id bigint, likelihood array<double>, declared string, suffix string, "
             "site string, host string")


def identify(rows: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """``kind, id, lang, probability, text_lang, declared, host`` of every row of ``rows(kind, id,
    text, markup, url, host)``: a page has ``markup`` and ``url``, plain text has ``text`` and
    possibly ``host``."""
    size = len(languages)
    narrow = cut(evidence(rows, table), "langid-evidence")
    if not size:
        return narrow.select("kind", "id", F.lit("und").alias("lang"),
                             F.lit(0.0).alias("probability"),
                             F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    best = F.array_position("likelihood", F.array_max("likelihood")).cast("int") - 1
    narrow = narrow.withColumn("guess", F.when(F.col("likelihood").isNotNull(), best))

    def counts(key: str) -> DataFrame:
        """Per value of a kind of evidence: how many rows of each language (by text)."""
        return (narrow.where(F.col(key).isNotNull() & F.col("guess").isNotNull()).groupBy(key)
                .agg(F.array(*[F.count(F.when(F.col("guess") == i, True)) for i in range(size)])
                     .alias(f"n_{key}")))

    def totals(key: str) -> np.ndarray:
        r = narrow.where(F.col(key).isNotNull() & F.col("guess").isNotNull()).agg(
            *[F.count(F.when(F.col("guess") == i, True)) for i in range(size)]).first()
        return np.array(list(r), float)

    everything, by_declared, by_suffix = totals("kind"), totals("declared"), totals("suffix")
    joined = narrow
    for key in ("declared", "suffix", "site", "host"):
        joined = joined.join(counts(key), key, "left")
    prior = (everything + 1.0) / (everything.sum() + size)

    def run(batches):
        for b in batches:
            c = b.to_pydict()
            lang, probability, text_lang = [], [], []
            for likelihood, guess, d, s, site, host in zip(
                    c["likelihood"], c["guess"], c["n_declared"], c["n_suffix"], c["n_site"],
                    c["n_host"]):
                own = np.zeros(size)
                if guess is not None:
                    own[guess] = 1.0
                score = np.zeros(size) if likelihood is None else np.array(likelihood)
                for n, total in ((d, by_declared), (s, by_suffix)):
                    if n is not None:
                        n = np.array(n) - own
                        share = (n.sum() + 1.0) / (total.sum() + 2.0)
                        score = score + np.log((n + SMOOTH_LABEL * share)
                                               / (total - own + SMOOTH_LABEL))
                p = prior
                for n, smooth in ((site, SMOOTH_SITE), (host, SMOOTH_HOST)):
                    if n is not None:
                        n = np.array(n) - own
                        p = (n + smooth * p) / (n.sum() + smooth)
                score = score + np.log(p)
                score = np.exp(score - score.max())
                at = int(score.argmax())
                lang.append(languages[at])
                probability.append(float(score[at] / score.sum()))
                text_lang.append(None if guess is None else languages[guess])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()),
                 pa.array(probability, pa.float64()), pa.array(text_lang, pa.string()),
                 b.column(2), b.column(3)], names)

    names = ["kind", "id", "lang", "probability", "text_lang", "declared", "host"]
    schema = T.StructType([T.StructField(n, T.LongType() if n == "id" else T.DoubleType()
                                         if n == "probability" else T.StringType())
                           for n in names])
    return joined.select("kind", "id", "declared", "host", "likelihood", "guess", "n_declared",
                         "n_suffix", "n_site", "n_host").mapInArrow(run, schema)


def document_rows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str | None = "source") -> DataFrame:
    none = F.lit(None).cast("string")
    host = F.lower(column(host_col).cast("string")) if host_col else none
    return documents.select(F.lit("document").alias("kind"), column(id_col).cast("bigint").alias("id"),
                            column(text_col).cast("string").alias("text"), none.alias("markup"),
                            none.alias("url"), host.alias("host"))


def page_rows(pages: DataFrame, id_col: str = "page_id", markup_col: str = "html",
              url_col: str = "url") -> DataFrame:
    none = F.lit(None).cast("string")
    return pages.select(F.lit("page").alias("kind"), column(id_col).cast("bigint").alias("id"),
                        none.alias("text"),
                        F.coalesce(column(markup_col).cast("string"), F.lit("")).alias("markup"),
                        column(url_col).cast("string").alias("url"), none.alias("host"))


@register("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (host: their source) and pages; ``doc_id`` or ``page_id`` is null."""
    docs = load(spark, sf_dir, "documents")
    languages, table = fit_text(docs)
    rows = document_rows(docs).unionByName(page_rows(load(spark, sf_dir, "pages")))
    found = identify(rows, languages, table)
    return found.select(
        F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"),
        F.when(F.col("kind") == "page", F.col("id")).alias("page_id"),
        "lang", "probability", "text_lang", "declared", "host")


__all__ = ["fit_text", "identify", "evidence", "document_rows", "page_rows", "trigram_bins",
           "visible_text", "declared_language", "host_of", "held_out"]
