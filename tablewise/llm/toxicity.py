"""Toxicity by the nearest labelled examples, found exactly with a block-max inverted index.

Fit
    Terms are lower-cased words and their four-character stems (``loser``, ``lose*``).  All terms
    of a bounded sample of labelled rows (``max_examples``, the documented bound) are kept.  Their
    document counts, and so the idf, come from *all* documents.  A term tied to the toxic label
    weighs more (``label_tie``, 1 and up: no term is left out by it, at any share of toxic rows).
    The examples' TF-IDF vectors (sublinear tf, unit length) make the index: postings of each
    term, and a dense matrix for the terms found in many examples.

Score
    A document's cosine with an example is the dot product of their unit vectors.  Examples with
    the same common terms stand together in blocks of ``BLOCK``.  The postings of a document's rare
    terms are added in full; with the largest weights of the common terms in a block they bound
    the block's cosines.  The blocks with the largest bounds are visited, then those of the
    others whose bound reaches the k-th cosine found, and no more.  What comes near the k-th is
    computed again in double precision: the neighbours are exact.  Every example as near as the k-th
    counts, so ties do not depend on order.  The vote
    is the share of toxic neighbours weighted by the fourth power of the cosine (a copy outweighs
    what only shares common words); a monotone curve fitted on the examples' leave-one-out
    votes turns it into a probability.  The nearest example's id and cosine are returned as
    evidence.

Defined results: a null or empty text, and any text without a term of the examples, has no
toxic neighbour and gets the score of vote 0; with no labelled rows or no toxic ones, every score
is the (smoothed) share of toxic rows.  Labels with null id or label are not
used; an id with several labels is toxic if one of them is.  Repeated rows score alike.  Texts
are read whole, whatever their length, in time that grows with it.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.common import (ID, TEXT, column, cut, keyed, load, register, small_batches)

MAX_EXAMPLES = 6_000         # bound of the labelled sample (rows)
TIE_DOCS = 3.0               # a tie seen in so many toxic examples counts half
NEIGHBOURS = 15
NEARNESS = 4                 # power of the cosine in the vote
BLOCK = 64
FIRST_BLOCKS = 4             # blocks that are visited before the others are judged
DENSE = 32                   # terms in more than 1 / DENSE of the examples go to the matrix
MAX_DENSE = 1024             # and so many at most
ORDER_TERMS = 384            # terms that decide which examples stand together
SLACK = 2e-4                 # more than single precision can be off
BATCH = 128                  # texts multiplied with the matrix at once
GROUP_CHARS = 1 << 20        # characters of texts whose words are counted at once
GROUP_ROWS = 1 << 12         # and so many texts at most
BINS = 20
THRESHOLD = 0.3
PRIOR_WEIGHT = 2.0           # pseudo-examples of the base rate in every calibration bin
STEM = 4
# a word is a run of 0-9, a-z and characters beyond ASCII, whose bytes in UTF-8 are 128 and up
BREAKS = bytes(c if c > 127 or chr(c).isdigit() or chr(c).islower() else 32 for c in range(256))


def plain(text: str) -> bytes:
    """The text lower-cased, with a space for every character that is in no word."""
    return text.lower().encode().translate(BREAKS)


def term_counts(text: str) -> Counter:
    """Term -> number of occurrences: words, and stems of longer words (``abcd*``)."""
    words = Counter(plain(text).decode().split(" "))
    words.pop("", None)
    out = Counter(words)
    for w, n in words.items():
        if len(w) > STEM:
            out[w[:STEM] + "*"] += n
    return out


def stems_of(vocabulary: dict[str, int]) -> np.ndarray:
    """Number of the stem of each term, by the term's number; -1 for short words, and -1 once more
    at the end."""
    out = np.full(len(vocabulary) + 1, -1, np.int32)
    out[np.fromiter(vocabulary.values(), np.int64, len(vocabulary))] = np.fromiter(
        (vocabulary.get(w[:STEM] + "*", -1) if len(w) > STEM else -1 for w in vocabulary),
        np.int32, len(vocabulary))
    return out


def groups(texts):
    """Runs of texts of about ``GROUP_CHARS`` characters, so that long texts go one by one."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= GROUP_CHARS or len(held) == GROUP_ROWS:
            yield held
            held, size = [], 0
    if held:
        yield held


def counted(texts: list[str], vocabulary: dict[str, int], stems: np.ndarray):
    """``(term numbers, occurrences, ends)`` of the kept terms, by text and number; the terms of
    text ``i`` end at ``ends[i]``.  A word is looked up once for all texts."""
    parts = pc.split_pattern(pa.array([plain(t) for t in texts], pa.large_string()), " ")
    found = parts.values.dictionary_encode()
    words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
    own = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
    stem = stems[own]
    # a word that is not kept may have a stem that is
    for i in np.flatnonzero(own < 0).tolist():
        if len(words[i]) > STEM:
            stem[i] = vocabulary.get(words[i][:STEM] + "*", -1)
    row = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    both = np.sort(row * len(words) + found.indices.to_numpy())
    first = np.flatnonzero(np.diff(both, prepend=-1))
    counts = np.diff(first, append=len(both))
    row, place = np.divmod(both[first], len(words))
    row = np.concatenate([row, row]) * len(stems)
    terms = np.concatenate([own[place], stem[place]])
    # text, term and count in one number, as plain sorting is fast
    bits = int(counts.max()).bit_length()
    both = np.sort((row + terms << bits | np.concatenate([counts, counts]))[terms >= 0])
    keys, counts = both >> bits, both & (1 << bits) - 1
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    row, terms = np.divmod(keys[first], len(stems))
    counts = np.add.reduceat(counts, first) if len(first) else counts
    return terms, counts, np.searchsorted(row, np.arange(len(texts)), "right")


def unit(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF weights."""
    w = (1.0 + np.log(counts)) * idf[terms]
    return w / math.sqrt(float(w @ w)) if len(w) else w


def vectors(texts: list[str], vocabulary: dict[str, int], idf: np.ndarray, stems: np.ndarray):
    """Unit TF-IDF vector of every text over the kept terms: ``(term numbers, weights)``."""
    out = []
    for group in groups(texts):
        terms, counts, ends = counted(group, vocabulary, stems)
        start = 0
        for end in ends.tolist():
            out.append((terms[start:end], unit(terms[start:end], counts[start:end], idf)))
            start = end
    return out


def vector(text: str, vocabulary: dict[str, int], idf: np.ndarray):
    """``vectors`` of one text."""
    return vectors([text], vocabulary, idf, stems_of(vocabulary))[0]


def packed(numbers: np.ndarray) -> bytes:
    """Compressed whole numbers (32 bits), byte by byte."""
    planes = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


def packed_words(words: list[str]) -> tuple[bytes, int]:
    data = "\n".join(words).encode()
    return pa.Codec("zstd").compress(data, asbytes=True), len(data)


@functools.lru_cache(maxsize=1)
def numbered_words(data: bytes, size: int) -> tuple[dict[str, int], np.ndarray]:
    """The vocabulary and the stems of its terms, once in a process."""
    words = pa.Codec("zstd").decompress(data, size, asbytes=True).decode().split("\n")
    vocabulary = {w: i for i, w in enumerate(words)}
    return vocabulary, stems_of(vocabulary)


def label_tie(n: np.ndarray, n_toxic: np.ndarray, share: float) -> np.ndarray:
    """Factor of each term's weight, 1 and up: grows with the square of the smoothed log odds of
    the toxic label, as far as toxic examples bear them out."""
    p = (n_toxic + 2.0 * share) / (n + 2.0)
    share, p = (np.clip(x, 1e-9, 1.0 - 1e-9) for x in (share, p))
    odds = np.maximum(np.log(p / (1.0 - p)) - np.log(share / (1.0 - share)), 0.0)
    return 1.0 + (odds * n_toxic / (n_toxic + TIE_DOCS)) ** 2


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    out = np.repeat(starts - ends + lengths, lengths)
    out += np.arange(len(out))
    return out


def common_terms(found: np.ndarray, n: int, most: int) -> np.ndarray:
    """The most frequent terms, if more than 1 / ``DENSE`` of the ``n`` examples have them."""
    common = np.argsort(-found, kind="stable")[:most]
    return common[found[common] * DENSE > n]


def near_order(vectors) -> np.ndarray:
    """An order that puts examples with the same common terms together, so that blocks differ
    and their largest weights say something: by the nearest of every ``BLOCK``-th example."""
    n = len(vectors)
    terms = np.concatenate([np.empty(0, np.int64)] + [np.asarray(t, np.int64) for t, _ in vectors])
    found = np.bincount(terms)
    common = common_terms(found, n, ORDER_TERMS)
    column = np.full(len(found), -1, np.int64)
    column[common] = np.arange(len(common))
    matrix = np.zeros((n, len(common)), np.float32)
    for row, (t, w) in zip(matrix, vectors):
        c = column[t]
        row[c[c >= 0]] = w[c >= 0]
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    pivots = matrix[::BLOCK]
    group = np.concatenate([np.empty(0, np.int64)] + [
        np.argmax(matrix[i:i + 1024] @ pivots.T, axis=1) for i in range(0, n, 1024)])
    # groups of one kind (language, wording) stand together too
    kind = np.argsort(np.argmax(pivots @ pivots[::max(1, len(pivots) // 8)].T, axis=1), kind="stable") \
        if len(pivots) else np.empty(0, np.int64)
    rank = np.empty(len(pivots), np.int64)
    rank[kind] = np.arange(len(pivots))
    return np.argsort(rank[group], kind="stable") if n else np.empty(0, np.int64)


class BlockMaxIndex:
    """Unit vectors of examples in blocks of similar ones: postings by term, and for the common
    terms a matrix per block with its largest weights."""

    def __init__(self, vectors, labels, ids):
        sizes = np.array([len(v[0]) for v in vectors], np.int64)
        order = np.lexsort((sizes, np.array(ids, np.int64)))
        order = order[near_order([vectors[i] for i in order])]
        self.labels = np.array(labels, float)[order]
        self.ids = np.array(ids, np.int64)[order]
        self.by_id = np.argsort(self.ids, kind="stable")
        self.start = np.concatenate([[0], np.cumsum(sizes[order])])
        self.terms = np.concatenate([np.empty(0, np.int32)] + [
            np.asarray(vectors[i][0], np.int32) for i in order])
        self.weights = np.concatenate([np.empty(0)] + [vectors[i][1] for i in order])
        self.size = int(self.terms.max()) + 1 if len(self.terms) else 0
        self.lists = None
        self.visited = self.offered = 0     # blocks whose cosines were computed, and all

    def inverted(self):
        """``first, examples, weights, column, blocks, tops``: postings of a rare term ``t`` are
        ``first[t]:first[t + 1]``; a common term has none, but a row in the matrix of every block,
        ``blocks[b][column[t]]``, and its largest weight in every block, ``tops[column[t]]``."""
        if self.lists is None:
            n = len(self.ids)
            found = np.bincount(self.terms, minlength=self.size)
            common = common_terms(found, n, MAX_DENSE)
            column = np.full(self.size, -1, np.int32)
            column[common] = np.arange(len(common))
            blocks = np.zeros((-(-n // BLOCK), len(common), BLOCK), np.float32)
            for i, (a, b) in enumerate(zip(self.start[:-1].tolist(), self.start[1:].tolist())):
                row = column[self.terms[a:b]]
                blocks[i // BLOCK, row[row >= 0], i % BLOCK] = self.weights[a:b][row >= 0]
            at = np.flatnonzero(column[self.terms] < 0).astype(np.int32)
            at = at[np.argsort(self.terms[at], kind="stable")]
            examples = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.start))
            found[common] = 0
            self.lists = (np.concatenate([[0], np.cumsum(found)]), examples[at],
                          self.weights[at].astype(np.float32), column, blocks,
                          np.ascontiguousarray(blocks.max(axis=2).T))
        return self.lists

    def nearest_of(self, queries, k: int, skips):
        """``(examples, cosines)`` per query, see ``nearest``.

        The postings of a query's rare terms are added in full; with the block's largest weights
        of the common terms they bound the cosines of a block.  The blocks with the largest
        bounds are visited first; of the others only those whose bound reaches the k-th cosine found
        so far."""
        first, examples, weights, column, blocks, tops = self.inverted()
        n_blocks = len(blocks)
        queries = [(t[t < self.size], w[t < self.size]) for t, w in queries]
        dense = np.zeros((len(queries), len(tops)), np.float32)
        sims = np.zeros((len(queries), n_blocks * BLOCK), np.float32)
        for row, line, (t, w) in zip(dense, sims, queries):
            c = column[t]
            row[c[c >= 0]] = w[c >= 0]
            start = first[t[c < 0]]
            lengths = first[t[c < 0] + 1] - start
            at = ranges(start, lengths)
            if len(at):
                near = weights.take(at)
                near *= np.repeat(w[c < 0].astype(np.float32), lengths)
                line += np.bincount(examples.take(at), near, len(line))
        cosines = sims.reshape(len(queries), n_blocks, BLOCK)
        bound = dense @ tops + cosines.max(axis=2)
        for line, skip in zip(sims, skips):
            if skip is not None:
                line[self.at_id(skip)] = -4.0
        seen = np.zeros(bound.shape, bool)

        def visit(wanted):
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                rows = np.flatnonzero(wanted[:, b])
                cosines[rows, b] += dense[rows] @ blocks[b]
            seen[wanted] = True
            self.visited += int(wanted.sum())

        self.offered += bound.size
        ahead = min(FIRST_BLOCKS, n_blocks)
        best = np.argpartition(-bound, ahead - 1, axis=1)[:, :ahead]
        wanted = np.zeros(bound.shape, bool)
        np.put_along_axis(wanted, best, True, axis=1)
        visit(wanted & (bound > 0))
        held = np.take_along_axis(cosines, best[:, :, None], axis=1).reshape(len(queries), -1)
        reach = np.zeros(len(queries))
        if held.shape[1] >= k:
            reach = np.maximum(np.partition(held, held.shape[1] - k, axis=1)[:, -k], 0.0)
        visit((bound > 0) & (bound >= reach[:, None] - SLACK) & ~seen)
        scratch = np.zeros(self.size)
        out = []
        for line, there, least, (t, w) in zip(cosines, seen, reach, queries):
            at = ranges(np.flatnonzero(there) * BLOCK, np.full(int(there.sum()), BLOCK))
            near = line[there].ravel()
            close = (near > 0) & (near >= least - SLACK)
            at, near = at[close], near[close]
            if len(at) > k:
                at = at[near >= np.partition(near, len(at) - k)[len(at) - k] - SLACK]
            if not len(at):
                out.append((np.empty(0, np.int64), np.empty(0)))
                continue
            scratch[t] = w
            starts, ends = self.start[at], self.start[at + 1]
            spans = [slice(a, b) for a, b in zip(starts.tolist(), ends.tolist())]
            products = scratch.take(np.concatenate([self.terms[x] for x in spans]))
            products *= np.concatenate([self.weights[x] for x in spans])
            lengths = ends - starts
            exact = np.round(np.add.reduceat(products, np.cumsum(lengths) - lengths), 9)
            scratch[t] = 0.0
            kth = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) > k else 0.0
            near = (exact >= kth) & (exact > 0)
            out.append((at[near], exact[near]))
        return out

    def at_id(self, i: int) -> np.ndarray:
        """Places of the examples with one id."""
        return self.by_id[np.searchsorted(self.ids[self.by_id], i):
                          np.searchsorted(self.ids[self.by_id], i, "right")]

    def nearest(self, terms, weights, k: int, skip: int | None = None):
        """``(examples, cosines)`` of the k nearest, and all as near as the k-th.  ``skip``
        leaves out the examples of that id."""
        return self.nearest_of([(terms, weights)], k, [skip])[0]

    def votes(self, queries, k: int, skips):
        """``(vote, neighbours, nearest id, nearest cosine)`` per query; vote None without
        neighbours."""
        out = []
        for at, sims in self.nearest_of(queries, k, skips):
            if not len(at):
                out.append((None, 0, None, None))
                continue
            top = sims.max()
            near = (sims / top) ** NEARNESS
            out.append((float((near * self.labels[at]).sum() / near.sum()), len(at),
                        int(self.ids[at][sims == top].min()), float(top)))
        return out


def monotone(values: list[float], weights: list[float]) -> list[float]:
    """Weighted isotonic fit (pool adjacent violators)."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return [p[0] for p in pools for _ in range(int(p[2]))]


class Examples:
    """Term counts of the labelled rows, small enough to be sent; their index is made from them."""

    def __init__(self, rows, labels, ids):
        """``rows``: numbers and counts of the terms of every example (32 bits, as bytes)."""
        self.labels, self.ids = labels, ids
        self.sizes = np.array([len(t) // 4 for t, _ in rows], np.int64)
        terms = np.frombuffer(b"".join(t for t, _ in rows), np.int32)
        self.terms = packed(np.diff(terms, prepend=np.int32(0)))
        self.counts = packed(np.frombuffer(b"".join(c for _, c in rows), np.int32))

    def index(self, weights: np.ndarray) -> BlockMaxIndex:
        n = int(self.sizes.sum())
        terms = np.cumsum(unpacked(self.terms, n), dtype=np.int32)
        counts = unpacked(self.counts, n)
        ends = np.cumsum(self.sizes)
        spans = [slice(a, b) for a, b in zip((ends - self.sizes).tolist(), ends.tolist())]
        return BlockMaxIndex([(terms[x], unit(terms[x], counts[x], weights)) for x in spans],
                             self.labels, self.ids)


class Model:
    """Vocabulary, idf, term weights, examples and calibration curve: all bounded by the
    sample."""

    def __init__(self, vocabulary, idf, weights, examples, base, neighbours):
        self.vocabulary, self.idf, self.weights = vocabulary, idf, weights
        self.examples, self.neighbours = examples, neighbours
        self.curve = [base] * BINS

    def __getstate__(self):
        # every process numbers the words and makes the index for itself
        state = {k: v for k, v in self.__dict__.items()
                 if k not in ("vocabulary", "stems", "idf", "index")}
        return {**state, "words": packed_words(list(self.vocabulary))}

    def __setstate__(self, state):
        words = state.pop("words")
        self.__dict__.update(state)
        self.vocabulary, self.stems = numbered_words(*words) if self.examples else ({}, stems_of({}))

    @functools.cached_property
    def stems(self):
        return stems_of(self.vocabulary)

    @functools.cached_property
    def index(self):
        return self.examples.index(self.weights) if self.examples else None

    def votes(self, texts, skips=None):
        """``(vote, neighbours, nearest id, nearest cosine)`` of every text."""
        if self.index is None:
            return [(None, 0, None, None)] * len(texts)
        out = []
        for i in range(0, len(texts), BATCH):
            queries = vectors(texts[i:i + BATCH], self.vocabulary, self.weights, self.stems)
            out += self.index.votes(queries, self.neighbours,
                                    skips[i:i + BATCH] if skips else [None] * len(queries))
        return out

    def score(self, vote):
        return self.curve[0 if vote is None else min(int(vote * BINS), BINS - 1)]


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2 (null ids are not held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def examples_of(docs: DataFrame, labels: DataFrame, label_col: str, label_id: str,
                max_examples: int) -> DataFrame:
    """``__id, __text, y`` of a hash sample of about ``max_examples`` labelled documents."""
    rows = (labels.select(column(label_id).cast("bigint").alias(ID),
                          column(label_col).cast("int").alias("y"))
            .where(F.col(ID).isNotNull() & F.col("y").isNotNull())
            .groupBy(ID).agg((F.max("y") > 0).cast("int").alias("y"))
            .where(~held_out(F.col(ID))))
    n = rows.count()
    if n > max_examples:
        share = int(max_examples / n * (1 << 30))
        rows = rows.where(F.pmod(F.xxhash64(ID), F.lit(1 << 30)) < share)
    # the sample is bounded by max_examples, whatever the size of the label table
    return docs.join(F.broadcast(rows), ID)


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", label_id: str = "doc_id", max_examples: int = MAX_EXAMPLES,
        neighbours: int = NEIGHBOURS) -> Model:
    """Learn the model (see the module text)."""
    spark = documents.sparkSession
    small_batches(spark)
    docs = keyed(documents, id_col, text_col)
    rows = cut(examples_of(docs, labels, label_col, label_id, max_examples), "tox-examples")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    model = Model({}, np.empty(0), np.empty(0), None, (toxic + 0.1) / (n + 1.0), neighbours)
    if not toxic:
        return model

    def count_terms(batches):
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for t in term_counts(text):
                    at = seen.setdefault(t, [0, 0])
                    at[0] += 1
                    at[1] += y
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()),
                 pa.array([v[0] for v in seen.values()], pa.int64()),
                 pa.array([v[1] for v in seen.values()], pa.int64())], ["term", "n", "n_toxic"])

    # the terms of at most max_examples texts reach the driver; what is found most often gets the
    # first numbers, so that most reads by number stay close together
    terms = (rows.select(TEXT, "y").mapInArrow(count_terms, "term string, n bigint, n_toxic bigint")
             .groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
             .toArrow().sort_by([("n", "descending"), ("term", "ascending")]))
    vocabulary = {t: i for i, t in enumerate(terms["term"].to_pylist())}
    tie = label_tie(terms["n"].to_numpy().astype(float), terms["n_toxic"].to_numpy().astype(float),
                    toxic / n)
    del terms
    if not vocabulary:
        return model
    known = spark.sparkContext.broadcast(packed_words(list(vocabulary)))

    def count_documents(batches):
        numbers, stems = numbered_words(*known.value)
        total, seen = 0, np.zeros(len(numbers), np.int64)
        for group in groups(t for b in batches for t in b.column(0).to_pylist()):
            total += len(group)
            seen += np.bincount(counted(group, numbers, stems)[0], minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], at]), pa.int32()),
             pa.array(np.concatenate([[total], seen[at]]), pa.int64())], ["term", "n"])

    counts = (docs.select(TEXT).mapInArrow(count_documents, "term int, n bigint")
              .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    found = np.zeros(len(vocabulary) + 1, np.int64)      # the last one counts the documents
    found[counts["term"].to_numpy()] = counts["n"].to_numpy()
    idf = np.log((1.0 + found[-1]) / (1.0 + found[:-1])) + 1e-6
    weights = idf * tie

    def counts_of(batches):
        numbers, stems = numbered_words(*known.value)
        for b in batches:
            made = [counted([t], numbers, stems) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([v[i].astype(np.int32).tobytes() for v in made],
                                         pa.binary()) for i in (0, 1)), b.column(2)],
                [ID, "terms", "counts", "y"])

    # at most max_examples rows reach the driver
    made = (rows.select(ID, TEXT, "y")
            .mapInArrow(counts_of, f"{ID} bigint, terms binary, counts binary, y int").toArrow())
    model.examples = Examples([(t.as_py(), c.as_py()) for t, c in zip(made["terms"], made["counts"])],
                              made["y"].to_pylist(), made[ID].to_pylist())
    del made
    known.unpersist()
    model.vocabulary, model.idf, model.weights = vocabulary, idf, weights
    sent = spark.sparkContext.broadcast(model)

    def leave_one_out(batches):
        for b in batches:
            ids, texts, ys = (b.column(i).to_pylist() for i in range(3))
            votes = [v[0] for v in sent.value.votes(texts, ids)]
            bins = [-1 if v is None else min(int(v * BINS), BINS - 1) for v in votes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins, pa.int32()), pa.array(ys, pa.int32())], ["bin", "y"])

    table = {r.bin: (r.n, r.y) for r in
             rows.select(ID, TEXT, "y").mapInArrow(leave_one_out, "bin int, y int")
             .where("bin >= 0").groupBy("bin")
             .agg(F.count("*").alias("n"), F.sum("y").alias("y")).collect()}
    # each bin leans on its own middle where examples are few
    middle = [(b + 0.5) / BINS for b in range(BINS)]
    weight = [table.get(b, (0, 0))[0] + PRIOR_WEIGHT for b in range(BINS)]
    model.curve = monotone([(table.get(b, (0, 0))[1] + middle[b] * PRIOR_WEIGHT) / weight[b]
                            for b in range(BINS)], weight)
    sent.unpersist()
    return model


def score(documents: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id_col, score, vote, neighbours, nearest_id, nearest_cosine`` of every row."""
    spark = documents.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for b in batches:
            found = m.votes(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m.score(v[0]) for v in found], pa.float64()),
                 pa.array([v[0] for v in found], pa.float64()),
                 pa.array([v[1] for v in found], pa.int32()),
                 pa.array([v[2] for v in found], pa.int64()),
                 pa.array([v[3] for v in found], pa.float64())],
                [ID, "score", "vote", "neighbours", "nearest_id", "nearest_cosine"])

    return (keyed(documents, id_col, text_col)
            .mapInArrow(run, f"{ID} bigint, score double, vote double, neighbours int, "
                             "nearest_id bigint, nearest_cosine double")
            .withColumnRenamed(ID, id_col))


def with_score(documents: DataFrame, model: Model, text_col: str = "text",
               out_col: str = "toxicity") -> DataFrame:
    """``documents`` with one more column, the score of each row (no shuffle, no join)."""
    small_batches(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        m = sent.value
        return pd.Series([m.score(v[0]) for v in m.votes([t or "" for t in texts])],
                         dtype="float64")

    return documents.withColumn(out_col, probability(column(text_col).cast("string")))


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = fit(docs, load(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "neighbours", "nearest_id", "nearest_cosine")


__all__ = ["fit", "score", "with_score", "Model", "BlockMaxIndex", "held_out", "vector", "term_counts"]
