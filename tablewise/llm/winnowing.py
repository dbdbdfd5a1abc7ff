"""Document fingerprints by winnowing, DataFrame functions only.

A text's UTF-8 bytes give one hash per k-gram; in every window of ``w`` consecutive k-grams the
smallest hash is chosen, the rightmost on ties, and the fingerprint is the set of chosen
(hash, position) pairs.  Guarantee: two texts that share a run of ``w + k - 1`` bytes share a
fingerprint hash, and no shared run shorter than ``k`` bytes is seen.

One array pass computes the hashes, packed with the falling position so that a plain minimum
breaks ties to the right; log2(w) pairwise minima give the window minima.  Long texts are handled in
chunks of windows inside the row, so memory holds one chunk's arrays and the chosen pairs.

``edited_comparison`` compares each text with an edited copy and with the next document in id
order.  Rows go to id ranges (bounds are approximate quantiles, a bounded list); the first row of
a range also goes to the range before it, and the very first to the last range, so each range
finds the successor of its last row by itself: no global sort, one shuffle.

Defined results: null text is empty text, with an empty fingerprint; a text shorter than ``k``
bytes has one pair, the hash of all of it; a text with fewer than ``w`` k-grams keeps all of them.
Likeness is the Jaccard similarity of the hash sets (two empty ones: 1).  Rows without an id come
first; rows with one id follow in text order, repeated rows included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewise.llm.common import (NO_ID, TEXT, bucket_of, id_bounds, keyed, load, register, ID)

GRAM = 12
WINDOW = 32               # a power of two
CHUNK = 1 << 15           # windows handled at once
MAX_POSITION = 0x7FFFFFFF
RANGE_ROWS = 2_048        # rows of an id range


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once (expressions inside a lambda are not shared)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chosen(piece: Column, base: Column, k: int, w: int) -> Column:
    """Packed pairs chosen in one chunk of bytes; ``base`` is its offset in the text."""
    grams = F.octet_length(piece) - k + 1

    def packed(i: Column) -> Column:
        h = F.xxhash64(F.substring(piece, i, F.lit(k))).bitwiseAND(F.lit(0x7FFFFFFF))
        return F.shiftleft(h, 32).bitwiseOR(F.lit(MAX_POSITION) - base - i)

    def halved(step: int):
        return lambda x: F.zip_with(x, F.slice(x, F.lit(step + 1), F.size(x)),
                                    lambda a, b: F.least(a, b))

    def minima(values: Column) -> Column:
        step, body = 1, values
        while step < w:
            body = let(body, halved(step))
            step *= 2
        return F.array_distinct(F.slice(body, F.lit(1), grams - w + 1))

    return let(F.transform(F.sequence(F.lit(1), grams), packed), lambda x: F.when(
        grams >= w, minima(x)).otherwise(x))


def pairs_of(data: Column, base: Column, k: int, w: int) -> Column:
    """Pairs of some bytes that start at offset ``base`` of a text."""
    n = F.octet_length(data)
    starts = F.sequence(F.lit(0), F.greatest(n - k - w + 1, F.lit(0)), F.lit(CHUNK))
    pieces = F.transform(starts, lambda at: let(
        F.substring(data, at + 1, F.lit(CHUNK + k + w - 2)),
        lambda piece: chosen(piece, base + at, k, w)))
    whole = F.shiftleft(F.xxhash64(data).bitwiseAND(F.lit(0x7FFFFFFF)), 32).bitwiseOR(
        F.lit(MAX_POSITION - 1))
    return (F.when(n == 0, F.array().cast("array<bigint>")).when(n < k, F.array(whole))
            .otherwise(F.array_distinct(F.flatten(pieces))))


def fingerprint(text: Column, k: int = GRAM, w: int = WINDOW) -> Column:
    """``array<bigint>`` of chosen pairs in text order: hash in the upper 31 bits, falling
    position below."""
    return let(text.cast("binary"), lambda data: pairs_of(data, F.lit(0), k, w))


def edited_fingerprint(pairs: str, edited: str, head: str, k: int = GRAM,
                       w: int = WINDOW) -> Column:
    """Fingerprint of ``edited`` (binary), whose first ``head`` bytes are those of the text with
    fingerprint ``pairs``: equal to ``fingerprint(edited)``, but only the windows that reach
    beyond the head, and one window length before them, are computed."""
    first = F.col(head) - (w + k - 2)           # first window that leaves the head
    start = first - w
    old = F.filter(F.col(pairs),
                   lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)) > F.lit(MAX_POSITION - 1) - first)
    new = let(F.substring(F.col(edited), start + 1, F.octet_length(F.col(edited))),
              lambda data: pairs_of(data, start, k, w))
    return F.when(start > 0, F.array_distinct(F.concat(old, new))).otherwise(
        let(F.col(edited), lambda data: pairs_of(data, F.lit(0), k, w)))


def hashes(pairs: Column) -> Column:
    return F.array_distinct(F.transform(pairs, lambda x: F.shiftright(x, 32)))


def positions(pairs: Column) -> Column:
    """Byte offsets (from 0) of the chosen k-grams, in the order of the pairs."""
    return F.transform(pairs, lambda x: F.lit(MAX_POSITION - 1) - x.bitwiseAND(F.lit(0x7FFFFFFF)))


def likeness(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def digest(pairs: str) -> Column:
    """Text form of a fingerprint: MD5 of its pairs in order."""
    return F.md5(F.array_join(F.transform(F.col(pairs), lambda x: F.hex(x)), ",")
                 .cast("binary"))


def edited_comparison(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Per row: ``n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` and the number of pairs.  The edited text has its last quarter replaced by the
    first as many characters of the next document."""
    docs = keyed(documents, id_col, text_col).withColumn(ID, F.coalesce(ID, F.lit(NO_ID)))
    low, bounds = id_bounds(docs, RANGE_ROWS)
    rows = docs.select(ID, TEXT, fingerprint(F.col(TEXT), k, w).alias("pairs"),
                       bucket_of(F.col(ID), bounds).alias("range"))
    heads = [b for b in [low, *bounds] if b is not None]
    before = F.when(F.col("range") == 0, F.lit(len(bounds))).otherwise(F.col("range") - 1)
    rows = rows.select(ID, TEXT, "pairs", F.explode(F.when(
        F.col(ID).isin(heads), F.array(F.struct("range", F.lit(False).alias("guest")),
                                       F.struct(before.alias("range"), F.lit(True).alias("guest"))))
        .otherwise(F.array(F.struct("range", F.lit(False).alias("guest"))))).alias("to"))
    order = Window.partitionBy("to.range").orderBy("to.guest", ID, TEXT)
    rows = (rows.select(ID, TEXT, "pairs", "to.guest",
                        F.lead(TEXT).over(order).alias("next"),
                        F.lead("pairs").over(order).alias("next_pairs"))
            .where("not guest"))

    n = F.length(TEXT)
    m = F.floor(n / 4).cast("int")
    head = F.substring(F.col(TEXT), F.lit(1), n - m)
    rows = rows.select(ID, n.cast("bigint").alias("n_chars"), "pairs", "next_pairs",
                       F.octet_length(head).alias("head"),
                       F.concat(head, F.substring(F.col("next"), F.lit(1), m)).cast("binary")
                       .alias("edited"))
    rows = rows.select(ID, "n_chars", "pairs", F.sha2("edited", 256).alias("edited_sha256"),
                       edited_fingerprint("pairs", "edited", "head", k, w).alias("epairs"),
                       hashes(F.col("pairs")).alias("h"), hashes(F.col("next_pairs")).alias("nh"))
    rows = rows.select("*", hashes(F.col("epairs")).alias("eh"))
    return rows.select(
        F.nullif(F.col(ID), F.lit(NO_ID)).alias(id_col), "n_chars", "edited_sha256",
        digest("pairs").alias("fingerprint"), digest("epairs").alias("edited_fingerprint"),
        likeness("h", "eh").alias("near_edited"), likeness("h", "nh").alias("near_next"),
        F.size("pairs").alias("n_pairs"))


@register("op5_winnowing")
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_comparison(load(spark, sf_dir, "documents"))


__all__ = ["fingerprint", "edited_fingerprint", "hashes", "positions", "edited_comparison"]
