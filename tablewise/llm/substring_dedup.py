"""Substring dedup by hashing text units.

A text is cut into pieces that put together are the text: by default lines, or paragraphs, or
sentences (a run of other characters with the sentence marks and the line break that follow).
Every piece that is not blank is a unit (``min_words`` can ask for more); its words (runs of digits,
letters and characters beyond ASCII, A-Z lower-cased) joined by spaces are its normal form, so
case, punctuation and spacing do not matter, and a line of a script without spaces is its
characters; a unit without words is its marks.  Digests of normal forms (128 bits) are grouped over
the whole corpus; the earliest occurrence by (id, place) stays and the others are removed, with
their offsets in the original text.

Every task sends a digest once per flush with its smallest id; the grouping yields one owner per
digest, and a document gets the digests it owns.  What it does not own, or has seen further up,
goes.  So a line found in a third of all documents is one row per task and never a group.

Defined results: null text is empty text; blank pieces and pieces below ``min_words`` always
stay; rows without an id come first, in the order of a hash of their text; rows that share an id
(and rows without one that share a text) count as one document and do not remove each other's
units, so repeated rows repeat the same result.  A text is read whole whatever its length, in one
pass per step.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.common import (FLUSH_ROWS, ID, cut, first_rows, keyed, load, owners, register,
                                  sender, small_batches, with_made_ids, without_made_ids)

MIN_WORDS = 0
PIECES = {"sentence": r"[^\n.!?]+[.!?]*\n?|[.!?\n]+",
          "line": r"[^\n]+\n?|\n+",
          "paragraph": r"(?:[^\n]+\n?)+|\n+"}


def unit_reader(unit: str, min_words: int):
    """``text -> (pieces, unit numbers, digests)``: two longs per unit."""
    import xxhash
    pieces_of = re.compile(PIECES[unit]).findall
    words_of = re.compile(rb"[0-9a-z\x80-\xff]+").findall

    def read(text: str):
        pieces = pieces_of(text)
        at, high, low = [], [], []
        for i, p in enumerate(pieces):
            raw = p.encode()
            words = words_of(raw.lower())
            if len(words) >= min_words and (words or raw.strip()):
                # no words: the marks, after a space that no run of words begins with
                h = xxhash.xxh3_128_intdigest(b" ".join(words or [b"", *raw.split()]))
                at.append(i)
                high.append(h >> 64)
                low.append(h & 0xFFFFFFFFFFFFFFFF)
        return (pieces, at, np.array(high, np.uint64).view(np.int64),
                np.array(low, np.uint64).view(np.int64))

    return read


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                unit: str = "line", min_words: int = MIN_WORDS,
                with_kept: bool = False) -> DataFrame:
    """Per row: ``n_units, n_removed, removed_chars, first_removed`` (offset, -1 if none), ``kept_sha256``;
    ``with_kept`` adds ``kept_text`` and ``removed`` (start and end of every removed unit in
    characters of the original text)."""
    small_batches(documents.sparkSession)
    docs = with_made_ids(keyed(documents, id_col, text_col))

    def units(batches):
        read = unit_reader(unit, min_words)
        held, flush = sender(["g", "e", "owner"])
        rows = 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                _, _, g, e = read(text)
                held.append((g, e, np.full(len(g), doc, np.int64)))
                rows += len(g)
                if rows >= FLUSH_ROWS:
                    yield flush()
                    rows = 0
        if rows:
            yield flush()

    owned = (owners(docs.mapInArrow(units, "g bigint, e bigint, owner bigint"), "e")
             .groupBy(F.col("owner").alias(ID)).agg(F.collect_list("e").alias("owned")))

    def remove(batches):
        read = unit_reader(unit, min_words)
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for text, mine in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                pieces, at, _, e = read(text)
                stays = np.zeros(len(e), bool)
                if len(e):
                    stays[first_rows(e)] = True
                    stays &= np.isin(e, np.array(mine or [], np.int64))
                gone = {i for i, s in zip(at, stays.tolist()) if not s}
                spans, offset = [], 0
                for i, p in enumerate(pieces):
                    if i in gone:
                        spans.append([offset, offset + len(p)])
                    offset += len(p)
                kept = "".join([p for i, p in enumerate(pieces) if i not in gone])
                for col, v in zip(cols, (len(at), len(gone), sum(z - a for a, z in spans),
                                         spans[0][0] if spans else -1,
                                         hashlib.sha256(kept.encode()).hexdigest(), kept, spans)):
                    col.append(v)
            arrays = [b.column(0)] + [pa.array(c, pa.int64()) for c in cols[:4]]
            arrays.append(pa.array(cols[4], pa.string()))
            if with_kept:
                arrays += [pa.array(cols[5], pa.string()),
                           pa.array(cols[6], pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = (f"{ID} bigint, n_units bigint, n_removed bigint, removed_chars bigint, "
              "first_removed bigint, kept_sha256 string")
    if with_kept:
        schema += ", kept_text string, removed array<array<bigint>>"
    names = [c.split()[0] for c in schema.split(", ")]
    out = docs.join(cut(owned, "substring-owned"), ID, "left").mapInArrow(remove, schema)
    return out.withColumn(ID, without_made_ids()).withColumnRenamed(ID, id_col)


ORACLE = r"""
WITH p AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''),
                  '[^\n]+\n?|\n+') AS ps FROM documents),
x AS (SELECT doc_id, unnest(ps) AS s, generate_subscripts(ps, 1) AS i FROM p),
y AS (SELECT *, array_to_string(regexp_extract_all(
             translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[0-9a-z\x{80}-\x{10FFFF}]+'), ' ') AS words,
             sum(length(s)) OVER (PARTITION BY doc_id ORDER BY i) - length(s) AS pos FROM x),
z AS (SELECT *, regexp_matches(s, '[^\x20\x09-\x0D]') AS unit,
             CASE WHEN words <> '' THEN words
                  ELSE ' ' || array_to_string(regexp_extract_all(s, '[^\x20\x09-\x0D]+'), ' ') END AS norm
      FROM y),
r AS (SELECT *, unit AND row_number() OVER (PARTITION BY unit, norm ORDER BY doc_id, i) > 1 AS gone
      FROM z),
k AS (SELECT doc_id, count(*) FILTER (unit) AS n_units, count(*) FILTER (gone) AS n_removed,
             cast(coalesce(sum(length(s)) FILTER (gone), 0) AS BIGINT) AS removed_chars,
             cast(min(pos) FILTER (gone) AS BIGINT) AS first_removed,
             sha256(coalesce(string_agg(s, '' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
      FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_chars, 0) AS removed_chars, coalesce(first_removed, -1) AS first_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id)
"""


@register("op1_substring_dedup", ORACLE)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(load(spark, sf_dir, "documents"))


__all__ = ["deduplicate", "unit_reader"]
