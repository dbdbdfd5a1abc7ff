"""Removal of repeated byte strings by prefix-free parsing.

Every byte covered by a ``length``-byte string that also starts earlier in corpus order (smaller
id, or same document and earlier start) is removed; matches do not cross documents and are judged
on the input.

Parse
    A rolling hash over ``GRAM`` bytes picks triggers: each window of ``length`` bytes is tied to
    the smallest gram hash inside it (leftmost on ties), a property of its bytes alone.  Runs
    of window starts with one trigger form a phrase: the bytes from the first window's start to
    the last window's end.  Equal windows have equal triggers at equal offsets, wherever they
    stand; phrases are at most ``2 * length`` bytes long and overlap by ``length - 1``, so each
    window lies in exactly one phrase.
Dictionary and parse
    The dictionary is the set of distinct phrases (trigger hash, phrase hash), each with the first
    document that holds it: one pre-aggregated row per phrase and task is shuffled.  All windows
    of a later occurrence of a phrase are repeats.  A window reaches at least ``(length - GRAM) / 2``
    bytes beyond its trigger on one side, so in first occurrences only those on a side that
    another dictionary phrase shares (trigger and that many bytes) can be repeats.
Order
    For these phrases the suffixes that start at their window starts, cut at ``length`` bytes
    (deeper comparison cannot matter), are brought together by trigger and suffix hash and ranked by
    the parse: the first in corpus order stays.  This is the suffix order of dictionary and parse
    reduced to what decides a repeat; suffixes with a common prefix shorter than ``length``
    are never compared, so the full arrays need not exist.

A document learns which phrases and suffixes it owns, not which ones it lost, so a phrase
shared by a third of the corpus is one row, never a group.

Defined results: null text is empty text; texts shorter than ``length`` bytes keep everything.
Rows without an id come first, in the order of a hash of their text.  Rows that share an id (and
rows without one that share a text) count as one document and do not remove each other's text, so
repeated rows repeat the same result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.llm.common import (FLUSH_ROWS, ID, TEXT, column, cut, first_rows, keyed, load, owners,
                                  register, sender, small_batches, with_made_ids, without_made_ids)

LENGTH = 100
GRAM = 24
SAMPLE = 64               # one document in so many tells which triggers are common
COMMON = 4096             # at most so many of them
CHUNK = 1 << 20           # window starts handled at once, bounds the memory of a long text


def parser(length: int, gram: int = GRAM):
    """``(phrases, suffixes)``: the parse of one text, and its window hashes."""
    base = np.uint64(0x9E3779B97F4A7C15 | 1)
    size = CHUNK + 2 * length
    inverse = np.uint64(pow(int(base), -1, 2 ** 64))
    cache: dict[str, np.ndarray] = {}
    last_chunk: list = [None, 0, None]     # text, place and sums of the chunk hashed last
    reach = (length - gram + 1) // 2

    def powers(n):
        have = len(cache["up"]) if cache else 0
        if have < n:
            n = min(size, max(n, 2 * have, 1 << 14))
            with np.errstate(over="ignore"):
                cache["up"] = np.cumprod(np.concatenate(
                    [np.ones(1, np.uint64), np.full(n - 1, base)]), dtype=np.uint64)
                cache["down"] = np.cumprod(np.concatenate(
                    [np.ones(1, np.uint64), np.full(n - 1, inverse)]), dtype=np.uint64)
        return cache["up"], cache["down"]

    def mix(x):
        x = x ^ (x >> np.uint64(32))
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        return x

    def prefixes(text, at, data):
        up, down = powers(len(data) + 1)
        if last_chunk[0] is not text or last_chunk[1] != at:
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
            last_chunk[:] = text, at, sums
        return last_chunk[2], down

    def window_minimum(x, w):
        step = 1
        while 2 * step <= w:
            x = np.minimum(x[:-step], x[step:])
            step *= 2
        return np.minimum(x[:len(x) - (w - step)], x[w - step:]) if w > step else x

    def chunks(text):
        data = np.frombuffer(text, np.uint8)
        for at in range(0, max(0, len(data) - length + 1), CHUNK):
            yield at, data[at:at + CHUNK + length - 1]

    def phrases(text: bytes):
        """Arrays: first start, last start, trigger position, trigger hash, phrase hash, and the
        two 32-bit hashes of the trigger with the bytes beside it (left, right)."""
        found = []
        for at, data in chunks(text):
            sums, down = prefixes(text, at, data)
            grams = mix((sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1])
            packed = grams & np.uint64(0xFFFFFFFF00000000)
            packed |= np.arange(len(grams), dtype=np.uint64)
            low = window_minimum(packed, length - gram + 1)
            cuts = np.flatnonzero(low[1:] != low[:-1])
            first = np.concatenate([np.zeros(1, np.int64), cuts + 1])
            last = np.concatenate([cuts, np.array([len(low) - 1])])
            trigger = (low[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            body = (sums[last + length] - sums[first]) * down[first]
            shape = (((last - first) << 20) + (trigger - first)).astype(np.uint64)
            phrase = mix(body ^ mix(shape))
            # a phrase without windows on a side has nothing to share there
            left, right = phrase >> np.uint64(32), phrase & np.uint64(0xFFFFFFFF)
            has = trigger - first >= reach
            t = trigger[has]
            left[has] = mix((sums[t + gram] - sums[t - reach]) * down[t - reach]) >> np.uint64(32)
            has = last > trigger - reach
            t = trigger[has]
            right[has] = mix((sums[t + length - reach + 1] - sums[t]) * down[t]) >> np.uint64(32)
            found.append((first + at, last + at, trigger + at, grams[trigger].view(np.int64),
                          phrase.view(np.int64), (left << np.uint64(32) | right).view(np.int64)))
        if not found:
            none = np.empty(0, np.int64)
            return (none,) * 6
        return tuple(np.concatenate(x) for x in zip(*found))

    def suffixes(text: bytes, first, last, trigger, on_left, on_right):
        """Hashes of the ``length``-byte strings that start in ``first[i]..last[i]``, of those
        that reach left of the trigger and of the others as told: starts, phrase numbers, hashes."""
        first = np.where(on_left, first, np.maximum(first, trigger - reach + 1))
        last = np.where(on_right, last, np.minimum(last, trigger - reach))
        n = np.maximum(last - first + 1, 0)
        which = np.repeat(np.arange(len(first)), n)
        starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        out = np.empty(len(starts), np.int64)
        for at, data in chunks(text):
            here = (starts >= at) & (starts < at + CHUNK)
            if here.any():
                sums, down = prefixes(text, at, data)
                p = starts[here] - at
                out[here] = mix((sums[p + length] - sums[p]) * down[p]).view(np.int64)
        return starts, which, out

    return phrases, suffixes


def common_triggers(docs: DataFrame, length: int) -> list[int]:
    """Trigger hashes that stand in many documents (with different surroundings, or they would be
    one phrase), found in a sample of the documents: at most ``COMMON`` numbers.  The list only
    says how rows are dealt; it changes no result."""
    def run(batches):
        phrases, _ = parser(length)
        for b in batches:
            found = [np.unique(phrases(t.encode())[3]) for t in b.column(0).to_pylist()]
            g, n = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n)], ["g", "n"])

    sample = docs.where(F.pmod(F.xxhash64(ID), F.lit(SAMPLE)) == 0)
    least = max(8, sample.count() // 500)
    return [r.g for r in sample.select(TEXT).mapInArrow(run, "g bigint, n bigint").groupBy("g")
            .agg(F.sum("n").alias("n")).where(f"n >= {least}").orderBy(F.desc("n"), "g")
            .limit(COMMON).collect()]


def dictionary_rows(docs: DataFrame, length: int) -> DataFrame:
    """``g, e, owner, sides``: trigger and phrase hash of the phrases of every text.  Phrases of a
    common trigger go by their own hash (``g = e``) and count as shared on both sides unseen, so
    no task gathers all surroundings of a very frequent string."""
    common = np.array(sorted(common_triggers(docs, length)), np.int64)

    def run(batches):
        phrases, _ = parser(length)
        held, flush = sender(["g", "e", "owner", "sides"])
        rows = 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                _, _, _, g, e, sides = phrases(text.encode())
                g = np.where(np.isin(g, common), e, g)
                held.append((g, e, np.full(len(g), doc, np.int64), sides))
                rows += len(g)
                if rows >= FLUSH_ROWS:
                    yield flush()
                    rows = 0
        if rows:
            yield flush()

    return docs.mapInArrow(run, "g bigint, e bigint, owner bigint, sides bigint")


def among(values: np.ndarray, wanted) -> np.ndarray:
    """Which of the values are in the list (or None)."""
    wanted = np.sort(np.array(wanted or [], np.int64))
    if not len(wanted):
        return np.zeros(len(values), bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def open_suffixes(data: bytes, todo_left, todo_right, parse, own=None):
    """``g, starts, hashes`` of the windows that may be repeats, in first occurrences (``own``: only
    of these phrase numbers)."""
    phrases, suffixes = parse
    first, last, trigger, g, e, _ = phrases(data) if own is None else own[0]
    at = first_rows(e) if own is None else own[1]
    on_left = among(e[at], todo_left)
    on_right = among(e[at], todo_right)
    some = on_left | on_right
    at = at[some]
    starts, which, s = suffixes(data, first[at], last[at], trigger[at], on_left[some],
                                on_right[some])
    return g[at][which], starts, s


def suffix_rows(docs: DataFrame, length: int) -> DataFrame:
    """``g, s, owner``: window hash and trigger hash of the windows that may be repeats."""
    def run(batches):
        parse = parser(length)
        held, flush = sender(["g", "s", "owner"])
        rows = 0
        for b in batches:
            for doc, text, left, right in zip(*(b.column(i).to_pylist() for i in range(4))):
                s, _, g = open_suffixes(text.encode(), left, right, parse)
                held.append((g, s, np.full(len(g), doc, np.int64)))
                rows += len(g)
                if rows >= FLUSH_ROWS:
                    yield flush()
                    rows = 0
        if rows:
            yield flush()

    return docs.mapInArrow(run, "g bigint, s bigint, owner bigint")


def removed_bytes(text: bytes, owned, todo_left, todo_right, suffix_owned, parse, length: int):
    """Boolean mask of the removed bytes of one text."""
    found = parse[0](text)
    first, last, e = found[0], found[1], found[4]
    cover = np.zeros(len(text) + 1, np.int32)
    if len(e):
        kept = np.zeros(len(e), bool)
        kept[first_rows(e)] = True
        kept &= among(e, owned)
        np.add.at(cover, first[~kept], 1)
        np.add.at(cover, last[~kept] + length, -1)
        _, starts, s = open_suffixes(text, todo_left, todo_right, parse,
                                     (found, np.flatnonzero(kept)))
        if len(s):
            stays = np.zeros(len(s), bool)
            stays[first_rows(s)] = True
            stays &= among(s, suffix_owned)
            np.add.at(cover, starts[~stays], 1)
            np.add.at(cover, starts[~stays] + length, -1)
    return np.cumsum(cover[:-1]) > 0


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                length: int = LENGTH, with_kept: bool = False,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` of every row; ``with_kept`` adds the
    remaining bytes as ``kept``, the same as text without characters that lost some of their
    bytes (``kept_text``), and the removed ``spans`` (start, end).  The columns named in
    ``carry`` travel along as the struct ``row``."""
    small_batches(documents.sparkSession)
    docs = with_made_ids(keyed(documents, id_col, text_col))
    rows = with_made_ids(documents.select(
        column(id_col).cast("bigint").alias(ID),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias(TEXT),
        *([F.struct(*[column(c) for c in carry]).alias("row")] if carry else [])))

    found = owners(dictionary_rows(docs, length), "e", "sides").selectExpr(
        "g", "e", "owner", "shiftright(sides, 32) as l", "sides & 4294967295L as r")
    found = found.selectExpr(
        "owner", "e", "g = e or count(*) over (partition by g, l) > 1 as on_left",
        "g = e or count(*) over (partition by g, r) > 1 as on_right")
    owned = cut(found.groupBy(F.col("owner").alias(ID)).agg(
        F.collect_list("e").alias("owned"),
        F.collect_list(F.when(F.col("on_left"), F.col("e"))).alias("todo_left"),
        F.collect_list(F.when(F.col("on_right"), F.col("e"))).alias("todo_right")),
        "suffix-phrases")

    todo = owned.where("size(todo_left) + size(todo_right) > 0").drop("owned")
    # from ``rows``, so that the join below can use the same exchange of the texts
    open_docs = rows.join(todo, ID).select(ID, TEXT, "todo_left", "todo_right",
                                           *(["row"] if carry else []))
    ranked = owners(suffix_rows(open_docs, length), "s")
    suffix_owned = ranked.groupBy(F.col("owner").alias(ID)).agg(
        F.collect_list("g").alias("suffix_owned"))

    def run(batches):
        parse = parser(length)
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text, *lists in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
                data = text.encode()
                gone = removed_bytes(data, *lists, parse, length)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                for col, v in zip(cols, (len(data), int(gone.sum()), len(edges) // 2,
                                         hashlib.sha256(kept).hexdigest(), kept,
                                         edges.reshape(-1, 2).tolist())):
                    col.append(v)
            arrays = [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                      pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())]
            names = [ID, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if carry:
                arrays.append(b.column(6))
                names.append("row")
            if with_kept:
                arrays += [pa.array(cols[4], pa.binary()),
                           pa.array([k.decode("utf-8", "ignore") for k in cols[4]], pa.string()),
                           pa.array(cols[5], pa.list_(pa.list_(pa.int64())))]
                names += ["kept", "kept_text", "spans"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = T.StructType([T.StructField(c, T.LongType()) for c in
                           (ID, "n_bytes", "n_removed", "n_spans")])
    schema = schema.add("kept_sha256", T.StringType())
    if carry:
        schema = schema.add(rows.schema["row"])
    if with_kept:
        schema = (schema.add("kept", T.BinaryType()).add("kept_text", T.StringType())
                  .add("spans", T.ArrayType(T.ArrayType(T.LongType()))))
    out = (rows.join(owned, ID, "left").join(suffix_owned, ID, "left")
           .select(ID, TEXT, "owned", "todo_left", "todo_right", "suffix_owned",
                   *(["row"] if carry else []))
           .mapInArrow(run, schema))
    return out.withColumn(ID, without_made_ids()).withColumnRenamed(ID, id_col)


ORACLE = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
r AS (SELECT doc_id, p FROM w
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
i AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0
                             ELSE 1 END AS fresh FROM r),
g AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM i),
s AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS z FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM s
      UNION ALL SELECT d.doc_id, coalesce(max(z), 0), len(any_value(h)) // 2
      FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
b AS (SELECT doc_id, string_agg(substr(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS kept
      FROM k JOIN d USING (doc_id) WHERE t > f GROUP BY doc_id),
n AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, cast(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN b USING (doc_id)
"""


@register("op7_suffix_dedup", ORACLE)
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(load(spark, sf_dir, "documents"))


__all__ = ["deduplicate", "parser", "removed_bytes"]
