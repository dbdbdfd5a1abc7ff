"""Benchmark decontamination: size-partitioned MinHash containment search, DataFrame functions only.

Short test items are sought in long documents by the share of an item's five-word shingles
that the document holds (containment), which plain MinHash similarity cannot see when the sizes
differ.  Items are partitioned by size (powers of two).  One hash function orders all shingles;
an item of a partition with at most ``u`` shingles keeps its ``floor((1 - t) * u) + 1`` smallest
hashes: a document that holds a share ``t`` of the item misses fewer than that, so it holds at
least one of the kept minima, and no qualifying pair is lost.  All minima lie below one bound,
so a document only offers its shingle hashes up to it (about the share ``1 - t`` of
them); they meet the items' minima in an equi-join (broadcast only if the written minima table
is below the session's broadcast limit).  Documents with too few words for the item's partition are not
candidates.  Candidates are verified on the exact shingle strings of the whole text.
An item of fewer than five words is one shingle, its whole word sequence, and is held by a
document in which these words stand consecutively (an equi-join on runs of so many words).

Words are lower-cased runs of letters and digits; a script without spaces has one word per run.

Defined results: null or empty texts and items without words match nothing; an empty benchmark
gives an empty result.  Rows that share an item id are items of their own and are reported once,
with the best containment; repeated documents rows with one id give one row per item.  A null
id is reported as null: each row without an id is a document of its own, rows without one that
share a text are one.  Texts are searched whole, whatever their length.
``clean`` judges each row by its own text, repeated ids or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.common import (ID, TEXT, column, cut, keyed, load, register, with_made_ids,
                                  without_made_ids)

WORDS = 5
PERCENT = 80


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_strings(words: str, size: int) -> Column:
    """Distinct shingles of a word array (empty for short texts)."""
    w = F.col(words)
    every = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1),
                        lambda i: F.array_join(F.slice(w, i, size), " "))
    return F.when(F.size(w) >= size, F.array_distinct(every)).otherwise(
        F.array().cast("array<string>"))


def item_minima(items: DataFrame, percent: int, words: int) -> DataFrame:
    """``item, item_id, n, shingles, minima`` of items with shingles; the number of minima
    follows from the upper size of the item's partition."""
    rows = (items.withColumn("w", words_of(F.col("text")))
            .withColumn("shingles", shingle_strings("w", words))
            .withColumn("n", F.size("shingles")).where("n > 0"))
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1).cast("int") - 1
    kept = F.floor(F.lit(100 - percent) * upper / 100).cast("int") + 1
    hashes = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s)))
    return rows.select("item", "item_id", F.col("n").cast("bigint").alias("n"), "shingles",
                       F.slice(hashes, F.lit(1), kept).alias("minima"))


def short_items(docs: DataFrame, items: DataFrame, words: int) -> DataFrame | None:
    """``__id, item_id, n, c, containment`` of items too short for a shingle: their whole word
    sequence is one, and a document holds it where the words stand consecutively.  None if
    there is no such item, which saves a pass over the documents."""
    w = F.col("w")
    short = cut(items.select("item_id", words_of(F.col("text")).alias("w"))
                .where((F.size("w") > 0) & (F.size("w") < words))
                .select("item_id", F.size("w").alias("size"), F.concat_ws(" ", "w").alias("s")),
                "decon-short")
    sizes = sorted(r["size"] for r in short.select("size").distinct().collect())   # 1 to words - 1
    if not sizes:
        return None
    found = None
    for k in sizes:
        starts = F.explode(F.sequence(F.lit(0), F.size("w") - k))
        part = (docs.select(ID, words_of(F.col(TEXT)).alias("w")).where(F.size("w") >= k)
                .select(ID, "w", starts.alias("i"))
                .select(ID, F.concat_ws(" ", *[w[F.col("i") + j] for j in range(k)]).alias("s")))
        met = part.join(short.where(F.col("size") == k).select("item_id", "s"), "s").select(ID, "item_id")
        found = met if found is None else found.unionByName(met)
    one = F.lit(1).cast("bigint")
    return found.select(ID, "item_id", one.alias("n"), one.alias("c"), F.lit(1.0).alias("containment"))


def contained_items(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id",
                    item_text: str = "text", percent: int = PERCENT,
                    words: int = WORDS) -> DataFrame:
    """``id_col, item_id, n_item, n_common, containment`` of all pairs in which the document
    holds at least ``percent`` % of the item's distinct shingles."""
    found = held_items(with_made_ids(keyed(documents, id_col, text_col)), benchmark, item_col,
                       item_text, percent, words)
    return found.withColumn(ID, without_made_ids()).withColumnRenamed(ID, id_col)


def clean(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
          percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of ``documents`` that hold no item.  A row is judged by its own text, also if it
    has no id or shares one: rows go by a 64-bit digest of id and text."""
    key = "_" * (1 + max(map(len, documents.columns)))         # no column of theirs
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    marked = documents.withColumn(key, F.xxhash64(column(id_col).cast("bigint"), text))
    found = held_items(marked.select(F.col(key).alias(ID), text.alias(TEXT)), benchmark, item_col,
                       item_text, percent, words)
    # written, as their size decides whether the join may broadcast them
    gone = cut(found.select(F.col(ID).alias(key)).distinct(), "decon-found")
    return marked.join(gone, key, "left_anti").select(*[column(c) for c in documents.columns])


def held_items(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, percent: int,
               words: int) -> DataFrame:
    """``contained_items`` of ``docs(__id, __text)``, by their ``__id``."""
    items = (benchmark.select(column(item_col).alias("item_id"),
                              F.coalesce(column(item_text).cast("string"), F.lit("")).alias("text"))
             .withColumn("item", F.xxhash64("item_id", "text")).dropDuplicates(["item"]))
    short = short_items(docs, items, words)
    items = cut(item_minima(items, percent, words), "decon-items")
    minima = cut(items.select(F.explode("minima").alias("h"), "item", "n"), "decon-minima")
    bound = minima.agg(F.max("h")).first()[0]            # one number

    w = F.col("w")
    offers = (docs.select(ID, words_of(F.col(TEXT)).alias("w")).where(F.size("w") >= words)
              .select(ID, "w", F.explode(F.sequence(F.lit(0), F.size("w") - words)).alias("i"))
              .select(ID, (F.size(w) - words + 1).alias("most"),
                      F.xxhash64(F.concat_ws(" ", *[w[F.col("i") + j] for j in range(words)]))
                      .alias("h"))
              .where(F.col("h") <= F.lit(bound).cast("bigint")))
    candidates = (offers.join(minima, "h").where(f"100 * most >= {percent} * n")
                  .groupBy(ID).agg(F.collect_set("item").alias("items")))
    candidates = cut(candidates, "decon-candidates")

    held = (docs.join(candidates, ID)
            .select(ID, "items", words_of(F.col(TEXT)).alias("w"))
            .select(ID, "items", shingle_strings("w", words).alias("held"))
            .select(ID, "held", F.explode("items").alias("item")))
    exact = (held.join(items.select("item", "item_id", "n", "shingles"), "item")
             .select(ID, "item_id", "n",
                     F.size(F.array_intersect("shingles", "held")).cast("bigint").alias("c"))
             .where(f"100 * c >= {percent} * n")
             .withColumn("containment", F.col("c") / F.col("n")))
    if short is not None:
        exact = exact.unionByName(short)
    best = exact.groupBy(ID, "item_id").agg(
        F.max(F.struct("containment", "n", "c")).alias("b"))
    return best.select(ID, "item_id",
                       F.col("b.n").alias("n_item"), F.col("b.c").alias("n_common"),
                       F.col("b.containment").alias("containment"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
            FROM documents),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3),
              lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM dw WHERE len(w) >= 5),
iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
       FROM benchmark),
i AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3),
             lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM iw WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_common, count(*) / n_item AS containment
FROM ds JOIN i USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
UNION ALL
SELECT DISTINCT doc_id, item_id, 1, 1, 1.0::DOUBLE FROM dw JOIN (SELECT * FROM iw WHERE len(w) BETWEEN 1 AND 4) s
ON list_contains(list_transform(range(1, len(dw.w) - len(s.w) + 2), lambda i: dw.w[i:i + len(s.w) - 1]), s.w)
"""


@register("op3_decontamination", ORACLE)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


__all__ = ["contained_items", "clean", "item_minima", "shingle_strings", "words_of"]
