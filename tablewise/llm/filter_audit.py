"""Filter interaction audit: what every order of a set of filters removes, step by step.

Each document becomes a mask, one bit per filter that it fails, and documents with one part, mask
and pair of flags are one counted cell, so a table of any size is a few cells per part.  A literal
array holds all orders of the filters; a cell folds across it with ``transform`` (orders) and
``aggregate`` (steps, carrying what was removed so far), which gives one struct per order and step
weighted by the cell's counts (600 for five filters).  The arrays of a part's cells are merged by
elementwise sums, and the Shapley sums come from the merged array.

Exact copies (filter E of the query) need the corpus: rows go by the digest of their text.
Each (id, digest) is one counted row, each (digest, part, flags) one row with its smallest id;
only these meet in a group, so a text held by a third of all documents is a few rows there.

Defined results: null text is empty text; a null part is the empty string; a null id is never
smaller or larger than another, so such a row is no copy of anything and makes none, and it has
no labels; rows with equal ids do not make copies of each other; of several label rows of an id
one with the value is enough.  Repeated rows count each time.  No documents, no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewise.llm.common import ID, TEXT, column, cut, load, register

WORD_GAP = r"[\x20\x09-\x0D]+"
COPY = "E"                       # letter of the filter that looks at other documents
# fixed values: the measures of one order and step, in the order of the fold's struct
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text (never null)."""
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * capitals > 3 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def masks(documents: DataFrame, filters: dict[str, Column], part_col: str | None = "lang",
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id, digest, part, mask, n``: rows of equal id, text and part counted.  ``filters``
    are conditions on the column ``__text``; filter ``k`` (by position) is bit ``k`` of the mask."""
    part = F.coalesce(column(part_col).cast("string"), F.lit("")) if part_col else F.lit("")
    mask = reduce(lambda a, b: a + b, [F.when(c, F.lit(1 << k)).otherwise(F.lit(0))
                                       for k, c in enumerate(filters.values())])
    docs = documents.select(part.alias("part"), column(id_col).cast("bigint").alias(ID),
                            F.coalesce(column(text_col).cast("string"), F.lit("")).alias(TEXT))
    return (docs.select(ID, F.unhex(F.sha2(TEXT, 256)).alias("digest"), "part",
                        mask.cast("int").alias("mask"))
            .groupBy(ID, "digest", "part", "mask").agg(F.count("*").alias("n")))


def flagged(rows: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """``masks`` rows with ``good`` (quality 1) and ``toxic`` (toxic 1).  Rows without an id have
    no labels and stay out of the join."""
    def any_one(name: str) -> Column:
        return F.max(F.coalesce(column(name) == 1, F.lit(False)))

    marks = (labels.where(column(label_id).isNotNull())
             .groupBy(column(label_id).cast("bigint").alias(ID))
             .agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic")))
    known = (rows.where(F.col(ID).isNotNull()).join(marks, ID, "left")
             .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}))
    return known.unionByName(rows.where(F.col(ID).isNull()).withColumns(
        {"good": F.lit(False), "toxic": F.lit(False)}))


def cells(rows: DataFrame, copy_bit: int | None) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those with each flag, per part and mask.
    ``copy_bit`` is added where a smaller id holds the same text."""
    flags = ["good", "toxic"]
    if copy_bit is not None:
        texts = rows.groupBy("digest", "part", "mask", *flags).agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.when(F.col(ID).isNull(), F.col("n"))), F.lit(0)).alias("n_free"),
            F.min(F.when(F.col(ID).isNotNull(), F.struct(ID, "n"))).alias("low"))
        lowest = F.min(f"low.{ID}").over(Window.partitionBy("digest"))
        first = F.col("n_free") + F.when(F.col(f"low.{ID}") == lowest,
                                         F.col("low.n")).otherwise(F.lit(0))
        texts = texts.withColumn("n_first", first)
        rows = texts.select("part", *flags, F.inline(F.array(
            F.struct("mask", F.col("n_first").alias("n")),
            F.struct((F.col("mask") + F.lit(1 << copy_bit)).cast("int").alias("mask"),
                     (F.col("n") - F.col("n_first")).alias("n"))))).where("n > 0")
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0))).alias(c) for c in flags])


def orders_of(n_filters: int) -> list[tuple[int, ...]]:
    return list(permutations(range(n_filters)))


def folded(cell: DataFrame, n_filters: int) -> DataFrame:
    """``part, steps``: per cell one array of structs, all steps of all orders, each weighted by
    the cell's counts."""
    orders = F.expr("array(" + ", ".join(f"array({', '.join(map(str, o))})"
                                         for o in orders_of(n_filters)) + ")")
    zero = F.lit(0).cast("bigint")

    def bit(mask: Column, k: Column) -> Column:
        return mask.bitwiseAND(F.call_function("shiftleft", F.lit(1), k)) != 0

    def step(state: Column, k: Column) -> Column:
        fails, gone = bit(F.col("mask"), k), state["gone"]
        here = fails & ~gone

        def weight(condition: Column, name: str) -> Column:
            return F.when(condition, F.col(name)).otherwise(zero)

        done = F.struct(
            k.alias("k"), weight(~fails & ~gone, "n").alias("kept"), weight(here, "n").alias("removed"),
            weight(fails & gone, "n").alias("redundant"),
            weight(fails & (F.bit_count(F.col("mask")) == 1), "n").alias("unique_fails"),
            weight(here, "good").alias("good_lost"), weight(here, "toxic").alias("toxic_lost"))
        return F.struct((gone | fails).alias("gone"),
                        F.array_append(state["steps"], done).alias("steps"))

    kind = "array<struct<k:int," + ",".join(f"{m}:bigint" for m in MEASURES) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    per_order = F.transform(orders, lambda o: F.aggregate(o, start, step, lambda s: s["steps"]))
    return cell.select("part", F.flatten(per_order).alias("steps"))


def merged(arrays: DataFrame) -> DataFrame:
    """``part, steps``: elementwise sums of the arrays of a part.  A part has at most one array
    per mask (32 for five filters)."""
    def plus(a: Column, b: Column) -> Column:
        return F.struct(a["k"].alias("k"), *[(a[m] + b[m]).alias(m) for m in MEASURES])

    return arrays.groupBy("part").agg(F.collect_list("steps").alias("all")).select(
        "part", F.aggregate(F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))),
                            F.col("all")[0], lambda a, b: F.zip_with(a, b, plus)).alias("steps"))


def audit(cell: DataFrame, letters: str) -> DataFrame:
    """``part, filter_order, step, filter`` and the measures with ``shapley`` (what the step's
    filter removes, summed over all orders), from ``cells``.  All steps of all orders of every
    part, zeros included."""
    n = len(letters)

    def removed_by(k: int) -> Column:
        return F.aggregate(F.filter("steps", lambda s: s["k"] == k), F.lit(0).cast("bigint"),
                           lambda total, s: total + s["removed"])

    names = F.array(*[F.lit("".join(letters[k] for k in o)) for o in orders_of(n)])
    both = merged(folded(cell, n)).select(
        "part", "steps", F.array(*[removed_by(k) for k in range(n)]).alias("shares"))
    rows = both.select("part", "shares", F.posexplode("steps").alias("pos", "s"))
    order = F.element_at(names, (F.col("pos") / n).cast("int") + 1)
    return rows.select("part", order.alias("filter_order"), (F.col("pos") % n + 1).alias("step"),
                       F.substring(F.lit(letters), F.col("s.k") + 1, F.lit(1)).alias("filter"),
                       *[F.col(f"s.{m}").alias(m) for m in MEASURES],
                       F.element_at("shares", F.col("s.k") + 1).alias("shapley"))


def audit_documents(documents: DataFrame, labels: DataFrame, part_col: str | None = "lang",
                    id_col: str = "doc_id", text_col: str = "text",
                    label_id: str = "doc_id") -> DataFrame:
    """The audit of filters A to E."""
    filters = text_filters(F.col(TEXT))
    rows = masks(documents, filters, part_col, id_col, text_col)
    cell = cut(cells(flagged(rows, labels, label_id), copy_bit=len(filters)), "filter-cells")
    return audit(cell, "".join(filters) + COPY)


_ORDERS = ", ".join(f"('{''.join(o)}')" for o in permutations("ABCDE"))
ORACLE = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             min(doc_id) OVER (PARTITION BY text) AS low FROM t),
l AS (SELECT doc_id, max(quality) FILTER (quality = 1) AS good, max(toxic) FILTER (toxic = 1) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
             (len(ws) < 200)::INT AS a, (100 * len(list_distinct(ws)) < 50 * len(ws))::INT AS b,
             (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT AS c,
             regexp_matches(text, '[#$%&*|]')::INT AS d, coalesce(doc_id > low, false)::INT AS e
      FROM w LEFT JOIN l USING (doc_id)),
cell AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
         FROM f GROUP BY ALL),
orders AS (SELECT * FROM (VALUES {_ORDERS}) AS o (filter_order)),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
x AS (SELECT cell.*, filter_order, step,
             list_value(a, b, c, d, e) AS m,
             ord(substr(filter_order, step::INT, 1)) - 64 AS k,
             substr(filter_order, 1, step::INT - 1) AS before FROM cell, steps),
y AS (SELECT *, m[k] = 1 AS fails,
             ((contains(before, 'A') AND a = 1) OR (contains(before, 'B') AND b = 1)
              OR (contains(before, 'C') AND c = 1) OR (contains(before, 'D') AND d = 1)
              OR (contains(before, 'E') AND e = 1)) AS gone FROM x),
s AS (SELECT part, filter_order, step, any_value(k) AS k,
             coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept,
             coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
             coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
             coalesce(sum(n) FILTER (fails AND a + b + c + d + e = 1), 0) AS unique_fails,
             coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
      FROM y GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM s
"""


@register("op12_filter_audit", ORACLE)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audit_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.drop("filter")


__all__ = ["text_filters", "masks", "flagged", "cells", "folded", "merged", "audit",
           "audit_documents"]
