"""Near-duplicate documents from bottom-k sketches of one hash function.

1. Every text's set of five-word shingles is hashed (64 bits).  Texts with the same set are
   one class (128-bit digest of the set); the class stands for its copies from here on.
2. The k smallest hashes of a class are its sketch.  Two sets with similarity ``t`` share at
   least ``c`` of their sketch values (c is so low that missing it has a probability below 1e-7
   for long texts, and certain for sets that fit into the sketch), so they meet in an inverted list
   of one of their ``size - c + 1`` globally rarest values; other values get no list.
3. A list of at most ``SMALL_LIST`` classes gives its pairs.  In a longer list (a family of
   near copies) the class with the fewest shingles of its own is the centre ``c`` and is compared
   with each member, first dropping members whose own shingles (in no other class of such lists)
   are too many for any link.  Let X fail against c.  A link X - Y then needs a shared
   shingle outside c, or a Y smaller than c with both overlaps with c large: if X and Y shared only
   shingles of c and Y were not smaller, Y could not be nearer to X than c is.  So the next
   lists are the shingles outside c shared by members of different components, one of
   them failed; they are short, or they are families in turn and get a centre of their own.  This is
   exact, and linear in the family instead of quadratic.
4. The sketch of the union estimates the similarity of a pair; hopeless pairs are dropped (the
   threshold loses a link with a probability below 1e-6).
5. The rest is verified on the full shingle sets of the whole texts.
6. Components of the links by star contraction.

A node of the links is a class, not an id, so rows that share an id but not the text are compared
each with its own text.  A class goes by a number, given when the table of classes is written; its
text is that of its first row, found by id and a 128-bit digest of the text.

Defined results: null, empty or blank texts have no shingles and are linked with nothing; texts
of one to four words have one shingle, the whole word sequence; whole texts are read, whatever their
length.  ``near_duplicates`` speaks of ids: an id with several texts links what any of them links,
repeated rows repeat the same result, rows without an id are linked with nothing (component null,
kept).  ``deduplicate`` speaks of rows: each row is a document of its own, also without an id or
with one that others have; of a group of near copies the row with the smallest id stays (rows without
one come last, then by the digest of the text), of rows equal in id and text the one whose other
columns have the smallest digest.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewise.llm.common import ID, TEXT, column, cut, keyed, load, register, small_batches
from tablewise.llm.components import components

WORDS = 5
SKETCH = 32
SHARED = 12               # sketch values that two sets of similarity 0.8 share, and far more
SMALL_LIST = 32
DEEP_LIST = 256           # the same for the lists inside a family, which have stricter conditions
ESTIMATE = 0.4            # pairs estimated below this are dropped
FAMILY_DEPTH = 4          # rounds of centres before the rest of a family is paired
CENTRE_ROWS = 512         # pairs of one centre that one task verifies
MEMO = 200_000
TEXT_KEYS = ["t1", "t2"]  # digest of a text
SET_KEYS = ["c1", "c2", "n"]          # digest and size of a shingle set: a class


def shingler(words: int = WORDS):
    """``text -> sorted distinct 64-bit hashes`` of the shingles; A-Z are lower-cased, words are
    separated by ASCII white space."""
    import xxhash
    digest = xxhash.xxh3_64_intdigest
    memo: dict[bytes, int] = {}
    factor = np.uint64(0x9E3779B97F4A7C15)

    def mix(x):
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))

    def shingles(text: str) -> np.ndarray:
        parts = text.encode().lower().split()
        if not parts:
            return np.empty(0, np.int64)
        if len(memo) > MEMO:
            memo.clear()
        hashes = []
        for w in parts:
            h = memo.get(w)
            if h is None:
                h = memo[w] = digest(w)
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        size = min(words, len(h))
        n = len(h) - size + 1
        out = np.full(n, size, np.uint64)
        for i in range(size):
            out = out * factor + h[i:i + n]
        return np.unique(mix(out).view(np.int64))

    return shingles


def sketches(docs: DataFrame, words: int = WORDS, k: int = SKETCH) -> DataFrame:
    """``__id, t1, t2, n, c1, c2, sketch`` per row: digest of the text, size of the shingle set, its
    digest, and its k smallest hashes."""
    def run(batches):
        shingles = shingler(words)
        for b in batches:
            n, c1, c2, low = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingles(text)
                u = s.view(np.uint64)
                n.append(len(s))
                c1.append(int(u.sum().view(np.int64)) if len(s) else 0)
                u = (u ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0xE7037ED1A0B428DB)
                c2.append(int((u ^ (u >> np.uint64(29))).sum().view(np.int64)) if len(s) else 0)
                low.append(s[:k])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(n, pa.int64()),
                 pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                 pa.array(low, pa.list_(pa.int64()))],
                [ID, *TEXT_KEYS, *SET_KEYS[2:], *SET_KEYS[:2], "sketch"])

    return with_text_keys(docs.select(ID, TEXT)).mapInArrow(
        run, f"{ID} bigint, t1 bigint, t2 bigint, n bigint, c1 bigint, c2 bigint, "
             "sketch array<bigint>")


def with_text_keys(docs: DataFrame) -> DataFrame:
    """Adds the digest ``t1, t2`` of the text: two hashes with different seeds."""
    return docs.withColumn("t1", F.xxhash64(TEXT)).withColumn("t2", F.xxhash64(F.lit(1), TEXT))


def same_rows(a: DataFrame, b: DataFrame, names: dict[str, str]) -> Column:
    """Join condition: the named columns of ``a`` and ``b`` are equal, nulls too."""
    found = [a[x].eqNullSafe(b[y]) for x, y in names.items()]
    return reduce(lambda x, y: x & y, found)


class ClassTexts:
    """Texts of classes by their numbers.  ``wanted`` are the numbers ``__id`` of all classes that
    will be asked for: their texts are fetched from the documents once and written."""

    def __init__(self, docs: DataFrame, classes: DataFrame, wanted: DataFrame):
        docs = with_text_keys(docs)
        keys = (classes.join(wanted, classes.rep == wanted[ID])
                .select(F.col("rep").alias("k"), F.col("first.id").alias("kid"),
                        F.col("first.t1").alias("k1"), F.col("first.t2").alias("k2")))
        names = {ID: "kid", "t1": "k1", "t2": "k2"}
        # by one plan at every size, as the keys of a large corpus are too many to broadcast
        self.texts = cut(docs.join(keys.hint("merge"), same_rows(docs, keys, names))
                         .select(F.col("k").alias(ID), TEXT), "minhash-wanted")

    def of(self, ids: DataFrame) -> DataFrame:
        """``__id, __text`` for every class number ``__id`` of ``ids`` (repeated rows repeat it)."""
        return self.texts.join(ids, ID)


def estimate(a: str, b: str, k: int = SKETCH):
    """Similarity estimated on the bottom-k sketch of the union."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect(union, F.col(a)), F.col(b)))
    return shared / F.size(union)


def inverted_lists(reps: DataFrame, percent: int, k: int = SKETCH,
                   shared: int = SHARED) -> DataFrame:
    """``v, __id, n, length`` for the prefix values of every class (see step 2)."""
    rows = reps.select(ID, "n", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
    often = rows.groupBy("v").agg(F.count("*").alias("often")).where("often > 1")
    rows = rows.join(often, "v")
    need = F.least(F.lit(shared), F.expr(f"cast(ceil({percent} * size / 100) as int)"))
    rare = Window.partitionBy(ID).orderBy("often", "v")
    rows = (rows.withColumn("rank", F.row_number().over(rare))
            .withColumn("met", F.count("*").over(Window.partitionBy(ID)))
            # values that no other class has come first in the order of rarity
            .where(F.col("rank") <= F.col("size") - need + 1 - (F.col("size") - F.col("met")))
            .select("v", ID, "n"))
    rows = cut(rows, "minhash-lists")
    length = rows.groupBy("v").agg(F.count("*").alias("length")).where("length > 1")
    return cut(rows.join(length, "v"), "minhash-lists")


def shared_sizes(docs: ClassTexts, ids: DataFrame, words: int) -> DataFrame:
    """``__id, u``: how many shingles of each class of ``ids`` occur in another one of them."""
    def explode(batches):
        shingles = shingler(words)
        for b in batches:
            found = [shingles(t) for t in b.column(1).to_pylist()]
            every = np.concatenate(found) if found else np.empty(0, np.int64)
            owner = np.repeat(np.array(b.column(0).to_pylist(), np.int64), [len(f) for f in found])
            value, first, n = np.unique(every, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value), pa.array(owner[first]), pa.array(n)], ["s", "owner", "n"])

    single = (docs.of(ids.select(ID))
              .mapInArrow(explode, "s bigint, owner bigint, n bigint")
              .groupBy("s").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))
              .where("n = 1").groupBy(F.col("owner").alias(ID)).agg(F.count("*").alias("own")))
    return ids.join(single, ID, "left").select(
        ID, (F.col("n") - F.coalesce("own", F.lit(0))).alias("u"))


def compared(pairs: DataFrame, docs: ClassTexts, words: int, extras: bool = False) -> DataFrame:
    """``a, b, na, nb, both`` on the full shingle sets of the pairs' texts; ``extras`` adds the
    shingles of b that a does not have."""
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias(ID)).distinct(), "minhash-ids")
    texts = cut(docs.of(ids).groupBy(ID).agg(F.min(TEXT).alias(TEXT)), "minhash-texts")
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a centre with many members is copied to several tasks, each with a share of them
    parts = (pairs.groupBy("a").agg(F.count("*").alias("n"))
             .select("a", F.ceil(F.col("n") / CENTRE_ROWS).cast("int").alias("parts")))
    left = (parts.join(texts.select(F.col(ID).alias("a"), F.col(TEXT).alias("ta")), "a")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("a", "part", "ta"))
    right = (pairs.join(parts, "a")
             .withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
             .select("a", "part", "b").repartition(tasks, "a", "part")
             .join(texts.select(F.col(ID).alias("b"), F.col(TEXT).alias("tb")), "b"))

    def check(batches):
        shingles = shingler(words)
        last_text, last = None, None
        for batch in batches:
            na, nb, both, extra = [], [], [], []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if ta != last_text:
                    last_text, last = ta, shingles(ta)
                other = shingles(tb)
                na.append(len(last))
                nb.append(len(other))
                both.append(len(np.intersect1d(last, other, assume_unique=True)))
                if extras:
                    extra.append(np.setdiff1d(other, last, assume_unique=True))
            arrays = [batch.column(0), batch.column(1), pa.array(na, pa.int64()),
                      pa.array(nb, pa.int64()), pa.array(both, pa.int64())]
            if extras:
                arrays.append(pa.array(extra, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, columns)

    schema = ("a bigint, b bigint, na bigint, nb bigint, both bigint"
              + ", extra array<bigint>" * extras)
    columns = [c.split()[0] for c in schema.split(", ")]
    return right.join(left, ["a", "part"]).select("a", "b", "ta", "tb").mapInArrow(check, schema)


def is_link(percent: int):
    return F.expr(f"100 * both >= {percent} * (na + nb - both)")


def verified(pairs: DataFrame, docs: ClassTexts, reps: DataFrame, percent: int,
             words: int) -> DataFrame:
    """The pairs ``(a, b)`` that are links: union-sketch estimate, then the full sets."""
    one, two = (reps.select(F.col(ID).alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab")
    hopeful = cut(pairs.distinct().join(one, "a").join(two, "b")
                  .where(estimate("sa", "sb") >= bounds(percent)[1]).select("a", "b"), "minhash-pairs")
    return cut(compared(hopeful, docs, words).where(is_link(percent)).select("a", "b"),
               "minhash-links")


def pairs_within(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of the members ``key, __id, n, most, component, failed`` of short lists: sizes allow
    a link, components differ, one of the two failed against its centre."""
    other = lists.select("key", F.col(ID).alias("b"), F.col("n").alias("nb"),
                         F.col("most").alias("mb"), F.col("component").alias("cb"),
                         F.col("failed").alias("fb"))
    return (lists.join(other, "key")
            .where(f"{ID} < b and component <> cb and (failed or fb) and nb <= most and n <= mb "
                   f"and 100 * least(n, nb) >= {percent} * greatest(n, nb)")
            .select(F.col(ID).alias("a"), "b"))


def family_links(members: DataFrame, links: DataFrame, docs: ClassTexts, reps: DataFrame,
                 percent: int, words: int) -> DataFrame:
    """Links among the ``members(key, __id, n, own, most)`` of long lists (see step 3), added to
    ``links``; only links between different components are looked for."""
    sizes = members.select(F.col(ID).alias("b"), "most").distinct()
    members = members.withColumn("failed", F.lit(True))
    for depth in range(FAMILY_DEPTH):
        best = F.min(F.struct((~F.col("failed")).alias("late"), "own", F.col(ID).alias("a")))
        centre = members.groupBy("key").agg(best.alias("c"))
        # lists with a common member take the better centre of the two (it need not be in a list
        # to be compared with all of it), so a family has one centre and not one per list
        mine = members.join(centre, "key").groupBy(ID).agg(F.min("c").alias("c"))
        centre = (members.select("key", ID).join(mine, ID).groupBy("key")
                  .agg(F.min("c").alias("c")).select("key", F.col("c.a").alias("a")))
        star = (members.join(centre, "key").where(f"{ID} <> a")
                .select("a", F.col(ID).alias("b")).distinct())
        star = cut(compared(cut(star, "minhash-star"), docs, words, extras=True)
                   .withColumn("failed", ~is_link(percent)), "minhash-star")
        links = links.unionByName(star.where("not failed").select("a", "b"))
        found = components(links).withColumnRenamed("node", "b")
        star = cut(star.join(found, "b", "left").join(sizes, "b")
                   .withColumn("component", F.coalesce("component", "b")), "minhash-star")

        # smaller than the centre, and both overlap with it enough
        small = (star.where(f"failed and 100 * both >= {percent} * nb")
                 .withColumn("high", F.expr(f"cast(floor(both * {100 + percent} / {percent} "
                                            "- nb + 1e-9) as bigint)"))
                 .withColumn("high", F.least("high", "most"))
                 .withColumn("low", F.expr(f"cast(ceil({percent} * nb / 100) as bigint)"))
                 .where("high >= low")
                 .select("a", "b", "nb", "both", "component",
                         F.explode(F.sequence("low", "high")).alias("ny")))
        other = star.select("a", F.col("b").alias("y"), F.col("nb").alias("ny"),
                            F.col("both").alias("by"), F.col("most").alias("my"),
                            F.col("component").alias("cy"))
        smaller = (small.join(other, ["a", "ny"])
                   .where(f"component <> cy and nb <= my "
                          f"and by * {100 + percent} >= {percent} * (nb + ny)")
                   .select(F.least("b", "y").alias("a"), F.greatest("b", "y").alias("b")))

        # shingles outside the centre
        rows = (star.select("a", "b", "nb", "most", "component", "failed",
                            F.size("extra").cast("bigint").alias("own"),
                            F.explode("extra").alias("s"))
                .select(F.struct("a", "s").alias("key"), F.col("b").alias(ID),
                        F.col("nb").alias("n"), "own", "most", "component", "failed"))
        keys = (rows.groupBy("key").agg(F.count("*").alias("length"), F.max("failed").alias("f"),
                                        F.min("component").alias("c0"),
                                        F.max("component").alias("c1"))
                .where("length > 1 and f and c0 < c1").select("key", "length"))
        rows = cut(rows.join(keys, "key"), "minhash-lists")
        short = pairs_within(rows.where(F.col("length") <= DEEP_LIST).drop("length"), percent)
        links = links.unionByName(verified(
            cut(short.unionByName(smaller), "minhash-candidates"), docs, reps, percent, words))
        members = rows.where(F.col("length") > DEEP_LIST).drop("length")
        if members.isEmpty():
            return links
    # families nested deeper than FAMILY_DEPTH: what failed against everything else
    found = components(links).withColumnRenamed("node", ID)
    members = (members.drop("component").join(found, ID, "left")
               .withColumn("component", F.coalesce("component", ID)))
    return links.unionByName(verified(cut(pairs_within(members, percent), "minhash-candidates"),
                                      docs, reps, percent, words))


def class_components(docs: DataFrame, rows: DataFrame, percent: int,
                     words: int) -> tuple[DataFrame, DataFrame]:
    """Classes ``c1, c2, n, first, rep`` of the ``rows`` (written ``sketches`` with shingles) and
    the links' components ``node, component`` among their numbers ``rep``.  ``first`` is the
    class's first row ``(none, id, t1, t2)``: ids before missing ones, the smallest first."""
    shared, _ = bounds(percent)
    first = F.struct(F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), *TEXT_KEYS)
    classes = cut(rows.groupBy(*SET_KEYS).agg(F.min(first).alias("first"))
                  .withColumn("rep", F.monotonically_increasing_id()), "minhash-classes")
    one = F.col("first.id").eqNullSafe(F.col(ID)) & (F.col("first.t1") == F.col("t1")) & (
        F.col("first.t2") == F.col("t2"))
    reps = cut(rows.join(classes, SET_KEYS).where(one).dropDuplicates(["rep"])
               .select(F.col("rep").alias(ID), "n", "sketch"), "minhash-reps")

    lists = inverted_lists(reps, percent, shared=shared)
    # only classes in these lists are ever compared
    texts = ClassTexts(docs, classes, lists.select(ID).distinct())
    alone = F.col(ID).alias("component")
    few = (lists.where(F.col("length") <= SMALL_LIST)
           .select(F.col("v").alias("key"), ID, "n", F.lit(2 ** 62).alias("most"), alone,
                   F.lit(True).alias("failed")))
    links = verified(cut(pairs_within(few, percent), "minhash-candidates"), texts, reps,
                     percent, words)
    long = lists.where(F.col("length") > SMALL_LIST).select(F.col("v").alias("key"), ID, "n")
    family = cut(long.groupBy(ID).agg(F.min("n").alias("n")), "minhash-family")
    if not family.isEmpty():
        # the largest set that a class can still be linked to
        most = F.floor(F.col("u") * (100 + percent) / percent - F.col("n") + 1e-9)
        long = (long.join(shared_sizes(texts, family, words), ID)
                .where(most * 100 >= F.col("n") * percent)
                .withColumn("most", most.cast("bigint"))
                .withColumn("own", F.col("n") - F.col("u")).drop("u"))
        links = family_links(cut(long, "minhash-long"), links, texts, reps, percent, words)
    return classes, components(links)


def firsts_of(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``c1, c2, n, rep, lead``: the first row of all classes in a class's component."""
    found = found.withColumnRenamed("node", "rep")
    lead = (found.join(classes, "rep").groupBy("component").agg(F.min("first").alias("lead"))
            .join(found, "component").select("rep", "lead"))
    return (classes.join(lead, "rep", "left")
            .select(*SET_KEYS, "rep", F.coalesce("lead", "first").alias("lead")))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 80, words: int = WORDS) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row; documents are linked at a
    Jaccard similarity of ``percent`` / 100 or more on their shingle sets (a percent that the
    sketch cannot see, below 40, is an error)."""
    bounds(percent)
    small_batches(documents.sparkSession)
    docs = keyed(documents, id_col, text_col)
    rows = cut(sketches(docs, words), "minhash-sketches")
    known = rows.where(f"n > 0 and {ID} is not null")
    classes, found = class_components(docs, known, percent, words)

    members = known.select(ID, *SET_KEYS).join(classes, SET_KEYS).select(ID, "rep")
    # an id with several texts links their classes
    several = cut(members.groupBy(ID).agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
                  .where("a < b"), "minhash-several")
    if not several.isEmpty():
        joint = members.join(several, ID).where("rep <> a").select("a", F.col("rep").alias("b"))
        found = components(found.select(F.col("component").alias("a"), F.col("node").alias("b"))
                           .unionByName(joint))
    groups = (members.join(firsts_of(classes, found).select("rep", "lead"), "rep")
              .groupBy(ID).agg(F.min("lead.id").alias("component")))
    out = (rows.select(ID, "n").join(groups, ID, "left")
           .withColumn("component", F.coalesce("component", ID)))
    return out.select(F.col(ID).alias(id_col), F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"),
                      F.coalesce(F.col(ID) == F.col("component"), F.lit(True)).alias("kept"))


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                percent: int = 80, words: int = WORDS) -> DataFrame:
    """The rows of ``documents`` without near copies: one row of each group stays.  Rows are
    told apart by id and text, so a row goes by its own text and not by what shares its id."""
    bounds(percent)
    small_batches(documents.sparkSession)
    docs = keyed(documents, id_col, text_col)
    rows = cut(sketches(docs, words), "minhash-sketches").where("n > 0")
    classes, found = class_components(docs, rows, percent, words)

    keys = ["kid", "k1", "k2"]
    rows = (rows.join(firsts_of(classes, found), SET_KEYS)
            .select(F.col(ID).alias("kid"), F.col("t1").alias("k1"), F.col("t2").alias("k2"), "lead"))
    leads = (F.col("lead.id").eqNullSafe(F.col("kid")) & (F.col("lead.t1") == F.col("k1"))
             & (F.col("lead.t2") == F.col("k2")))
    counted = rows.groupBy(*keys).agg(F.min(leads).alias("leads"), F.count("*").alias("times"))
    counted = cut(counted.where("not leads or times > 1"), "minhash-rows")

    mark = "_" * (1 + max(map(len, documents.columns)))       # no column of theirs
    own = {c: f"{mark}{c}" for c in keys}
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    marked = (documents.withColumn(own["kid"], column(id_col).cast("bigint"))
              .withColumn(own["k1"], F.xxhash64(text)).withColumn(own["k2"], F.xxhash64(F.lit(1), text)))

    def condition(found: DataFrame, rows: DataFrame = marked) -> Column:
        return same_rows(rows, found, {own[c]: c for c in keys})

    copies = counted.where("not leads").select(*keys)
    out = marked.join(copies, condition(copies), "left_anti")
    repeated = counted.where("leads").select(*keys)
    if repeated.isEmpty():
        return out.drop(*own.values())
    once = out.join(repeated, condition(repeated), "left_anti")
    again = out.join(repeated, condition(repeated), "left_semi").withColumn(
        mark, F.xxhash64(F.to_json(F.struct(*[column(c) for c in documents.columns if c != text_col]))))
    least = again.groupBy(*own.values()).agg(F.min(mark).alias("least")).select(
        *[F.col(own[c]).alias(c) for c in keys], "least")
    again = (again.join(least, condition(least, again) & (again[mark] == least["least"]),
                        "left_semi").dropDuplicates([*own.values()]))
    return once.unionByName(again.drop(mark)).drop(*own.values())


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(
         range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents
      UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
g AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM g LEFT JOIN n USING (doc_id)
"""


@register("op10_minhash_dedup", ORACLE)
def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), percent=85)


def miss_probability(t: float, k: int = SKETCH, shared: int = SHARED) -> float:
    """Chance that two long sets of similarity ``t`` share fewer than ``shared`` values of the
    union's sketch."""
    return sum(math.comb(k, i) * t ** i * (1 - t) ** (k - i) for i in range(shared))


def bounds(percent: int) -> tuple[int, float]:
    """Shared sketch values and estimate that a link of ``percent`` / 100 falls below with a
    probability of less than 1e-7 (80 and more: SHARED and ESTIMATE)."""
    if percent >= 80:
        return SHARED, ESTIMATE
    safe = [c for c in range(1, SHARED + 1) if miss_probability(percent / 100, shared=c) < 1e-7]
    if not safe:
        raise ValueError(f"percent {percent}: a sketch of {SKETCH} values would miss links")
    return safe[-1], min(ESTIMATE, safe[-1] / SKETCH)


__all__ = ["near_duplicates", "deduplicate", "sketches", "shingler", "estimate", "miss_probability"]
