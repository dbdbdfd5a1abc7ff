"""Sampling and splitting.

``sample_by_class``   per-class sample in one pass (F1-F3)
``stratified_split``  exact per-class test share without a global sort (F4)
``bounded_sample``    the ``n`` rows with the smallest hash: a top-k, bounded memory (F5)

Unions (F2, F6) are ``unionByName`` and caching (F7) is ``persist`` / ``unpersist`` where the jobs
need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewise.functions.hashing import portable_hash, row_key, unit_hash
from tablewise.operators.profile import qcol
from tablewise.session import written

SMALL_CLASSES = 100_000     # per-class tables of at most so many rows are broadcast
SALTS = 64                  # larger ones are joined with a salt
COPIES_BLOCK = 100_000      # equal rows written by one task


def sample_by_class(df: DataFrame, label_col: str = "label", fraction=0.5, seed: int = 42,
                    method: str = "hash", key=None) -> DataFrame:
    """keep each row of class ``c`` with probability ``fraction[c]`` (or one fraction).

    ``method="bernoulli"`` uses Spark's ``sampleBy`` (seeded, Spark-only);
    ``method="hash"`` keeps rows with ``unit_hash(key) < fraction`` - the same rows on every
    run and engine.  Both are one narrow pass (the reference filtered, sampled and
    counted each class separately).  A fraction >= 1 keeps the class whole.
    """
    classes = None
    if isinstance(fraction, dict):
        classes = {k: float(v) for k, v in fraction.items()}
    if method == "bernoulli":
        if classes is not None:
            return df.sampleBy(label_col, {k: min(v, 1.0) for k, v in classes.items()}, seed)
        # one fraction for all classes: no list of classes is needed
        return df if float(fraction) >= 1.0 else df.sample(float(fraction), seed)
    if key is None:
        raise ValueError("hash sampling needs a key column")
    u = unit_hash(key_text(df, key), f"sample:{seed}")
    if classes is None:
        frac = float(fraction)
        return df if frac >= 1.0 else df.filter(u < F.lit(frac))
    lab = qcol(label_col)
    thr = None
    for k, v in classes.items():
        thr = (F.when(lab == F.lit(k), F.lit(v)) if thr is None
               else thr.when(lab == F.lit(k), F.lit(v)))
    thr = thr.otherwise(F.lit(1.0))
    return df.filter((thr >= F.lit(1.0)) | (u < thr))


def key_text(df: DataFrame, key) -> Column:
    """The key as text, never null: a row without a key is identified by its content."""
    c = qcol(key) if isinstance(key, str) else key
    return F.coalesce(c.cast("string"), F.concat(F.lit("null|"), row_key(
        *[qcol(x) for x in df.columns])))


def content_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[qcol(c) for c in df.columns])


def stratified_split(df: DataFrame, label_col: str, key: str, test_share: float = 0.2,
                     seed: int = 42, out_col: str = "is_test") -> DataFrame:
    """mark ``round(n_c * test_share)`` rows of each class ``c`` as test rows.

    The test rows of a class are the first ones in the order ``(hash of the key, key, hash of
    the content)``, at every size and under any partitioning; rows without a key are ordered by
    their content.  There is no global sort, and no task ranks a class or a group of copies:

    1. rows per (class, upper 16 bits of the hash), a map-side combined count; the entry at
       which the running count reaches the quota is the class's boundary, and only its
       rows are looked at further;
    2. they are refined by the next part of the order (lower 16 bits, key, then the content
       hash in parts of 16 bits) until the boundary entry of every class is needed as a whole or
       consists of equal rows: each step counts at most 65,536 entries a class;
    3. one pass compares each row with its class's boundary.  Of equal rows at the boundary
       the needed number is test: they are counted and written out again, as they are
       interchangeable.

    The boundary table has one row per class.  It is written to the shared folder and joined; it
    is broadcast when it has at most ``SMALL_CLASSES`` rows, else joined with a salt, so that a
    large class does not meet in one task.
    """
    h = portable_hash(key_text(df, key), f"split:{seed}")
    base = df.withColumns({"_lab": qcol(label_col), "_h": h, "_k": key_text(df, key),
                           "_r": content_hash(df)})
    parts = [F.shiftright("_h", 16), F.col("_h").bitwiseAND(F.lit(0xFFFF)), F.col("_k")] + [
        F.shiftright("_r", s).bitwiseAND(F.lit(0xFFFF)) for s in (48, 32, 16, 0)]
    # the last 64 bits are compared as unsigned parts, so the order is the same in step 3
    names = [f"_p{i}" for i in range(len(parts))]

    counts = base.groupBy("_lab", parts[0].alias("_p")).agg(F.count(F.lit(1)).alias("_cnt"))
    total = F.sum("_cnt").over(Window.partitionBy("_lab"))
    counts = counts.withColumn("_need", F.round(total * F.lit(float(test_share))).cast("bigint"))
    edge = written(_boundary(counts).withColumnRenamed("_p", names[0]), "split")
    for i in range(1, len(parts)):
        if edge.where("_need < _cnt").isEmpty():
            break
        # classes that are not settled yet: the rows of their boundary entry
        open_ = edge.where("_need < _cnt").select(F.col("_lab").alias("_c"), *names[:i], "_need")
        rows = base.select("_lab", *[p.alias(n) for p, n in zip(parts[:i + 1], names)])
        rows = _with_class(rows, open_, names[:i])
        counts = rows.groupBy("_lab", *names[:i], "_need", F.col(names[i]).alias("_p")).agg(
            F.count(F.lit(1)).alias("_cnt"))
        fine = _boundary(counts, names[:i]).withColumnRenamed("_p", names[i])
        settled = edge.where("_need >= _cnt").withColumn(
            names[i], F.lit(None).cast(fine.schema[names[i]].dataType))
        edge = written(settled.unionByName(fine), "split")
    used = [n for n in names if n in edge.columns]

    rows = base.withColumns(dict(zip(used, parts)))
    rows = _with_class(rows, edge.select(F.col("_lab").alias("_c"), "_need", "_cnt", *[
        F.col(n).alias("_b" + n) for n in used]), [], how="left")
    before, same = F.lit(False), F.lit(True)
    for n in used:
        cut = F.col("_b" + n)
        before = before | (same & cut.isNotNull() & (F.col(n) < cut))
        same = same & (cut.isNull() | (F.col(n) == cut))
    has = F.col("_need").isNotNull()
    rows = rows.withColumns({"_before": F.coalesce(has & before, F.lit(False)),
                             "_same": F.coalesce(has & same, F.lit(False))})
    whole = F.col("_same") & (F.col("_need") >= F.col("_cnt"))
    split = F.col("_same") & (F.col("_need") < F.col("_cnt"))
    out = rows.where(~split).withColumn(out_col, F.col("_before") | whole)
    if edge.where("_need < _cnt").isEmpty():
        return out.select(*[qcol(c) for c in df.columns], qcol(out_col))
    equal = (rows.where(split).groupBy("_lab", "_need")
             .agg(F.first(F.struct(*[qcol(c) for c in df.columns])).alias("_row"),
                  F.count(F.lit(1)).alias("_n")))
    # n equal rows again, in blocks that different tasks write
    equal = (equal.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_n") - 1,
                                                             F.lit(COPIES_BLOCK))))
             .repartition("_block")
             .withColumn("_i", F.explode(F.sequence(
                 "_block", F.least(F.col("_block") + COPIES_BLOCK, F.col("_n")) - 1)))
             .withColumn(out_col, F.col("_i") < F.col("_need")))
    names_out = [F.col("_row").getField(c).alias(c) for c in df.columns]
    return (out.select(*[qcol(c) for c in df.columns], qcol(out_col))
            .unionByName(equal.select(*names_out, qcol(out_col))))


def _with_class(rows: DataFrame, classes: DataFrame, on: list, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their class (``_lab`` = ``_c``, null-safe) and equal ``on``."""
    classes = classes.withColumnsRenamed({n: "_on" + n for n in on})
    match = F.col("_lab").eqNullSafe(F.col("_c"))
    for n in on:
        match = match & (F.col(n) == F.col("_on" + n))
    if classes.count() <= SMALL_CLASSES:
        joined = rows.join(F.broadcast(classes), match, how)
    else:
        salted = classes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("_s", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, match & (F.col("_s") == F.col("_salt")), how).drop("_s", "_salt")
    return joined.drop("_c", *["_on" + n for n in on])


def _boundary(counts: DataFrame, group=()) -> DataFrame:
    """Per class on a counts table ``_lab, *group, _need, _p, _cnt``: the first entry ``_p``
    whose running count reaches ``_need``, with what is still needed of it as ``_need``.
    Classes that need no row get none."""
    run = Window.partitionBy("_lab").orderBy("_p").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    c = counts.withColumn("_cum", F.sum("_cnt").over(run))
    hit = c.where((F.col("_need") > 0) & (F.col("_cum") >= F.col("_need"))
                  & (F.col("_cum") - F.col("_cnt") < F.col("_need")))
    return hit.select("_lab", *group, "_p", "_cnt",
                      (F.col("_need") - F.col("_cum") + F.col("_cnt")).alias("_need"))


def bounded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """the ``min(n, rows)`` rows with the smallest ``(hash(key), key)``; rows sharing
    a key, and rows without one, are ordered by their content, so the sample is the same on
    every run.

    Planned as ``TakeOrderedAndProject``: each task keeps its own ``n`` best rows, so
    memory is bounded by ``n`` whatever the table size.
    """
    k = key_text(df, key)
    return (df.withColumns({"_h": portable_hash(k, f"bounded:{seed}"), "_k": k,
                            "_r": content_hash(df)})
            .orderBy("_h", "_k", "_r").limit(int(n)).drop("_h", "_k", "_r"))


__all__ = ["sample_by_class", "stratified_split", "bounded_sample", "key_text", "content_hash"]
