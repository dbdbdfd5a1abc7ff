"""Helpers shared by the corpus operators.

Inside an operator the key is ``__id`` (bigint) and the text ``__text`` (never null), so
extra columns of the caller, whatever their names, cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.session import ensure_checkpoint_dir, shared_dir

ID = "__id"
TEXT = "__text"
NO_ID = -2 ** 63               # sorts rows without an id first
LEAST_ID = -2 ** 62            # ids of rows that have none are made below it
FLUSH_ROWS = 400_000           # rows pre-aggregated in a task before they are sent

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def column(name: str) -> Column:
    """A column by its exact name (dots and other marks are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id, __text`` of a documents table; null texts are empty texts."""
    return docs.select(column(id_col).cast("bigint").alias(ID),
                       F.coalesce(column(text_col).cast("string"), F.lit("")).alias(TEXT))


def with_made_ids(docs: DataFrame) -> DataFrame:
    """``keyed`` rows; a row without an id gets one below ``LEAST_ID``, made of its text: rows
    without an id come first, and only those with equal texts share one (as repeated rows
    do)."""
    made = F.lit(NO_ID) + F.pmod(F.xxhash64(TEXT), F.lit(-LEAST_ID))
    # the last value is never taken: it tells the planner that the id is not null, so that inner and
    # outer joins need the same exchange of the texts
    return docs.withColumn(ID, F.coalesce(ID, made, F.lit(NO_ID)))


def without_made_ids(key: str = ID) -> Column:
    """The id, null again if it was made."""
    return F.when(F.col(key) >= LEAST_ID, F.col(key))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here, a lost
    executor cannot force a recomputation, and the size of the table is known to the
    planner (it decides whether a join may broadcast it).  Shuffle files of the write are
    removed when it is done, as nothing will read them again."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def id_bounds(docs: DataFrame, rows: int, most: int = 4096) -> tuple[int | None, list[int]]:
    """Smallest id, and the first ids of the further ranges of about ``rows`` rows each.  The
    list is bounded by ``most``; larger tables get larger ranges."""
    n, low = docs.agg(F.count("*"), F.min(ID)).first()
    parts = min(most, -(-n // rows))
    if parts < 2:
        return low, []
    shares = ", ".join(f"{i / parts:.8f}d" for i in range(1, parts))
    found = docs.agg(F.expr(f"percentile_approx({ID}, array({shares}), {max(10_000, 20 * parts)})"))
    return low, sorted({b for b in found.first()[0] if b > low})


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range that holds a key."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in bounds]),
                           lambda b: b <= key))


def small_batches(spark: SparkSession, rows: int = 128) -> None:
    """Bound the rows of an Arrow batch, as rows hold whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def first_rows(values):
    """Index of the first occurrence of every distinct value."""
    return np.sort(np.unique(values, return_index=True)[1])


def owners(rows: DataFrame, value: str, *also: str) -> DataFrame:
    """``g, value, owner``: the smallest id of each pair.  ``rows`` are pre-aggregated per task;
    they go by ``g`` so that what shares it is together for the next step."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "g").groupBy("g", value)
            .agg(F.min("owner").alias("owner"), *[F.min(c).alias(c) for c in also]))


def sender(names: list[str]):
    """Collects rows ``g, value, owner, ...`` and sends each pair of the first two once per flush."""
    held: list = []

    def flush():
        cols = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        order = np.lexsort((cols[2], cols[0], cols[1]))
        cols = [c[order] for c in cols]
        new = np.ones(len(order), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        return pa.RecordBatch.from_arrays([pa.array(c[new]) for c in cols], names)

    return held, flush


__all__ = ["ID", "TEXT", "NO_ID", "QUERIES", "ORACLES", "register", "load", "column", "keyed",
           "with_made_ids", "without_made_ids",
           "cut", "id_bounds", "bucket_of", "small_batches", "first_rows",
           "owners", "sender", "FLUSH_ROWS", "ensure_checkpoint_dir", "shared_dir"]
