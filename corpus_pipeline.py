"""Training-data pipeline over ``documents``.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns
the rows it keeps (the last one: what it makes of them).  Every stage's result is written as
Parquet to the shared folder and read again as the next stage's ``docs``, so a lost executor
never reaches back over a stage.  Extra columns of ``docs`` are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm import bpe, decontaminate, minhash_dedup, suffix_dedup, toxicity
from tablewise.llm.common import cut, load

TEXT = "text"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    score = "toxicity" + "_" * max(map(len, docs.columns))         # not a name of theirs
    scored = toxicity.with_score(docs, model, out_col=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8 and more) stays: the one with
    the smallest id.  Each row is a document: rows that share an id but not the text are judged
    apart, rows without an id too."""
    return minhash_dedup.deduplicate(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that starts earlier go; all rows stay.  Characters
    that lose some of their bytes go whole, and ``n_chars`` follows the text."""
    others = [c for c in docs.columns if c != TEXT]
    empty = "no_text" + "_" * max(map(len, docs.columns))        # not a name of theirs
    out = suffix_dedup.deduplicate(docs.withColumn(empty, F.col(TEXT).isNull()), with_kept=True,
                                   carry=(*others, empty))
    text = F.when(~F.col(f"row.{empty}"), F.col("kept_text"))
    kinds = dict(docs.dtypes)

    def column(name: str):
        if name == TEXT:
            return text.alias(TEXT)
        old = F.col(f"row.`{name}`")
        if name == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length(text)).otherwise(old).cast(
                kinds[name]).alias(name)
        return old.alias(name)

    return out.select(*[column(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with an id or without."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes."""
    path, pattern = bpe.default_rank_file()
    return bpe.round_trip(docs, path, pattern, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]

# a learnt score, byte strings and BPE merges are beyond SQL; the tests compare by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
