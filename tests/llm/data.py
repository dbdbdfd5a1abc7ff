"""Small inputs shared by the tests of the corpus operators."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["ta", "ri", "mo", "ne", "lu", "ka", "so", "vi", "é", "ßu", "日本"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
                    + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(words))


def edge_rows():
    """Null and empty values, repeated rows, one id with two texts, copies, very long texts."""
    base, long = prose(1, 200), prose(2, 30_000)
    texts = [(0, base), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"),
             (7, base), (8, base.upper()), (9, prose(3, 40) + " " + base), (10, long),
             (11, prose(4, 20) + long[:50_000]), (12, "a" * 5_000), (13, "ab" * 4_000),
             (14, base.replace("ta", "to", 1)), (20, "tail"), (20, "tail"), (21, prose(5, 30)),
             (21, prose(6, 30)), (None, base), (None, None), (40, "\x00 x  \x1c y")]
    return [(i, t, None if i == 4 else "en", None if i == 5 else "src1",
             None if t is None else len(t)) for i, t in texts]


def edge_docs(spark, clash: bool = True):
    """The rows above, dealt over several partitions, with columns that clash with the
    operators' own names."""
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    for name in ("__id", "__text", "n", "key", "owner", "g", "e", "component", "range") * clash:
        df = df.withColumn(name, F.lit(name))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
