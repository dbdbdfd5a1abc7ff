import re

from pyspark.sql import functions as F

from tablewise.llm import decontaminate as op
from tests.llm.data import edge_docs, empty_docs, prose

ITEMS = "item_id long, text string"


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def runs(text, size):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(docs, items, percent=80):
    out = {}
    for d, t in docs:
        for i, x in items:
            s, held = shingles(x), shingles(t)
            few = re.findall(r"[^\W_]+", (x or "").lower())
            if 0 < len(few) < 5:
                s, held = {tuple(few)}, runs(t, len(few))
            c = len(s & held)
            if s and 100 * c >= percent * len(s):
                best = (c / len(s), len(s), c)
                out[(d, i)] = max(out.get((d, i), best), best)
    return out


def run(docs, items, **kw):
    return {(r.doc_id, r.item_id): (r.containment, r.n_item, r.n_common)
            for r in op.contained_items(docs, items, **kw).collect()}


def test_against_brute_force(spark):
    items = [(i, prose(100 + i, 5 + 3 * i)) for i in range(25)] + [
        (30, None), (31, ""), (32, "four words are few"), (33, prose(100, 5)), (3, prose(140, 12)),
        (3, prose(141, 9)), (None, prose(142, 20))]
    docs = []
    for j in range(60):
        w = items[j % 25][1].split()
        cut = len(w) - (j % 4) * len(w) // 12                  # complete and shortened items
        docs.append((j, prose(500 + j, 40 * (j % 7)) + " " + " ".join(w[:cut]) + " " + prose(j, 30)))
    docs += [(61, None), (62, ""), (63, prose(142, 20).upper()), (None, prose(110, 35)),
             (64, prose(141, 9)), (65, prose(9, 20_000) + " " + prose(105, 20))]
    docs += [(70, "one: Four WORDS are few!"), (71, "four words are"), (72, "日本語 solo"), (73, "few"),
             (None, "yes four words are few"), (None, "solo"), (None, "solo")]
    items += [(34, "solo"), (35, "日本語"), (36, "..."), (34, "two words")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, ITEMS)
    assert run(d, i) == brute(docs, items)
    assert run(d, i, percent=100) == brute(docs, items, 100)


def test_rows_without_an_id_are_reported_one_by_one(spark):
    item = prose(7, 40)
    docs = [(None, f"{prose(i, 30)} {item}") for i in range(5)] + [(None, "clean"), (1, item)]
    got = op.contained_items(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame([(1, item)], ITEMS)).collect()
    assert sorted(r.doc_id is None for r in got) == [False] + [True] * 5


def test_very_long_text(spark):
    text = "word " * 900_000 + prose(7, 40) + " tail" * 100_000
    got = run(spark.createDataFrame([(1, text)], "doc_id long, text string"),
              spark.createDataFrame([(1, prose(7, 40)), (2, prose(8, 40)), (3, "tail tail")], ITEMS))
    assert set(got) == {(1, 1), (1, 3)}


def test_edge_and_empty(spark):
    item = spark.createDataFrame([(1, prose(1, 200))], ITEMS)
    assert {k[0] for k in run(edge_docs(spark), item)} == {0, 7, 9, 14, None}
    assert run(empty_docs(spark), item) == {}
    assert run(edge_docs(spark), spark.createDataFrame([], ITEMS)) == {}


def test_no_python_in_the_plan(spark, sf01):
    plan = op.op3_decontamination(spark, sf01)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_clean_judges_each_row(spark):
    """Rows without an id or with a shared one stay or go by their own text."""
    item = "alpha beta gamma delta epsilon zeta eta"
    rows = [(None, f"x {item} y"), (None, "clean text of no item at all here"), (1, f"{item}"),
            (1, "another clean text under the same id"), (2, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item", F.lit(1))
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    out = op.clean(df, items)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(got, key=str) == sorted([rows[1], *rows[3:]], key=str)
    assert op.clean(df, items.limit(0)).count() == len(rows)
