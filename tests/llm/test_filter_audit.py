import re
from collections import Counter
from itertools import permutations

from tablewise.llm import filter_audit as op
from tests.llm.data import SCHEMA, edge_docs, edge_rows, empty_docs

LABELS = "doc_id long, quality int, toxic int"


def fails_of(text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text) if w]
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text))}


def brute(rows, labels):
    """Every order applied document by document."""
    rows = [(i, t or "", p or "") for i, t, p in rows]
    failed = []
    for i, t, p in rows:
        fails = {k for k, v in fails_of(t).items() if v}
        if i is not None and any(j is not None and j < i and u == t for j, u, _ in rows):
            fails.add("E")
        failed.append((p, fails, any(j == i and q == 1 for j, q, _ in labels) and i is not None,
                       any(j == i and x == 1 for j, _, x in labels) and i is not None))
    out, shapley = {}, Counter()
    for part in {p for _, _, p in rows}:
        for order in map("".join, permutations("ABCDE")):
            alive = [r for r in failed if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [r for r in alive if f in r[1]]
                out[part, order, step] = [
                    len(alive) - len(here), len(here), sum(f in r[1] for r in gone),
                    sum(r[1] == {f} for r in alive + gone), sum(r[2] for r in here),
                    sum(r[3] for r in here)]
                shapley[part, f] += len(here)
                gone += here
                alive = [r for r in alive if f not in r[1]]
    return {k: tuple(v) + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails,
                                               r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_against_brute_force(spark):
    labels = [(0, 1, 0), (0, 0, 1), (7, 1, 1), (20, None, 1), (21, 1, None), (None, 1, 1), (12, 0, 1),
              (13, 1, 0), (999, 1, 1)]
    docs = edge_docs(spark)
    rows = [(i, t, p) for i, t, p, *_ in edge_rows()]
    more = [(50, "Many #Marks HERE", "de"), (51, "Many #Marks HERE", "en"), (49, "x y", "de"),
            (52, "Many #Marks HERE", "de"), (50, "Many #Marks HERE", "de")]
    extra = spark.createDataFrame([(i, t, p, None, None) for i, t, p in more], SCHEMA)
    both = docs.unionByName(extra, allowMissingColumns=True).withColumn("part", docs["n"])
    both = both.selectExpr("*", "1 as mask", "2 as digest", "3 as good", "4 as steps")
    marks = spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' as good", "1 as __id")
    got = result(op.audit_documents(both, marks))
    assert got == brute(rows + more, labels)
    assert len(got) == 3 * 600


def test_every_mask_folds_like_the_definition(spark):
    """All 32 masks, with different weights, in one part."""
    cell = spark.createDataFrame([("p", m, 100 + m, m, 2 * m) for m in range(32)],
                                 "part string, mask int, n long, good long, toxic long")
    got = result(op.audit(cell, "ABCDE"))
    for order in map("".join, permutations("ABCDE")):
        gone = set()
        for step, f in enumerate(order, 1):
            failing = {m for m in range(32) if m >> "ABCDE".index(f) & 1}
            here = failing - gone
            row = got["p", order, step]
            kept = set(range(32)) - failing - gone
            assert row[:6] == (sum(100 + m for m in kept), sum(100 + m for m in here),
                               sum(100 + m for m in failing & gone),
                               100 + (1 << "ABCDE".index(f)), sum(here), sum(2 * m for m in here))
            gone |= failing
    total = sum(100 + m for m in range(1, 32))
    assert sum({r[6] for r in got.values()}) <= 120 * total
    assert sum(got["p", "ABCDE", s][6] for s in range(1, 6)) == 120 * total


def test_other_filter_sets(spark):
    cell = spark.createDataFrame([("", 0, 4, 1, 0), ("", 3, 2, 0, 2)],
                                 "part string, mask int, n long, good long, toxic long")
    got = result(op.audit(cell, "XY"))
    assert got == {("", "XY", 1): (4, 2, 0, 0, 0, 2, 2), ("", "XY", 2): (4, 0, 2, 0, 0, 0, 2),
                   ("", "YX", 1): (4, 2, 0, 0, 0, 2, 2), ("", "YX", 2): (4, 0, 2, 0, 0, 0, 2)}


def test_very_long_text_and_empty_table(spark):
    text = "Ab cd " * 900_000
    df = spark.createDataFrame([(1, text, "en", None, None), (2, text, "en", None, None)], SCHEMA)
    labels = spark.createDataFrame([], LABELS)
    got = result(op.audit_documents(df, labels))
    assert got["en", "EBCDA", 1][:4] == (1, 1, 0, 0) and got["en", "BCDAE", 1][:4] == (0, 2, 0, 0)
    assert op.audit_documents(empty_docs(spark), labels).count() == 0
