import hashlib
import re

import pytest
import xxhash

from tablewise.llm import substring_dedup as op
from tests.llm.data import edge_docs, edge_rows, empty_docs


def made_id(text):
    return -2 ** 63 + xxhash.xxh64_intdigest(text.encode(), 42) % 2 ** 62


def brute(rows, unit, min_words):
    """Earliest occurrence of every unit by (id, place); rows with one id do not remove each
    other's units."""
    rows = [(made_id(t or "") if i is None else i, t or "") for i, t in rows]
    first = {}
    parsed = []
    for i, t in sorted(rows):
        pieces = [m.group(0) for m in re.finditer(op.PIECES[unit], t)]
        assert "".join(pieces) == t
        norm = [re.findall(rb"[0-9a-z\x80-\xff]+", p.encode().lower()) for p in pieces]
        norm = [(b" ".join(w) or tuple(p.encode().split())) if len(w) >= min_words else None
                for w, p in zip(norm, pieces)]
        norm = [n or None for n in norm]
        for n in norm:
            if n is not None:
                first.setdefault(n, i)
        parsed.append((i, pieces, norm))
    out = []
    for i, pieces, norm in parsed:
        seen, kept, spans, at = set(), "", [], 0
        for p, n in zip(pieces, norm):
            if n is not None and (first[n] < i or n in seen):
                spans.append([at, at + len(p)])
            else:
                kept += p
            seen.add(n)
            at += len(p)
        out.append((i, sum(n is not None for n in norm), kept, spans))
    return out


@pytest.mark.parametrize("unit,min_words", [("line", 0), ("sentence", 6), ("line", 3), ("paragraph", 0)])
def test_against_brute_force(spark, unit, min_words):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    rows += [(60, "--\n- -\n\n***"), (61, "-  -\n--\nx\n***\n"), (None, "short\nshort\nlone"),
             (None, "lone\nshort"), (None, "lone\nshort")]
    docs = edge_docs(spark).unionByName(spark.createDataFrame(rows[-5:], "doc_id long, text string"),
                                        allowMissingColumns=True)
    got = op.deduplicate(docs, unit=unit, min_words=min_words, with_kept=True).collect()
    want = [(i < -2 ** 62, 0 if i < -2 ** 62 else i, *rest) for i, *rest in brute(rows, unit, min_words)]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_units, r.kept_text, r.removed)
                  for r in got) == sorted(want)
    for r in got:
        assert r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest()
        assert r.removed_chars == sum(b - a for a, b in r.removed) and r.n_removed == len(r.removed)
        assert r.first_removed == (r.removed[0][0] if r.removed else -1)


def test_normal_form_ignores_case_and_marks(spark):
    df = spark.createDataFrame([(1, "One two three, four five six."),
                                (2, "x\nONE two  three four; five SIX!\ny")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in op.deduplicate(df, with_kept=True).collect()}
    assert got == {1: "One two three, four five six.", 2: "x\ny"}


def test_short_lines_and_lines_without_spaces(spark):
    """One short line three times in four documents: 11 of 12 go."""
    line, cjk = "so it goes.\n", "これはペンです。\n"
    df = spark.createDataFrame([(i, line * 3 + cjk + f"own {i}\n\n") for i in range(4)],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in op.deduplicate(df, with_kept=True).collect()}
    assert sum(r.n_removed for r in got.values()) == 11 + 3
    assert got[0].kept_text == line + cjk + "own 0\n\n"
    assert all(got[i].kept_text == f"own {i}\n\n" for i in (1, 2, 3))


def test_many_rows_without_an_id(spark):
    """Each is a document of its own: the repeated line stays once, and no list holds it all."""
    df = spark.range(300).selectExpr("cast(null as bigint) as doc_id",
                                     "concat('shared line\n', 'own ', id) as text")
    got = op.deduplicate(df, with_kept=True).collect()
    assert len(got) == 300 and all(r.doc_id is None for r in got)
    assert sum(r.kept_text.startswith("shared") for r in got) == 1


def test_very_long_text(spark):
    text = "".join(f"line {i % 1000} of many\n" for i in range(250_000))
    row = op.deduplicate(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_units == 250_000 and row.n_removed == 249_000


def test_empty(spark):
    assert op.deduplicate(empty_docs(spark)).count() == 0
