import re

from tablewise.llm import license_scan as op
from tests.llm.data import edge_docs, edge_rows, empty_docs

PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def base_by_hand(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for label, phrase in PHRASES.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def found(templates, text):
    automaton, words = op.Automaton(templates), op.words_of(text)
    return [(templates[t][0], automaton.start_of(t, words, i), i)
            for t, i in automaton.accepted(words)]


def test_base_columns_of_the_query(spark, sf01):
    docs = dict(spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text").collect())
    rows = op.op2_license_scan(spark, sf01).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == \
            base_by_hand(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and 0 <= r.score <= 1


def test_optional_replaceable_and_alternative_regions():
    t = [("x", "start [very [much] so] {1-2} (end | the end)")]
    for text in ("start a end", "start very so a b the end", "Start, VERY much so; z end."):
        assert [m for m in found(t, text) if m[1] == 0], text
    for text in ("start end", "start a b c end", "start very a b c end", "begin a end"):
        assert not found(t, text), text


def test_mandatory_wording_must_match():
    notice = [x for x in op.TEMPLATES if x[0] == "mit-notice"]
    assert found(notice, "Released under the MIT License.") == [("mit-notice", 0, 4)]
    assert found(notice, "released under the terms of the MIT license")
    assert not found(notice, "released under the old MIT license")
    assert not found(notice, "released under the MITlicense")


def test_states_can_be_built_anew(monkeypatch):
    monkeypatch.setattr(op, "STATES", 1)
    assert found(op.BASE, "mit mit license x general public license") == \
        [("mit", 1, 2), ("gpl", 4, 6)]


def test_edge_rows(spark):
    got = op.scan(edge_docs(spark), op.BASE).select("doc_id", "n_words", "matches").collect()
    assert sorted((str(r.doc_id), r.n_words, len(r.matches)) for r in got) == \
        sorted((str(i), base_by_hand(t)[0], 0) for i, t, *_ in edge_rows())
    assert op.scan(empty_docs(spark), op.BASE).count() == 0


def test_template_that_begins_with_any_words():
    a = op.Automaton([("x", "{1-2} foo license"), ("y", "[the] bar")])
    words = op.words_of("zzz foo license then zzz qqq the bar foo license")
    assert list(a.accepted(words)) == [(0, 2), (1, 7), (0, 9)]
    assert a.start_of(0, words, 2) == 0
    assert list(a.accepted(op.words_of("foo license"))) == []
