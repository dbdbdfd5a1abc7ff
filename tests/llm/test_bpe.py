import hashlib

import pytest

from tablewise.llm import bpe as op
from tests.llm.data import edge_docs, edge_rows, empty_docs, prose

tiktoken = pytest.importorskip("tiktoken")
PATH, PATTERN = op.default_rank_file()


@pytest.fixture(scope="module")
def coder():
    import base64
    ranks = {base64.b64decode(a): int(b) for a, b in
             (line.split() for line in open(PATH, "rb") if line.strip())}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(coder, i, text):
    ids = coder.encode_ordinary(text or "")
    raw = (text or "").encode()
    return (str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(raw).hexdigest(), True)


def test_round_trip(spark, coder):
    got = op.round_trip(edge_docs(spark), PATH, PATTERN, with_ids=True).collect()
    assert sorted((str(r.doc_id), *r[1:5]) for r in got) == \
        sorted(expected(coder, i, t) for i, t, *_ in edge_rows())
    assert all(len(r.token_ids) == r.n_tokens for r in got)
    assert op.round_trip(empty_docs(spark), PATH, PATTERN).count() == 0


def test_encode_then_decode(spark):
    docs = edge_docs(spark, clash=False).where("doc_id is not null and doc_id not in (20, 21)")
    tokens = op.encode(docs, PATH, PATTERN)
    back = {r.doc_id: bytes(r.decoded) for r in op.decode(tokens, PATH, PATTERN).collect()}
    assert back == {r.doc_id: (r.text or "").encode() for r in docs.collect()}


@pytest.mark.parametrize("text", [
    prose(1, 400), " \n" * 300, "a  b\t\tc \n d" * 60, "x  y   z　 " * 50, "'s 'll don't " * 40,
    "no-space" * 100, "1 2  3\r\n4" * 50, "<|endoftext|> " * 30, "é \x1c è " * 50])
def test_segments_do_not_change_ids(coder, text):
    for size in (1, 7, 50):
        parts = list(op.segments(text, size))
        assert "".join(parts) == text
        assert [i for p in parts for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)


def by_definition(coder, text):
    """Every match of the pattern by itself, merged by the ranks."""
    regex = pytest.importorskip("regex")
    return [i for m in regex.finditer(PATTERN, text) for i in coder._encode_single_piece(m[0].encode())]


@pytest.mark.parametrize("text", [
    "a" + " " * 30, " " * 30 + "b", "a" + " " * 30 + "b", "a" + " " * 29 + "\nb", "\n" * 31 + " 1",
    "x" + "\u3000 \xa0" * 12 + "'s", " " * 40 + "\x1c" + "\t" * 40, "a b" + " " * 25 + "c d" + "\n" * 25,
    "\x1f" * 40, "\u200b" * 40 + " " * 22, " " * 21, "a" + " " * 20 + "b"])
def test_long_white_space_by_the_definition(monkeypatch, coder, text):
    monkeypatch.setattr(op, "SEGMENT_CHARS", 20)
    encode, decode = op.codec(op.read_rank_file(PATH), PATTERN)
    assert encode(text) == by_definition(coder, text) == coder.encode_ordinary(text)
    assert decode(encode(text)) == text.encode()


@pytest.mark.parametrize("n", [900_000, 1_100_000, 5_000_000])
def test_white_space_beyond_the_regex_stack(coder, n):
    encode, decode = op.codec(op.read_rank_file(PATH), PATTERN)
    for text in (" " * n, "a" + " " * n + "b", "\n" * n + "c", " \n" * (n // 2) + " "):
        ids = encode(text)
        assert decode(ids) == text.encode()
        assert ids == by_definition(coder, text)


def test_very_long_texts_of_other_kinds(coder):
    encode, decode = op.codec(op.read_rank_file(PATH), PATTERN)
    for text in ("ab" * 2_500_000, "日本" * 800_000, "1" * 5_000_000, "word " * 1_000_000):
        assert decode(encode(text)) == text.encode()


def test_long_texts_are_cut(monkeypatch, spark, coder):
    monkeypatch.setattr(op, "SEGMENT_CHARS", 100)
    got = op.round_trip(edge_docs(spark), PATH, PATTERN).collect()
    assert sorted((str(r.doc_id), *r[1:5]) for r in got) == \
        sorted(expected(coder, i, t) for i, t, *_ in edge_rows())


def test_query(spark, sf001, coder):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").collect()
    got = op.op8_byte_bpe(spark, sf001).collect()
    assert sorted((str(r.doc_id), *r[1:5]) for r in got) == \
        sorted(expected(coder, r.doc_id, r.text) for r in docs)
