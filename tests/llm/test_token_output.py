import json
import random
import zlib

import numpy as np
import pytest

from tablewise.llm import token_output as op
from tablewise.llm.common import shared_dir
from tests.llm.data import edge_docs, edge_rows, empty_docs

tokenizers = pytest.importorskip("tokenizers")
import public_tokenizers  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows, path=PATH, end=0):
    coder = tokenizers.Tokenizer.from_file(path)
    start, out = 0, []
    for i, t in sorted((-2 ** 63 if i is None else i, t or "") for i, t in rows):
        ids = coder.encode(t, add_special_tokens=False).ids + [end]
        out.append((None if i == -2 ** 63 else i, start, len(ids),
                    zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, df, path=PATH, end=0):
    out = shared_dir(spark, "tokens-test")
    index = op.write_tokens(df, out, path, end)
    rows = [tuple(r) for r in op.read_tokens(spark, out).collect()]
    return index, sorted(rows, key=lambda r: r[1]), out


@pytest.mark.parametrize("part_rows", [3, 1000])
def test_edge_rows(spark, monkeypatch, part_rows):
    monkeypatch.setattr(op, "PART_ROWS", part_rows)
    index, got, out = written(spark, edge_docs(spark))
    assert got == expected([(i, t) for i, t, *_ in edge_rows()])
    assert index["width"] == 2 and (len(index["parts"]) > 1) == (part_rows == 3)
    fs, base = op.folder(out)
    total = 0
    for p in index["parts"]:                        # the layout as documented
        data, offsets, ids = (np.frombuffer(fs.open_input_stream(f"{base}/{p['part']}.{s}").read(), t)
                              for s, t in (("bin", "<u2"), ("idx", "<i8"), ("ids", "<i8")))
        assert p["base"] == total and len(data) == offsets[-1] == p["tokens"]
        assert len(ids) == p["documents"] == len(offsets) - 1 and all(data[offsets[1:] - 1] == 0)
        total += p["tokens"]
    assert json.loads(fs.open_input_stream(f"{base}/index.json").read()) == index


def test_pieces_equal_the_whole_encoding():
    rng = random.Random(1)
    marks = [chr(c) for c in range(0x260)] + ["  ", "\n\n", "\r\n", "日本", "😀", "'s", "'ll",
                                             "<|endoftext|>"]
    spec = open(PATH, encoding="utf-8").read()
    encode = op.encoder(spec, 2)
    coder = tokenizers.Tokenizer.from_file(PATH)
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(60))) for _ in range(2000)]
    for t in texts + [" " * 500 + "x", "a \n\nb", "<|endoftext|>"]:
        assert np.frombuffer(encode(t), "<u2").tolist() == \
            coder.encode(t, add_special_tokens=False).ids


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(op, "MEMO", 5)
    encode = op.encoder(open(PATH, encoding="utf-8").read(), 4)
    coder = tokenizers.Tokenizer.from_file(PATH)
    for i in range(30):
        t = f"word{i} other{i * 7} end"
        assert np.frombuffer(encode(t), "<u4").tolist() == coder.encode(t).ids


def test_other_tokenizer(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([(2, "Hello World, 42"), (1, "x y"), (3, None)],
                               "doc_id long, text string")
    _, got, _ = written(spark, df, path, 49407)
    assert got == expected([(r.doc_id, r.text) for r in df.collect()], path, 49407)


def test_token_ids_and_empty(spark):
    _, got, out = written(spark, spark.createDataFrame([(1, "ab cd")], "doc_id long, text string"))
    ids = op.read_tokens(spark, out, with_ids=True).first().token_ids
    assert ids[-1] == 0 and len(ids) == got[0][2]
    index, got, _ = written(spark, empty_docs(spark))
    assert got == [] and index["parts"] == []


def test_query(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").collect()
    got = sorted((tuple(r) for r in op.op9_token_output(spark, sf001).collect()), key=lambda r: r[1])
    assert got == expected([(r.doc_id, r.text) for r in docs])
