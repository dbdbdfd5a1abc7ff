"""Token ids as flat binary files with 64-bit document offsets, memory-mapped for reading.

Layout of a token folder (``<part>`` is the number of an id range, in ascending id order)::

    <part>.bin   token ids of the part's documents, one after the other, little-endian unsigned
                 integers: 16 bits if the vocabulary fits, else 32
    <part>.idx   documents + 1 offsets into ``.bin`` (in ids), little-endian signed 64 bits
    <part>.ids   document ids, little-endian signed 64 bits (the smallest value: no id)
    index.json   format, integer width, end id, and per part its documents, ids, and the
                 number of ids in all parts before it (prefix sums of the part counts)

Documents are dealt to id ranges (bounds are approximate quantiles of the ids, a bounded list),
sorted inside each and encoded in the task that writes the part.  A part is written under a
name of its attempt and renamed, so a retried task replaces it by the same bytes.  Only the
counts of the parts (a bounded number of rows) pass through the driver.

Encoding is that of the tokenizers library.  Where the tokenizer splits texts by the byte-level
pattern, the library's model is asked once per distinct piece (remembered up to a bounded number)
as the ids of a text are those of its pieces; texts with characters beyond U+024F or with an
added token in them, and all other tokenizers, go through the library's ``encode`` as a whole.

Defined results: a null text is the empty text (only the end id); rows without an id come first;
rows that share an id are ordered by text, repeated rows included; an empty table has no parts.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.common import (ID, NO_ID, TEXT, bucket_of, cut, id_bounds, keyed, load, register,
                                  shared_dir, small_batches)

PART_ROWS = 8_192
MEMO = 250_000
# letters, numbers and white space up to U+024F, and the split pattern of byte-level BPE (fixed values)
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
PIECES = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
          f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level models use for each byte: its own Latin-1 character
    if that is visible, else the next free one from U+0100."""
    out, free = {}, 0x100
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b] = chr(free)
            free += 1
    return out


def encoder(tokenizer_json: str, width: int):
    """``text -> bytes`` of its ids, without special tokens added."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    coder = Tokenizer.from_str(tokenizer_json)
    spec = json.loads(tokenizer_json)
    dtype = f"<u{width}"

    def whole(text: str) -> bytes:
        return np.array(coder.encode(text, add_special_tokens=False).ids, dtype).tobytes()

    split = spec.get("pre_tokenizer") or {}
    model = spec["model"]
    if (split.get("type") != "ByteLevel" or split.get("add_prefix_space")
            or not split.get("use_regex", True) or spec.get("normalizer") or model.get("dropout")
            or spec.get("truncation") or spec.get("padding") or model.get("type") != "BPE"):
        return whole
    added = [t["content"] for t in spec.get("added_tokens", [])]
    beyond = re.compile("|".join(["[^\0-ɏ]", *map(re.escape, added)]))
    pieces = re.compile(PIECES).findall
    letters = byte_letters()
    tokenize = coder.model.tokenize
    memo: dict[str, bytes] = {}

    class Memo(dict):
        def __missing__(self, piece: str) -> bytes:
            mapped = piece.encode().decode("latin-1").translate(letters)
            out = self[piece] = np.array([t.id for t in tokenize(mapped)], dtype).tobytes()
            return out

    memo = Memo()

    def encode(text: str) -> bytes:
        if beyond.search(text):
            return whole(text)
        if len(memo) > MEMO:
            memo.clear()
        return b"".join([memo[p] for p in pieces(text)])

    return encode


def folder(uri: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:/") else (
        fs.LocalFileSystem(), uri)


def write_tokens(documents: DataFrame, out: str, tokenizer_file: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Encode every row, add ``end_id``, write the files to ``out``; returns ``index.json``'s
    content."""
    spark = documents.sparkSession
    small_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer_json = f.read()            # a vocabulary file: its size does not grow
    spec = json.loads(tokenizer_json)
    largest = max([end_id, *spec["model"]["vocab"].values(),
                   *[t["id"] for t in spec.get("added_tokens", [])]])
    width = 2 if largest < 1 << 16 else 4
    docs = keyed(documents, id_col, text_col).withColumn(ID, F.coalesce(ID, F.lit(NO_ID)))
    _, bounds = id_bounds(docs, PART_ROWS)

    def run(batches):
        fs, base = folder(out)
        fs.create_dir(base)
        encode = encoder(tokenizer_json, width)
        end = np.array([end_id], f"<u{width}").tobytes()
        part, open_file, name = None, None, None

        def close():
            open_file.close()
            fs.move(name, posixpath.join(base, f"{part}.bin"))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
            for suffix, data in (("idx", offsets), ("ids", np.array(ids, "<i8"))):
                with fs.open_output_stream(f"{name}.{suffix}") as f:
                    f.write(data.tobytes())
                fs.move(f"{name}.{suffix}", posixpath.join(base, f"{part}.{suffix}"))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([int(offsets[-1])], pa.int64())], ["part", "documents", "tokens"])

        for b in batches:
            for p, doc, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if p != part:
                    if part is not None:
                        yield close()
                    part, ids, sizes = p, [], []
                    name = posixpath.join(base, f"_{p}-{uuid.uuid4().hex}")
                    open_file = fs.open_output_stream(name)
                data = encode(text) + end
                open_file.write(data)
                ids.append(doc)
                sizes.append(len(data) // width)
        if part is not None:
            yield close()

    rows = (docs.select(bucket_of(F.col(ID), bounds).cast("bigint").alias("part"), ID, TEXT)
            .repartitionById(len(bounds) + 1, F.col("part").cast("int"))
            .sortWithinPartitions("part", ID, TEXT))
    parts = cut(rows.mapInArrow(run, "part bigint, documents bigint, tokens bigint"), "token-parts")
    # one row per part: a bounded number
    found, before = [], 0
    for r in sorted(parts.collect(), key=lambda r: r.part):
        found.append({"part": r.part, "documents": r.documents, "tokens": r.tokens, "base": before})
        before += r.tokens
    index = {"format": 1, "width": width, "end_id": end_id, "parts": found}
    fs, base = folder(out)
    fs.create_dir(base)
    with fs.open_output_stream(posixpath.join(base, "index.json")) as f:
        f.write(json.dumps(index).encode())
    return index


def mapped(fs, path: str, dtype: str):
    """An array over a file: memory-mapped where the file system is local."""
    from pyarrow import fs as pafs
    if isinstance(fs, pafs.LocalFileSystem):
        if fs.get_file_info(path).size == 0:
            return np.empty(0, dtype)
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_tokens(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of a token folder, in tasks of
    one part each; ``with_ids`` adds ``token_ids``."""
    fs, base = folder(out)
    with fs.open_input_stream(posixpath.join(base, "index.json")) as f:
        index = json.loads(f.read())
    width = index["width"]
    schema = ("doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
              + ", token_ids array<bigint>" * with_ids)

    def run(batches):
        fs, base = folder(out)
        for b in batches:
            for part, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids, offsets, docs = (mapped(fs, posixpath.join(base, f"{part}.{s}"), t) for s, t in
                                      (("bin", f"<u{width}"), ("idx", "<i8"), ("ids", "<i8")))
                for at in range(0, len(docs), 512):
                    to = min(at + 512, len(docs))
                    lists = [ids[offsets[i]:offsets[i + 1]] for i in range(at, to)]
                    arrays = [pa.array([None if d == NO_ID else int(d) for d in docs[at:to]],
                                       pa.int64()),
                              pa.array(offsets[at:to].astype(np.int64) + before),
                              pa.array(np.diff(offsets[at:to + 1]).astype(np.int64)),
                              pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in lists],
                                       pa.int64())]
                    if with_ids:
                        arrays.append(pa.array([x.astype(np.int64) for x in lists],
                                               pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(
                        arrays, [c.split()[0] for c in schema.split(", ")])

    parts = [(p["part"], p["base"]) for p in index["parts"]]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = spark.createDataFrame(spark.sparkContext.parallelize(parts, len(parts)),
                                 "part bigint, base bigint")
    return rows.mapInArrow(run, schema)


@register("op9_token_output")
def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = shared_dir(spark, "tokens")
    write_tokens(load(spark, sf_dir, "documents"), out,
                 public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_tokens(spark, out)


__all__ = ["write_tokens", "read_tokens", "encoder"]
