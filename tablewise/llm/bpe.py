"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

The rank file is read once on the driver and travels to the tasks as bytes (a vocabulary
file has a fixed size, independent of the corpus).  Long texts are encoded in segments that
end where no match of the split pattern can cross: before white space that follows other
text.  A run of white space longer than a segment is one match by the pattern (all of it at the
end of a text, else all but its last character, which goes with what follows); its bytes are
merged by the ranks as one piece, as the library's regex engine has not the stack for it.
Decoding joins the raw bytes of the ids, so no text is lost to replacement characters.

Defined results: a null text is the empty text (no ids, no bytes); special-token strings in
a text are ordinary text; repeated rows give repeated results; a null id stays null; texts of
any length, of one character class too, are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.common import ID, keyed, load, register, small_batches

SEGMENT_CHARS = 1 << 16
ASCII_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")


# fixed values: the characters that the split pattern's \s matches
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def segments(text: str, size: int | None = None):
    """Pieces of a long text, cut only before ASCII white space that follows a character
    which is not white space; no match of the split pattern spans such a place."""
    size = size or SEGMENT_CHARS
    start, n = 0, len(text)
    while n - start > size:
        end = None
        for m in ASCII_SPACE.finditer(text, start + size):
            if not text[m.start() - 1].isspace():
                end = m.start()
                break
        if end is None:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def codec(rank_bytes: bytes, pattern: str):
    """``(encode, decode)`` of a rank file's content."""
    import tiktoken
    ranks = {base64.b64decode(token): int(rank)
             for token, rank in (line.split() for line in rank_bytes.splitlines() if line)}
    coder = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if len(text) <= SEGMENT_CHARS:
            return coder.encode_ordinary(text)
        ids: list[int] = []
        for part, is_white in without_long_runs(text):
            if is_white:
                ids += coder._encode_single_piece(part.encode())
            else:
                for segment in segments(part):
                    ids += coder.encode_ordinary(segment)
        return ids

    return encode, coder.decode_bytes


def without_long_runs(text: str, size: int | None = None):
    """``(part, is white space)`` in order: runs of more than ``size`` white-space characters as the
    split pattern takes them (without their last character if text follows), and the rest."""
    size = size or SEGMENT_CHARS
    start = 0
    for m in re.finditer(f"[{WHITE}]{{{size + 1},}}", text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        if start < m.start():
            yield text[start:m.start()], False
        yield text[m.start():end], True
        start = end
    if start < len(text):
        yield text[start:], False


def read_rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col, token_ids array<int>`` of every text."""
    small_batches(docs.sparkSession)
    data = read_rank_file(rank_file)

    def run(batches):
        enc, _ = codec(data, pattern)
        for b in batches:
            ids = pa.array([enc(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], [ID, "token_ids"])

    out = keyed(docs, id_col, text_col).mapInArrow(run, f"{ID} bigint, token_ids array<int>")
    return out.withColumnRenamed(ID, id_col)


def decode(tokens: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "token_ids") -> DataFrame:
    """``id_col, decoded binary``: the raw bytes of each id list (null: no bytes)."""
    small_batches(tokens.sparkSession)
    data = read_rank_file(rank_file)

    def run(batches):
        _, dec = codec(data, pattern)
        for b in batches:
            out = pa.array([dec(i or []) for i in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), out], [ID, "decoded"])

    rows = tokens.select(F.col(id_col).cast("bigint").alias(ID), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"{ID} bigint, decoded binary").withColumnRenamed(ID, id_col)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass and keep digests: ``id_col, n_tokens, ids_sha256`` (decimal
    ids joined by a space), ``decoded_sha256``, ``lossless`` (the bytes are the text's), and
    with ``with_ids`` the ``token_ids``."""
    small_batches(docs.sparkSession)
    data = read_rank_file(rank_file)

    def run(batches):
        enc, dec = codec(data, pattern)
        names: list[str] = []
        for b in batches:
            n, a, d, same, lists = [], [], [], [], []
            for text in b.column(1).to_pylist():
                ids = enc(text)
                while ids and len(names) <= max(ids):
                    names.append(str(len(names)))
                raw = dec(ids)
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                d.append(hashlib.sha256(raw).hexdigest())
                same.append(raw == text.encode())
                if with_ids:
                    lists.append(np.array(ids, np.int32))
            arrays = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                      pa.array(d, pa.string()), pa.array(same, pa.bool_())]
            if with_ids:
                arrays.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, columns)

    schema = (f"{ID} bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
              "lossless boolean" + ", token_ids array<int>" * with_ids)
    columns = [c.split()[0] for c in schema.split(", ")]
    out = keyed(docs, id_col, text_col).mapInArrow(run, schema)
    return out.withColumnRenamed(ID, id_col)


def default_rank_file() -> tuple[str, str]:
    """Rank file and split pattern that the query uses."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@register("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = default_rank_file()
    return round_trip(load(spark, sf_dir, "documents"), path, pattern)


__all__ = ["encode", "decode", "round_trip", "segments", "without_long_runs", "codec", "default_rank_file"]
