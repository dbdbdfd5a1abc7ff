"""Deterministic per-row hashes used for sampling, splitting and error injection.

Two flavours:

* ``portable_hash`` - the first 32 bits of ``md5("<key>:<salt>")`` as a non-negative
  bigint.  The same number can be computed by any SQL engine that has ``md5`` (the
  oracle SQL does), so sampled / corrupted rows are reproducible outside Spark.
* ``fast_hash`` - ``xxhash64`` of (key, salt), masked to 32 bits.  Cheaper; use it when
  reproducibility outside Spark does not matter.

Both are pure column expressions: narrow, codegen'd, no shuffle.  Different salts give
independent hashes (a multiplicative hash with an additive salt does not, so it is
not offered).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = float(2 ** 32)


def _key_text(key) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return c.cast("string")


def portable_hash(key, salt) -> Column:
    """``int(md5(str(key) + ':' + str(salt))[:8], 16)`` as bigint in [0, 2^32)."""
    digest = F.md5(F.concat(_key_text(key), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def portable_hash_sql(key_sql: str, salt) -> str:
    """DuckDB text of :func:`portable_hash` (for oracle queries)."""
    return (f"cast(('0x' || substr(md5(concat(cast({key_sql} as varchar), ':{salt}')), 1, 8))"
            f" as bigint)")


def fast_hash(key, salt) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.xxhash64(c, F.lit(str(salt))).bitwiseAND(F.lit(0xFFFFFFFF))


def unit_hash(key, salt, method: str = "portable") -> Column:
    """Uniform double in [0, 1) from a row key."""
    h = portable_hash(key, salt) if method == "portable" else fast_hash(key, salt)
    return h.cast("double") / F.lit(TWO_32)


def unit_hash_sql(key_sql: str, salt) -> str:
    return f"({portable_hash_sql(key_sql, salt)} / 4294967296.0)"


def row_key(*cols) -> Column:
    """A text key from several columns (for tables without a single id)."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
             for c in cols]
    return F.concat_ws("|", *parts)


__all__ = ["portable_hash", "portable_hash_sql", "fast_hash", "unit_hash",
           "unit_hash_sql", "row_key", "TWO_32"]
