"""Error injection (X1-X6): known-bad data for tests of profiles, rules and drift.

The reference loops over pandas rows with a random generator.  Here every corrupted
column is one column expression of hashes of the row key, so the transform is narrow
(no shuffle), runs in whole-stage codegen, and gives the same rows on every run and
every engine that has ``md5`` (see ``functions.hashing``).

Per chosen column, independently:

* *hit*  : ``unit_hash(key, "<salt>:hit:<column>") < frac``   (X2; count exact on average), or
  with ``exact_limits`` the ``int(n * frac)`` rows that come first in the order of that hash
* *null* : among hits, ``unit_hash(key, "<salt>:null:<column>") < null_share``  (X3)
* otherwise, by type:
  - text: append ``"_"`` + n characters of the alphabet below                  (X4)
  - numbers, scheme "gauss": ``round(x + N(50, 20), 2)``, Box-Muller on two hashes (X5)
  - numbers, scheme "shift": ``x + 100 + hash % 900``  (integer in [100, 1000))  (X6)
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, StringType

from tablewise.functions.hashing import portable_hash, unit_hash
from tablewise.functions.mathx import normal_from_uniforms
from tablewise.operators.profile import qcol

# Suffix alphabet (16 characters, so one hex digit picks one character),
# noise parameters and suffix lengths of the two corruption schemes.
SUFFIX_ALPHABET = "ABCXYZ0123456789"
HEX_DIGITS = "0123456789abcdef"
GAUSS_MEAN = 50.0
GAUSS_SD = 20.0
SHIFT_LOW = 100
SHIFT_HIGH = 1000
SCHEMES = {
    # scheme: (suffix length, numeric noise, text used for a null before the suffix, max columns)
    "gauss": (4, "gauss", "", 6),
    "shift": (5, "shift", "None", 5),
}


def choose_columns(df: DataFrame, k: int, exclude=(), seed: int = 42) -> list[str]:
    """The ``k`` columns whose names rank first by hash (schema only, no data read)."""
    return choose_columns_from(df.columns, k, exclude, seed)


def choose_columns_from(columns, k: int, exclude=(), seed: int = 42) -> list[str]:
    """X1 on a list of column names (same draw as :func:`choose_columns`)."""
    def rank(name: str) -> str:
        return hashlib.md5(f"{name}:{seed}".encode()).hexdigest()

    return sorted((c for c in columns if c not in exclude), key=rank)[:k]


def hit_expr(key, column: str, frac: float, salt) -> Column:
    return unit_hash(key, f"{salt}:hit:{column}") < F.lit(frac)


# bits of a draw below each step of the refinement: 16 + 16 + 16 + 15 of 63
DRAW_SHIFTS = (47, 31, 15, 0)


def draw(key, column: str, salt) -> Column:
    """Place of a row in a column's draw (63 bits): the hash of ``hit_expr``, then a second one."""
    first = portable_hash(qkey(key), f"{salt}:hit:{column}")
    second = portable_hash(qkey(key), f"{salt}:tie:{column}")
    return first * F.lit(1 << 31) + F.shiftright(second, 1)


def exact_limits(df: DataFrame, columns, key, frac: float, salt=7,
                 only_where: Column | None = None) -> dict[str, int]:
    """X2 with exact counts: per column the largest draw that is a hit, so that ``int(n * frac)``
    of the ``n`` rows (with a key, and meeting ``only_where``) are hit.

    All columns are refined together: counts of the draws' upper bits (at most 65,536 a column,
    pre-aggregated), the entry in which the count is reached, then only its rows by the next bits;
    a step that ends on an entry's edge ends the column's search.  One row per column and step
    reaches the driver.  Rows with one key have one draw and are hit together.
    """
    columns = list(columns)
    rows = df if only_where is None else df.where(F.coalesce(only_where, F.lit(False)))
    rows = rows.where(qkey(key).isNotNull())
    total = rows.count()
    wanted = {c: int(total * frac) for c in columns}
    limits = {c: (1 << 63) - 1 if wanted[c] >= total else -1 for c in columns}
    held = [c for c in columns if 0 < wanted[c] < total]
    prefix: dict[str, int] = {}
    above = None
    for shift in DRAW_SHIFTS:
        if not held:
            break
        draws = rows.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), draw(key, c, salt).alias("d")) for c in held])))
        if above is not None:
            draws = draws.where(F.shiftright("d", above) == _of_column(prefix, held))
        counts = draws.groupBy("column", F.shiftright("d", shift).alias("entry")).count()
        upto = F.sum("count").over(Window.partitionBy("column").orderBy("entry"))
        need = _of_column(wanted, held)
        found = (counts.withColumn("upto", upto)
                 .where((F.col("upto") >= need) & (F.col("upto") - F.col("count") < need)).collect())
        for r in found:
            wanted[r["column"]] -= r["upto"] - r["count"]
            prefix[r["column"]] = r["entry"]
            if wanted[r["column"]] == r["count"] or shift == 0:
                limits[r["column"]] = ((r["entry"] + 1) << shift) - 1
                held.remove(r["column"])
        above = shift
    return limits


def _of_column(values: dict[str, int], columns) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for c in columns
                                       for x in (c, values[c])]), F.col("column")).cast("bigint")


def hit_of(key, column: str, frac: float, salt, limits: dict[str, int] | None) -> Column:
    """Whether a row is hit: by its hash alone, or by the exact limits."""
    if limits is None:
        return hit_expr(key, column, frac, salt)
    return F.coalesce(draw(key, column, salt) <= F.lit(limits[column]).cast("bigint"), F.lit(False))


def null_coin(key, column: str, null_share: float, salt) -> Column:
    return unit_hash(key, f"{salt}:null:{column}") < F.lit(null_share)


def suffix_expr(key, column: str, length: int, salt) -> Column:
    digest = F.md5(F.concat(qkey(key).cast("string"), F.lit(f":{salt}:suffix:{column}")))
    return F.concat(F.lit("_"),
                    F.translate(F.substring(digest, 1, length), HEX_DIGITS, SUFFIX_ALPHABET))


def gauss_noise(key, column: str, salt, mean=GAUSS_MEAN, sd=GAUSS_SD) -> Column:
    u1 = unit_hash(key, f"{salt}:u1:{column}")
    u2 = unit_hash(key, f"{salt}:u2:{column}")
    return normal_from_uniforms(u1, u2, mean, sd)


def shift_noise(key, column: str, salt, low=SHIFT_LOW, high=SHIFT_HIGH) -> Column:
    return F.lit(low) + portable_hash(key, f"{salt}:shift:{column}") % F.lit(high - low)


def qkey(key) -> Column:
    return qcol(key) if isinstance(key, str) else key


def corrupt_column(df: DataFrame, column: str, key, kind: str, frac: float = 0.5,
                   null_share: float = 0.5, salt=7, suffix_len: int = 4, null_text: str = "",
                   limits: dict[str, int] | None = None) -> Column:
    """One corrupted column.  ``kind``: null | suffix | gauss | shift | auto-by-type."""
    c = qcol(column)
    dtype = df.schema[column].dataType
    hit = hit_of(key, column, frac, salt, limits)
    if kind == "null":
        return F.when(hit, F.lit(None).cast(dtype)).otherwise(c).alias(column)
    if kind == "suffix":
        base = F.coalesce(c.cast("string"), F.lit(null_text))
        return F.when(hit, F.concat(base, suffix_expr(key, column, suffix_len, salt))) \
            .otherwise(c.cast("string")).alias(column)
    if kind == "gauss":
        noisy = F.round(c.cast("double") + gauss_noise(key, column, salt), 2)
        return F.when(hit, noisy).otherwise(c.cast("double")).alias(column)
    if kind == "shift":
        noisy = (c + shift_noise(key, column, salt)).cast(dtype)
        return F.when(hit, noisy).otherwise(c).alias(column)
    raise ValueError(f"unknown corruption kind {kind!r}")


def corrupt(df: DataFrame, columns, key: str, frac: float = 0.5, null_share: float = 0.5,
            scheme: str = "gauss", salt=7, only_where: Column | None = None,
            exact: bool = False) -> DataFrame:
    """Corrupt ``columns`` of ``df``; half of the hit rows become null, the rest
    get a text suffix or numeric noise depending on the column type.  ``only_where``
    limits the damage to rows meeting a condition (e.g. the newest day of a slice).
    ``exact`` hits exactly ``int(n * frac)`` rows per column (see ``exact_limits``; it reads the
    key column), otherwise about so many.

    Types are kept where the noise allows it (shift keeps integers; gauss turns integers
    into doubles, as adding a real-valued noise does).
    """
    suffix_len, noise, null_text, _ = SCHEMES[scheme]
    chosen = set(columns)
    limits = exact_limits(df, columns, key, frac, salt, only_where) if exact else None
    out = []
    for f in df.schema.fields:
        name = f.name
        c = qcol(name)
        if name not in chosen:
            out.append(c)
            continue
        hit = hit_of(key, name, frac, salt, limits)
        if only_where is not None:
            hit = hit & F.coalesce(only_where, F.lit(False))
        to_null = hit & null_coin(key, name, null_share, salt)
        dtype = f.dataType
        if isinstance(dtype, StringType):
            base = F.coalesce(c, F.lit(null_text))
            changed = F.concat(base, suffix_expr(key, name, suffix_len, salt))
            expr = F.when(to_null, F.lit(None).cast("string")).when(hit, changed).otherwise(c)
        elif isinstance(dtype, NumericType):
            if noise == "gauss":
                changed = F.round(c.cast("double") + gauss_noise(key, name, salt), 2)
                expr = F.when(to_null, F.lit(None).cast("double")) \
                    .when(hit, changed).otherwise(c.cast("double"))
            else:
                shifted = c + shift_noise(key, name, salt)
                if isinstance(dtype, IntegralType):
                    shifted = shifted.cast(dtype)
                expr = F.when(to_null, F.lit(None).cast(dtype)).when(hit, shifted).otherwise(c)
        else:
            # other types can only lose values
            expr = F.when(to_null, F.lit(None).cast(dtype)).otherwise(c)
        out.append(expr.alias(name))
    return df.select(*out)


def make_dirty(df: DataFrame, key: str, frac: float = 0.3, scheme: str = "gauss",
               exclude=(), seed: int = 42, salt=7, exact: bool = False):
    """X1 + X2-X6 in one call: pick columns (never the key), corrupt them.

    Returns ``(corrupted_df, chosen_columns)``.
    """
    k = SCHEMES[scheme][3]
    cols = choose_columns(df, k, exclude=set(exclude) | {key}, seed=seed)
    return corrupt(df, cols, key, frac=frac, scheme=scheme, salt=salt, exact=exact), cols


__all__ = ["choose_columns", "choose_columns_from", "corrupt", "corrupt_column", "make_dirty", "hit_expr",
           "draw", "exact_limits",
           "null_coin", "suffix_expr", "gauss_noise", "shift_noise", "SCHEMES",
           "SUFFIX_ALPHABET"]
