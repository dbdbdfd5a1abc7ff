"""Secret scan by linking the parts of a credential, in DataFrame functions only.

A credential has up to three parts: an identifier (who), a secret (what proves it) and an endpoint
(where it is used).  Some parts speak for themselves (an assignment to ``password``, an access
key, a long hexadecimal run) and are always reported.  Others are weak: a name given to
``user``, a long run of mixed characters, an address.  A weak part is reported only when a part of
the complementary side (identifier or endpoint against secret) starts within ``REACH`` code points
of it in the same scope; scopes are the blocks between blank lines.

Finding.  ``regexp_extract_all`` gives the matches of a pattern and ``split`` the gaps between
them, so running sums of their lengths are the places.  The sums go block by block, and their cost
follows the number of matches also in very long texts.

Linking.  A part is the interval ``[start - REACH, start + REACH]`` of its scope.  Starts are put
into bins of ``REACH`` code points.  Each (text, scope, bin, side) is summed up as its smallest and
largest start, which is sent to its own bin and the two beside it; a weak part meets one such row of
the other side: any start of its own bin is within reach, of the bins beside it the nearest
start decides.  So the join is exact, has one row per weak part, and no pairs are made.  Texts are
known by their sha256; copies are linked once and share the result.

Defined results: null text is empty text; a null id stays null; repeated rows give repeated
results, rows with one id and different texts each their own; matches of one kind do not
overlap, matches of different kinds may; places are code points.  A weak secret that starts inside
an address is part of the address and no candidate.  Very long texts work in time that grows
with their length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewise.llm.common import ID, column, cut, keyed, load, register

REACH = 256                  # code points between the starts of parts that belong together
BLOCK = 256                  # lengths summed in one go

SECRET, OTHER = "secret", "identity"      # sides: what proves, and who or where


def either_case(words: str) -> str:
    """A pattern text whose ASCII letters match in either case."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


@dataclass(frozen=True)
class Kind:
    name: str
    side: str
    pattern: str                 # no look-around, so that a match matches by itself
    value_chars: int = 0         # least length of group 2
    holds: tuple = ()            # patterns that must be found in the match
    weak: bool = False


# The first three and their order are fixed values of the contract.  ``AKIA`` and hexadecimal runs
# are greedy, so least lengths inside the pattern find what dropping short runs would.
KINDS = (
    Kind("assign", SECRET, f"({either_case('password|passwd|secret|token|api_?key')}){VALUE}",
         value_chars=6),
    Kind("access", OTHER, "AKIA[A-Z0-9]{16,}"),
    Kind("hex", SECRET, "[0-9a-f]{24,}"),
    Kind("ident", OTHER,
         f"({either_case('user_?name|user|login|account|client_?id|key_?id')})"
         + VALUE.replace("/_.=-", "/_.@=-"), value_chars=3, weak=True),
    Kind("key", SECRET, "[A-Za-z0-9+_=-]{20,}", holds=("[0-9]", "[a-z]", "[A-Z]"), weak=True),
    Kind("endpoint", OTHER,
         r"(https?|ftps?|sftp|ssh|postgres(ql)?|mysql|mongodb|redis|amqps?|ldaps?)"
         r"""://[^\x00-\x20"'<>]+""", weak=True),
)
SCOPE_END = r"\n[\x20\t\r]*\n"       # a blank line
BREAK = -1                           # kind number of a scope's end


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(v: Column) -> Column:
    """Running sums of an int array, block by block: appending to one long array would copy it
    for every entry.  Null for an empty or null array."""
    zero = F.lit(0).cast("int")

    def scan(x: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(x, begin, lambda s, n: F.struct(
            (s["at"] + n).alias("at"), F.array_append(s["out"], s["at"] + n).alias("out")),
            lambda s: s["out"])

    def blocks(x: Column) -> Column:
        last = F.floor((F.size(x) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last),
                           lambda b: F.slice(x, b * BLOCK + 1, F.lit(BLOCK)))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda x: F.aggregate(x, zero, lambda a, n: a + n))
        before = _let(totals, lambda t: F.zip_with(scan(t, zero), t, lambda a, n: a - n))
        return F.flatten(F.zip_with(parts, before, scan))

    return F.when(F.size(v) > 0, _let(v, lambda x: _let(blocks(x), joined)))


def _places(rows: DataFrame, text: str, patterns: dict[int, str]) -> DataFrame:
    """Adds ``p<number> array<struct<start, end, match>>`` per pattern, null without a match."""
    keep = rows.columns
    rows = rows.select("*", *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"m{n}")
                              for n, p in patterns.items()])
    rows = rows.select("*", *[F.when(F.size(f"m{n}") > 0, F.zip_with(
        F.split(F.col(text), p, -1), f"m{n}",
        lambda gap, m: F.when(m.isNotNull(), F.length(gap) + F.length(m)))).alias(f"l{n}")
        for n, p in patterns.items()])
    rows = rows.select("*", *[F.when(F.size(f"m{n}") > 0, running_sums(
        F.slice(f"l{n}", F.lit(1), F.size(f"m{n}")))).alias(f"e{n}") for n in patterns])
    return rows.select(*keep, *[F.zip_with(f"e{n}", f"m{n}", lambda e, m: F.struct(
        (e - F.length(m)).alias("start"), e.alias("end"), m.alias("match"))).alias(f"p{n}")
        for n in patterns])


def _wanted(kind: Kind, match: Column) -> Column:
    ok = F.lit(True)
    if kind.value_chars:
        ok &= F.length(F.regexp_extract(match, kind.pattern, 2)) >= kind.value_chars
    for p in kind.holds:
        ok &= match.rlike(p)
    return ok


SPAN = "array<struct<start:int,kind:int,end:int>>"


def parts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Per row ``__id, digest, base, weak, breaks``: spans (start, kind number, end) of the strong
    and the weak kinds in order, and the starts of blank lines where both sides are present."""
    rows = keyed(documents, id_col, text_col)
    rows = _places(rows, "__text", {n: k.pattern for n, k in enumerate(kinds)})

    def of_kind(n: int) -> Column:
        wanted = F.filter(f"p{n}", lambda p: _wanted(kinds[n], p["match"]))
        return F.transform(wanted, lambda p: F.struct(
            p["start"].alias("start"), F.lit(n).alias("kind"), p["end"].alias("end")))

    def spans(weak: bool) -> Column:
        found = [of_kind(n) for n, k in enumerate(kinds) if k.weak == weak]
        empty = F.array().cast(SPAN)
        return F.array_sort(F.concat(empty, *[F.coalesce(f, empty) for f in found]))

    rows = rows.select(ID, "__text", F.unhex(F.sha2("__text", 256)).alias("digest"),
                       spans(False).alias("base"), spans(True).alias("weak"))
    secrets = F.array(*[F.lit(n) for n, k in enumerate(kinds) if k.side == SECRET])
    both = F.concat("base", "weak")
    linkable = (F.size("weak") > 0) & F.exists(
        both, lambda p: F.array_contains(secrets, p["kind"])) & F.exists(
        both, lambda p: ~F.array_contains(secrets, p["kind"]))
    rows = rows.select("*", linkable.alias("linkable"))
    rows = rows.withColumn("scanned", F.when(F.col("linkable"), F.col("__text")))
    rows = _places(rows, "scanned", {0: SCOPE_END})
    empty = F.array().cast("array<int>")
    return rows.select(ID, "digest", "base", "weak", "linkable", F.coalesce(
        F.transform("p0", lambda p: p["start"]), empty).alias("breaks"))


def linked(found: DataFrame, kinds: tuple[Kind, ...] = KINDS, reach: int = REACH) -> DataFrame:
    """``digest, linked``: the weak spans of each text that have a complementary part in reach,
    from ``parts`` rows."""
    secret = F.col("kind").isin([n for n, k in enumerate(kinds) if k.side == SECRET])
    weak = F.col("kind").isin([n for n, k in enumerate(kinds) if k.weak])
    address = F.col("kind").isin([n for n, k in enumerate(kinds) if k.name == "endpoint"])
    breaks = F.transform("breaks", lambda b: F.struct(
        b.alias("start"), F.lit(BREAK).alias("kind"), b.alias("end")))
    rows = (found.where("linkable").dropDuplicates(["digest"])
            .select("digest", F.inline(F.concat("base", "weak", breaks))))
    # one window per text, over its own parts: number of blank lines above, and the reach of
    # the addresses that begin above
    above = Window.partitionBy("digest").orderBy("start", "kind")
    over = F.max(F.when(address, F.col("end"))).over(
        above.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(
        "*", F.sum((F.col("kind") == BREAK).cast("int")).over(
            above.rowsBetween(Window.unboundedPreceding, 0)).alias("scope"), over.alias("covered"))
    inside = secret & weak & (F.coalesce("covered", F.lit(0)) > F.col("start"))
    rows = rows.where((F.col("kind") != BREAK) & ~inside).select(
        "digest", "scope", "start", "kind", "end", weak.alias("weak"), secret.alias("secret"),
        F.floor(F.col("start") / reach).alias("bin"))
    key = ["digest", "scope", "bin", "secret"]
    sums = rows.groupBy(*key).agg(F.min("start").alias("low"), F.max("start").alias("high"))
    none = F.lit(None).cast("int")
    beside = F.inline(F.array(
        F.struct((F.col("bin") - 1).alias("bin"), none.alias("left"), F.col("low").alias("right")),
        F.struct(F.col("bin").alias("bin"), F.col("low").alias("left"), F.col("low").alias("right")),
        F.struct((F.col("bin") + 1).alias("bin"), F.col("high").alias("left"), none.alias("right"))))
    own = (sums.select("digest", "scope", "secret", F.col("bin").alias("from"), "low", "high", "bin")
           .select("digest", "scope", "secret", "from", beside)
           .withColumn("own", F.col("from") == F.col("bin")))
    near = own.groupBy(*key).agg(F.max("own").alias("own"), F.max("left").alias("left"),
                                 F.min("right").alias("right"))
    met = (rows.where("weak").withColumn("secret", ~F.col("secret")).join(near, key)
           .where(F.col("own") | (F.col("left") >= F.col("start") - reach)
                  | (F.col("right") <= F.col("start") + reach)))
    return met.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
                                     .alias("linked"))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         kinds: tuple[Kind, ...] = KINDS, reach: int = REACH) -> DataFrame:
    """``id_col, base, linked``: per row the strong spans and the linked weak spans, each an
    array of ``struct(start, kind, end)`` in order, ``kind`` a number in ``kinds``."""
    found = cut(parts(documents, id_col, text_col, kinds), "secret-parts")
    links = cut(linked(found, kinds, reach), "secret-links")
    empty = F.array().cast(SPAN)
    rest = found.where("not linkable").select(ID, "base", empty.alias("linked"))
    out = (found.where("linkable").join(links, "digest", "left")
           .select(ID, "base", F.coalesce("linked", empty).alias("linked")).unionByName(rest))
    return out.withColumnRenamed(ID, id_col)


def span_text(spans: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in kinds])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))))


def _oracle() -> str:
    def quoted(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    selects = []
    for n, k in enumerate(KINDS):
        ok = [f"length(regexp_extract(m, {quoted(k.pattern)}, 2)) >= {k.value_chars}"] * bool(k.value_chars)
        ok += [f"regexp_matches(m, {quoted(p)})" for p in k.holds]
        selects.append((n, k.pattern, " AND ".join(ok) or "true"))
    selects.append((BREAK, SCOPE_END, "true"))
    found = " UNION ALL ".join(f"""
SELECT r, {n} AS kind, e - length(m) AS s, e FROM (
  SELECT r, m, sum(length(m) + length(gaps[i])) OVER (PARTITION BY r ORDER BY i) AS e FROM (
    SELECT r, unnest(ms) AS m, generate_subscripts(ms, 1) AS i, gaps FROM (
      SELECT r, regexp_extract_all(text, {quoted(p)}) AS ms,
             string_split_regex(text, {quoted(p)}) AS gaps FROM d))) WHERE {ok}"""
                              for n, p, ok in selects)
    kinds = ", ".join(f"({n}, '{k.name}', {k.side == SECRET}, {k.weak})" for n, k in enumerate(KINDS))
    address = next(n for n, k in enumerate(KINDS) if k.name == "endpoint")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
k AS (SELECT * FROM (VALUES {kinds}) AS k (kind, name, secret, weak)),
f AS MATERIALIZED ({found}),
p AS (SELECT f.*, name, secret, weak,
             (SELECT count(*) FROM f b WHERE b.r = f.r AND b.kind = {BREAK} AND b.s <= f.s) AS scope
      FROM f JOIN k USING (kind)),
q AS MATERIALIZED (SELECT * FROM p WHERE NOT (secret AND weak AND EXISTS (
        SELECT 1 FROM f a WHERE a.r = p.r AND a.kind = {address} AND a.s < p.s AND a.e > p.s))),
g AS (SELECT * FROM q WHERE NOT weak OR EXISTS (
        SELECT 1 FROM q o WHERE o.r = q.r AND o.scope = q.scope AND o.secret <> q.secret
                            AND abs(o.s - q.s) <= {REACH})),
o AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
             count(*) FILTER (kind = 2) AS n_hex,
             string_agg(concat_ws(':', name, s::BIGINT, e::BIGINT), ',' ORDER BY s, kind)
               FILTER (NOT weak) AS base,
             string_agg(concat_ws(':', name, s::BIGINT, e::BIGINT), ',' ORDER BY s, kind) AS spans
      FROM g GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (r)
"""


@register("op13_secret_scan", _oracle())
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(load(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"),
                        count(2).alias("n_hex"), F.sha2(span_text(F.col("base")), 256)
                        .alias("base_sha256"),
                        span_text(F.array_sort(F.concat("base", "linked"))).alias("spans"))


__all__ = ["KINDS", "Kind", "parts", "linked", "scan", "span_text", "running_sums"]
