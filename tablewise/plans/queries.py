"""Registered queries: each reads the driver tables of one scale factor and returns a
DataFrame; most carry a DuckDB oracle text with the same output columns.

Numbers are rounded on both sides (4 places, sums 2) and times are rendered as text,
so that the compare does not depend on float summation order or time units.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewise.functions.hashing import portable_hash, row_key, unit_hash
from tablewise.functions.timeslice import hour_bucket, lenient_timestamp
from tablewise.operators import corrupt as X
from tablewise.operators.profile import label_counts, metric_specs, profile, run_specs
from tablewise.operators.sampling import bounded_sample, sample_by_class, stratified_split
from tablewise.operators.slices import latest_slice, slice_at, slice_days
from tablewise.operators.states import (profile_from_states, read_states, slot_states,
                                        write_states)
from tablewise.session import shared_dir
from tablewise.sources.publish import publish_run, read_published
from tablewise.sources.readers import read_path
from tablewise.plans.oracle_sql import (ROUND_VALUE_SQL, TABLE_COLUMNS, hash_sql,
                                        profile_sql, ts_text_sql, uhash_sql)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed query parameters
AT = dt.datetime(2024, 1, 30, 10, 0, 0)   # slice time on the events table
GRAIN = "hour"                            # events has about 0-4 rows per minute slot
N_DAYS = 3
SAMPLE_FRAC = 0.5
SEED = 42
TEST_SHARE = 0.2
SHAP_ROWS = 5000
SALT = 7
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A2: a table of one scale factor."""
    return read_path(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")


def rounded(df: DataFrame) -> DataFrame:
    """Same rounding as ROUND_VALUE_SQL."""
    return df.withColumn("value", F.when(F.col("name") == "Sum", F.round("value", 2))
                         .otherwise(F.round("value", 4)) + F.lit(0.0))


def ts_text(c) -> F.Column:
    return F.date_format(c, TS_FMT)


def _ts_lit(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _slot_sql(col: str, at: dt.datetime, n_days: int) -> str:
    ranges = []
    for i in range(n_days):
        lo = at - dt.timedelta(days=i)
        hi = lo + dt.timedelta(hours=1)
        ranges.append(f"({col} >= {_ts_lit(lo)} AND {col} < {_ts_lit(hi)})")
    return "(" + " OR ".join(ranges) + ")"


# ---------------------------------------------------------------- D: profiles

def _profile_query(table: str):
    def q(spark, sf_dir):
        return rounded(profile(load(spark, sf_dir, table), approx_distinct=False))
    return q


for _t in ("events", "lineitem", "documents"):
    register(f"profile_{_t}", profile_sql(_t, TABLE_COLUMNS[_t]))(_profile_query(_t))


@register("approx_distinct_lineitem", """
WITH ex AS (
  SELECT * FROM (UNPIVOT (SELECT CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS l_orderkey,
      CAST(count(DISTINCT l_partkey) AS DOUBLE) AS l_partkey,
      CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS l_suppkey,
      CAST(count(DISTINCT l_linenumber) AS DOUBLE) AS l_linenumber,
      CAST(count(DISTINCT l_quantity) AS DOUBLE) AS l_quantity,
      CAST(count(DISTINCT l_extendedprice) AS DOUBLE) AS l_extendedprice,
      CAST(count(DISTINCT l_discount) AS DOUBLE) AS l_discount,
      CAST(count(DISTINCT l_tax) AS DOUBLE) AS l_tax,
      CAST(count(DISTINCT l_returnflag) AS DOUBLE) AS l_returnflag,
      CAST(count(DISTINCT l_linestatus) AS DOUBLE) AS l_linestatus,
      CAST(count(DISTINCT l_shipdate) AS DOUBLE) AS l_shipdate FROM lineitem)
    ON COLUMNS(*) INTO NAME instance VALUE exact))
SELECT instance, exact, true AS within_10pct FROM ex
""")
def approx_distinct_lineitem(spark, sf_dir):
    """D3: the HLL++ estimate is within 10 % of the exact distinct count, per column."""
    li = load(spark, sf_dir, "lineitem")
    sketches = [m for m in metric_specs(li.schema) if m.name == "ApproxCountDistinct"]
    approx = run_specs(li, sketches).select("instance", F.col("value").alias("approx"))
    # every distinct (column, value) once, then counted
    exact = (li.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("instance"), F.col(c).cast("string").alias("v"))
        for c in li.columns]))).where("v is not null").distinct()
        .groupBy("instance").agg(F.count("*").cast("double").alias("exact")))
    return (approx.join(exact, "instance")
            .select("instance", "exact",
                    (F.abs(F.col("approx") - F.col("exact")) <= 0.1 * F.col("exact"))
                    .alias("within_10pct")))


@register("profile_array_column", profile_sql(
    "(SELECT vec_id, CAST(len(embedding) AS DOUBLE) AS embedding, label FROM embeddings)",
    [("vec_id", "num"), ("embedding", "num"), ("label", "num")]))
def profile_array_column(spark, sf_dir):
    """D2 + B15: the array column profiled through its length feature."""
    emb = load(spark, sf_dir, "embeddings")
    feat = emb.select("vec_id", F.when(F.col("embedding").isNotNull(), F.size("embedding"))
                      .cast("double").alias("embedding"), "label")
    return rounded(profile(feat, approx_distinct=False))


_THREE_DAYS_SQL = (f"(SELECT *, CASE WHEN ts >= {_ts_lit(AT)} THEN 1 ELSE 0 END AS label "
                   f"FROM events WHERE {_slot_sql('ts', AT, N_DAYS)})")


@register("profile_from_states", profile_sql(
    "(SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-28' AND ts < TIMESTAMP '2024-01-31')",
    TABLE_COLUMNS["events"]))
def profile_from_states_q(spark, sf_dir):
    """The profile of three days merged from stored states of the days; one day is written
    twice, and its second state counts."""
    ev = load(spark, sf_dir, "events")
    path = shared_dir(spark, "states")
    day = F.to_date("ts")
    write_states(slot_states(ev.where(day <= F.lit("2024-01-29")), "ts"), path)
    write_states(slot_states(ev.where((day == F.lit("2024-01-30")) & (F.col("event_id") % 2 == 0)), "ts"),
                 path)
    write_states(slot_states(ev.where(day >= F.lit("2024-01-30")), "ts"), path)
    days = [dt.datetime(2024, 1, d) for d in (28, 29, 30)]
    found = profile_from_states(read_states(spark, path, days))
    return rounded(found.where("name <> 'ApproxCountDistinct'"))


@register("profile_by_label", profile_sql(_THREE_DAYS_SQL, TABLE_COLUMNS["events"],
                                          group="label"))
def profile_by_label(spark, sf_dir):
    """D16 + B9: profile of every day of the three-day slice, one scan, grouped by label."""
    sl = slice_days(load(spark, sf_dir, "events"), "ts", AT, GRAIN, N_DAYS)
    return rounded(profile(sl, approx_distinct=False, group_by=["label"]))


# ---------------------------------------------------------------- B: slices

@register("slice_at_hour", f"""
SELECT event_id, {ts_text_sql('ts')} AS ts, user_id, event_type, value, props,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS date_hour
FROM events WHERE {_slot_sql('ts', AT, 1)}
""")
def slice_at_hour(spark, sf_dir):
    """One hour slot of one day, as a pushed-down range."""
    sl = slice_at(load(spark, sf_dir, "events"), "ts", AT, GRAIN)
    return sl.select("event_id", ts_text("ts").alias("ts"), "user_id", "event_type", "value",
                     "props",
                     F.date_format(hour_bucket("ts"), "yyyy-MM-dd HH:mm:ss").alias("date_hour"))


@register("slice_three_days", f"""
SELECT event_id, {ts_text_sql('ts')} AS ts, label FROM {_THREE_DAYS_SQL} AS s
""")
def slice_three_days(spark, sf_dir):
    """B6 + B9: the same slot on three days, label 1 on the newest."""
    sl = slice_days(load(spark, sf_dir, "events"), "ts", AT, GRAIN, N_DAYS)
    return sl.select("event_id", ts_text("ts").alias("ts"), "label")


@register("latest_slice", f"""
WITH m AS (SELECT date_trunc('hour', max(ts)) AS s FROM events)
SELECT event_id, {ts_text_sql('ts')} AS ts, CASE WHEN ts >= m.s THEN 1 ELSE 0 END AS label
FROM events, m
WHERE (ts >= m.s AND ts < m.s + INTERVAL 1 HOUR)
   OR (ts >= m.s - INTERVAL 1 DAY AND ts < m.s - INTERVAL 1 DAY + INTERVAL 1 HOUR)
""")
def latest_slice_q(spark, sf_dir):
    """A3 + B7 + B8 + D14: newest hour slot and the same slot the day before."""
    sl = latest_slice(load(spark, sf_dir, "events"), "ts", GRAIN, n_days=2)
    return sl.select("event_id", ts_text("ts").alias("ts"), "label")


@register("label_counts", f"""
SELECT count(*) AS n_total, CAST(count_if(label = 1) AS BIGINT) AS n_current,
       CAST(count_if(label = 0) AS BIGINT) AS n_previous,
       CAST(count_if(label = 1 AND {uhash_sql('event_id', f'sample:{SEED}')} < {SAMPLE_FRAC})
         AS BIGINT) AS n_sampled_current,
       CAST(count_if(label = 0 AND {uhash_sql('event_id', f'sample:{SEED}')} < {SAMPLE_FRAC})
         AS BIGINT) AS n_sampled_previous
FROM {_THREE_DAYS_SQL} AS s
""")
def label_counts_q(spark, sf_dir):
    """D13 + D15: class counts of the slice and of its sample, in one aggregate."""
    sl = slice_days(load(spark, sf_dir, "events"), "ts", AT, GRAIN, N_DAYS)
    kept = unit_hash("event_id", f"sample:{SEED}") < F.lit(SAMPLE_FRAC)
    lab = F.col("label")
    return label_counts(sl, extra=[F.count_if((lab == 1) & kept).alias("n_sampled_current"),
                                   F.count_if((lab == 0) & kept).alias("n_sampled_previous")])


_SPOILT_SQL = f"""(SELECT event_id,
  CASE WHEN {uhash_sql('event_id', 'spoil')} < 0.1 THEN 'not a time ' || CAST(event_id AS VARCHAR)
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text FROM events)"""


@register("lenient_cast", f"""
SELECT event_id, ts_text,
       strftime(TRY_CAST(ts_text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts_parsed
FROM {_SPOILT_SQL} AS s
""")
def lenient_cast(spark, sf_dir):
    """B1: text times, a tenth of them spoilt by a hash; bad text becomes null."""
    ev = load(spark, sf_dir, "events")
    spoilt = F.when(unit_hash("event_id", "spoil") < F.lit(0.1),
                    F.concat(F.lit("not a time "), F.col("event_id").cast("string"))) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    txt = ev.select("event_id", spoilt.alias("ts_text"))
    return txt.select("event_id", "ts_text",
                      F.date_format(lenient_timestamp("ts_text"), "yyyy-MM-dd HH:mm:ss")
                      .alias("ts_parsed"))


# ---------------------------------------------------------------- X: corruption

_ORD_TEXT = ("o_orderstatus", "o_orderpriority")
_ORD_NUM = ("o_totalprice",)


def _hit_sql(key, col, frac=0.5):
    return f"{uhash_sql(key, f'{SALT}:hit:{col}')} < {frac}"


def _suffix_sql(key, col, n):
    return (f"'_' || translate(substr(md5(CAST({key} AS VARCHAR) || ':{SALT}:suffix:{col}'), 1, {n}),"
            f" '0123456789abcdef', 'ABCXYZ0123456789')")


def _gauss_sql(key, col):
    u1 = uhash_sql(key, f"{SALT}:u1:{col}")
    u2 = uhash_sql(key, f"{SALT}:u2:{col}")
    return (f"(50.0 + 20.0 * sqrt(-2.0 * ln(1.0 - {u1})) * cos(6.283185307179586 * {u2}))")


@register("corrupt_null", f"""
SELECT o_orderkey,
  {', '.join(f"CASE WHEN {_hit_sql('o_orderkey', c)} THEN NULL ELSE {c} END AS {c}"
             for c in _ORD_TEXT + _ORD_NUM)}
FROM orders
""")
def corrupt_null(spark, sf_dir):
    """X2 + X3: half of the rows of three columns nulled."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", *[X.corrupt_column(o, c, "o_orderkey", "null", 0.5, salt=SALT)
                                    for c in _ORD_TEXT + _ORD_NUM])


def _exact_sql(col, frac):
    place = (f"{hash_sql('o_orderkey', f'{SALT}:hit:{col}')} * 2147483648 + "
             f"({hash_sql('o_orderkey', f'{SALT}:tie:{col}')} >> 1)")
    return f"row_number() OVER (ORDER BY {place}) <= floor(count(*) OVER () * {frac})"


@register("corrupt_exact", f"""
SELECT o_orderkey,
  {', '.join(f"CASE WHEN {_exact_sql(c, 0.3)} THEN NULL ELSE {c} END AS {c}"
             for c in _ORD_TEXT + _ORD_NUM)}
FROM orders
""")
def corrupt_exact(spark, sf_dir):
    """X2 with exact counts + X3: int(n * 0.3) rows of each of three columns nulled."""
    o = load(spark, sf_dir, "orders")
    cols = _ORD_TEXT + _ORD_NUM
    limits = X.exact_limits(o, cols, "o_orderkey", 0.3, salt=SALT)
    return o.select("o_orderkey", *[X.corrupt_column(o, c, "o_orderkey", "null", salt=SALT,
                                                     limits=limits) for c in cols])


@register("corrupt_suffix", f"""
SELECT o_orderkey,
  {', '.join(f"CASE WHEN {_hit_sql('o_orderkey', c)} THEN coalesce({c}, '') || {_suffix_sql('o_orderkey', c, 4)} ELSE {c} END AS {c}"
             for c in _ORD_TEXT)}
FROM orders
""")
def corrupt_suffix(spark, sf_dir):
    """X2 + X4: a random 4-character suffix on half of the text values."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", *[X.corrupt_column(o, c, "o_orderkey", "suffix", 0.5,
                                                     salt=SALT, suffix_len=4)
                                    for c in _ORD_TEXT])


@register("corrupt_gauss", f"""
SELECT o_orderkey,
  CASE WHEN {_hit_sql('o_orderkey', 'o_totalprice')}
       THEN round(o_totalprice + {_gauss_sql('o_orderkey', 'o_totalprice')}, 2)
       ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def corrupt_gauss(spark, sf_dir):
    """X2 + X5: N(50, 20) noise, rounded to cents."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", X.corrupt_column(o, "o_totalprice", "o_orderkey", "gauss",
                                                   0.5, salt=SALT))


@register("corrupt_shift", f"""
SELECT event_id,
  CASE WHEN {_hit_sql('event_id', 'user_id')}
       THEN user_id + 100 + {hash_sql('event_id', f'{SALT}:shift:user_id')} % 900
       ELSE user_id END AS user_id
FROM events
""")
def corrupt_shift(spark, sf_dir):
    """X2 + X6: integer shift in [100, 1000) on half of the rows."""
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", X.corrupt_column(ev, "user_id", "event_id", "shift", 0.5,
                                                  salt=SALT))


def _mixed_sql():
    key = "o_orderkey"
    cols = []
    for c in _ORD_TEXT:
        nul = f"{uhash_sql(key, f'{SALT}:null:{c}')} < 0.5"
        cols.append(f"CASE WHEN {_hit_sql(key, c)} AND {nul} THEN NULL "
                    f"WHEN {_hit_sql(key, c)} THEN coalesce({c}, '') || {_suffix_sql(key, c, 4)} "
                    f"ELSE {c} END AS {c}")
    for c in _ORD_NUM:
        nul = f"{uhash_sql(key, f'{SALT}:null:{c}')} < 0.5"
        cols.append(f"CASE WHEN {_hit_sql(key, c)} AND {nul} THEN NULL "
                    f"WHEN {_hit_sql(key, c)} THEN round({c} + {_gauss_sql(key, c)}, 2) "
                    f"ELSE {c} END AS {c}")
    return ("SELECT o_orderkey, o_custkey, " + ", ".join(cols) +
            f", {ts_text_sql('o_orderdate')} AS o_orderdate FROM orders")


CORRUPT_ORDERS_SQL = _mixed_sql()


def corrupted_orders(spark, sf_dir) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return X.corrupt(o, _ORD_TEXT + _ORD_NUM, "o_orderkey", frac=0.5, null_share=0.5,
                     scheme="gauss", salt=SALT)


@register("corrupt_mixed", CORRUPT_ORDERS_SQL)
def corrupt_mixed(spark, sf_dir):
    """X2-X5 together: per hit row a coin chooses null or suffix / noise."""
    c = corrupted_orders(spark, sf_dir)
    return c.select("o_orderkey", "o_custkey", *_ORD_TEXT, *_ORD_NUM,
                    ts_text("o_orderdate").alias("o_orderdate"))


# ---------------------------------------------------------------- F: sampling

@register("hash_sample", f"""
SELECT event_id, label FROM {_THREE_DAYS_SQL} AS s
WHERE {uhash_sql('event_id', f'sample:{SEED}')} < {SAMPLE_FRAC}
""")
def hash_sample(spark, sf_dir):
    """Per-class sample of the labelled slice, one pass."""
    sl = slice_days(load(spark, sf_dir, "events"), "ts", AT, GRAIN, N_DAYS)
    return sample_by_class(sl, "label", {0: SAMPLE_FRAC, 1: SAMPLE_FRAC}, SEED,
                           method="hash", key="event_id").select("event_id", "label")


@register("stratified_split", f"""
WITH h AS (SELECT doc_id, quality, {hash_sql('doc_id', f'split:{SEED}')} AS h FROM labels),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, CAST(doc_id AS VARCHAR)) AS rn,
             count(*) OVER (PARTITION BY quality) AS n FROM h)
SELECT doc_id, quality, rn <= round(n * {TEST_SHARE}) AS is_test FROM r
""")
def stratified_split_q(spark, sf_dir):
    """exact 20 % test share per class."""
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality")
    return stratified_split(lab, "quality", "doc_id", TEST_SHARE, SEED)


@register("bounded_sample", f"""
SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS k
  FROM lineitem) AS s
ORDER BY {hash_sql('k', f'bounded:{SEED}')}, k LIMIT {SHAP_ROWS}
""")
def bounded_sample_q(spark, sf_dir):
    """at most 5,000 rows chosen by hash (a top-k, memory bounded by k)."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", row_key("l_orderkey", "l_linenumber").alias("k"))
    return bounded_sample(li, SHAP_ROWS, "k", SEED).select("l_orderkey", "l_linenumber")


# a seventh of the rows has no key, the others share it in threes; rows of a key are equal
_NULL_KEYS_SQL = ("(SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id // 3 END AS k, "
                  "CAST(event_id % 2 AS INTEGER) AS label FROM events)")
_KEY_TEXT_SQL = "coalesce(CAST(k AS VARCHAR), 'null||' || CAST(label AS VARCHAR))"


def _null_keys(spark, sf_dir) -> DataFrame:
    i = F.col("event_id")
    return load(spark, sf_dir, "events").select(
        F.when(i % 7 != 0, F.floor(i / 3)).alias("k"), (i % 2).cast("int").alias("label"))


@register("split_null_keys", f"""
WITH h AS (SELECT *, {_KEY_TEXT_SQL} AS t FROM {_NULL_KEYS_SQL} AS s),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {hash_sql('t', f'split:{SEED}')}, t)
             AS rn, count(*) OVER (PARTITION BY label) AS n FROM h)
SELECT coalesce(k, -1) AS k, label, rn <= round(n * {TEST_SHARE}) AS is_test FROM r
""")
def split_null_keys(spark, sf_dir):
    """F4 with null and repeated keys: no row is lost and the quotas are exact."""
    out = stratified_split(_null_keys(spark, sf_dir), "label", "k", TEST_SHARE, SEED)
    return out.select(F.coalesce("k", F.lit(-1)).alias("k"), "label", "is_test")


@register("sample_null_keys", f"""
SELECT coalesce(k, -1) AS k, label FROM (SELECT *, {_KEY_TEXT_SQL} AS t FROM {_NULL_KEYS_SQL} AS s)
WHERE {uhash_sql('t', f'sample:{SEED}')} < {SAMPLE_FRAC}
""")
def sample_null_keys(spark, sf_dir):
    """F1 with null keys: rows without a key are sampled by their content."""
    out = sample_by_class(_null_keys(spark, sf_dir), "label", SAMPLE_FRAC, SEED, key="k")
    return out.select(F.coalesce("k", F.lit(-1)).alias("k"), "label")


__all__ = ["QUERIES", "ORACLES", "register", "load", "rounded", "ROUND_VALUE_SQL", "AT",
           "GRAIN", "N_DAYS", "corrupted_orders", "CORRUPT_ORDERS_SQL"]


# ---------------------------------------------------------------- B12-B18: features

from tablewise.operators.features import (FOLDS, category_table, encode, label_rates,  # noqa: E402
                                          plan_features, with_rates)

MAX_CATS = 62


def _cat_code_sql(table_alias: str, col: str, ranked: str = "t", counts: str = "m") -> str:
    return (f"CAST(CASE WHEN {table_alias}.{col} IS NULL THEN {counts}_{col}.m + 1 "
            f"WHEN {ranked}_{col}.code IS NOT NULL THEN {ranked}_{col}.code "
            f"ELSE {counts}_{col}.m END AS DOUBLE) AS {col}")


def _topk_cte(src: str, cols) -> str:
    freq = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {src} "
        f"WHERE {c} IS NOT NULL GROUP BY 2" for c in cols)
    return (f"f AS ({freq}), "
            f"r AS (SELECT col, value, n, row_number() OVER (PARTITION BY col ORDER BY n DESC, value)"
            f" - 1 AS code FROM f), "
            f"t AS (SELECT * FROM r WHERE code < {MAX_CATS}), "
            f"m AS (SELECT col, count(*) AS m FROM t GROUP BY col)")


def _encoded_sql(src: str, key: str, nums, cats) -> str:
    joins = []
    for c in cats:
        joins.append(f"LEFT JOIN (SELECT value, code FROM t WHERE col = '{c}') AS t_{c} "
                     f"ON t_{c}.value = CAST(e.{c} AS VARCHAR)")
        joins.append(f"CROSS JOIN (SELECT m FROM m WHERE col = '{c}') AS m_{c}")
    sel = [f"e.{key}"] + [f"CAST(e.{c} AS DOUBLE) AS {c}" for c in nums] + \
          [_cat_code_sql("e", c) for c in cats]
    return (f"WITH {_topk_cte(src, cats)} SELECT {', '.join(sel)} FROM {src} AS e "
            + " ".join(joins))


@register("feature_table", _encoded_sql("events", "event_id", ["user_id", "value"],
                                        ["event_type", "props"]))
def feature_table(spark, sf_dir):
    """Events as model features (ids and times dropped, text as codes)."""
    ev = load(spark, sf_dir, "events")
    plan = plan_features(ev, keep=["event_id"], max_categories=MAX_CATS)
    return encode(ev, plan, keep=["event_id"], vector_col=None)


_FOLD_SQL = hash_sql("key", "fold") + f" % {FOLDS}"
_RATE_COLS = ("props", "source")
_RATE_SRC_SQL = f"""
WITH s AS (SELECT 'e' || CAST(event_id AS VARCHAR) AS key, props, event_type AS source,
                  CAST(ts >= {_ts_lit(AT)} AS INTEGER) AS label FROM events
           UNION ALL
           SELECT 'd' || CAST(doc_id AS VARCHAR), substr(text, 1, 4), source,
                  CAST(n_chars > 2000 AS INTEGER) FROM documents),
b AS (SELECT *, {_FOLD_SQL} AS fold, {uhash_sql('key', 'test')} < {TEST_SHARE} AS is_test FROM s)"""


def _rate_sql(c: str) -> str:
    own = f"CASE WHEN b.is_test THEN 0 ELSE coalesce({c}_f.{{0}}, 0) END"
    return (f"round((coalesce({c}_t.n1, 0) - {own.format('n1')} + 5.0) / "
            f"(coalesce({c}_t.n, 0) - {own.format('n')} + 10.0), 9) AS {c}")


def _rate_joins(c: str) -> str:
    agg = f"SELECT {c} AS v, {{0}}count(*) AS n, sum(label) AS n1 FROM b WHERE NOT is_test GROUP BY ALL"
    return (f"LEFT JOIN ({agg.format('')}) AS {c}_t ON {c}_t.v IS NOT DISTINCT FROM b.{c} "
            f"LEFT JOIN ({agg.format('fold, ')}) AS {c}_f "
            f"ON {c}_f.v IS NOT DISTINCT FROM b.{c} AND {c}_f.fold = b.fold ")


@register("feature_table_all_values", f"""{_RATE_SRC_SQL}
SELECT key, {', '.join(_rate_sql(c) for c in _RATE_COLS)}
FROM b {' '.join(_rate_joins(c) for c in _RATE_COLS)}
""")
def feature_table_all_values(spark, sf_dir):
    """Every value of text columns with far more than 62 values, by smoothed label rate."""
    ev, docs = load(spark, sf_dir, "events"), load(spark, sf_dir, "documents")
    s = ev.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("key"), "props",
                  F.col("event_type").alias("source"),
                  (F.col("ts") >= F.lit(str(AT)).cast("timestamp_ntz")).cast("int").alias("label"))
    s = s.unionByName(docs.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"),
        F.substring("text", 1, 4).alias("props"), "source",
        (F.col("n_chars") > 2000).cast("int").alias("label")))
    train, fold = unit_hash("key", "test") >= TEST_SHARE, portable_hash("key", "fold") % FOLDS
    out = with_rates(s, label_rates(s, _RATE_COLS, "label", fold, train), _RATE_COLS, fold, train,
                     base=0.5)
    return out.select("key", *[F.round(f"{c}__rate", 9).alias(c) for c in _RATE_COLS])


@register("feature_options", _encoded_sql(
    "(SELECT event_id, value, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events)",
    "event_id", ["value"], ["event_type", "ts"]))
def feature_options(spark, sf_dir):
    """A column left out by name, one by prefix, times as text categories."""
    ev = load(spark, sf_dir, "events")
    plan = plan_features(ev, keep=["event_id"], exclude=["user_id"], exclude_prefixes=["pro"],
                         time_as_category=True, max_categories=MAX_CATS)
    return encode(ev, plan, keep=["event_id"], vector_col=None)


@register("array_feature", """
SELECT vec_id, CAST(len(embedding) AS DOUBLE) AS embedding FROM embeddings
""")
def array_feature(spark, sf_dir):
    """An array column as its length."""
    emb = load(spark, sf_dir, "embeddings")
    return encode(emb, plan_features(emb, keep=["vec_id"]), keep=["vec_id"], vector_col=None)


_EV_NULLED_SQL = ("(SELECT event_id, " + ", ".join(
    f"CASE WHEN {_hit_sql('event_id', c)} AND {uhash_sql('event_id', f'{SALT}:null:{c}')} < 0.5 "
    f"THEN NULL WHEN {_hit_sql('event_id', c)} THEN round({c} + {_gauss_sql('event_id', c)}, 2) "
    f"ELSE CAST({c} AS DOUBLE) END AS {c}" for c in ("user_id", "value")) + " FROM events)")


@register("null_indicator", f"""
SELECT event_id,
  coalesce(user_id, 0.0) AS user_id, CASE WHEN user_id IS NULL THEN 1.0 ELSE 0.0 END AS user_id__isnull,
  coalesce(value, 0.0) AS value, CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END AS value__isnull
FROM {_EV_NULLED_SQL} AS s
""")
def null_indicator(spark, sf_dir):
    """Corrupted numbers -> filled value + null indicator."""
    ev = load(spark, sf_dir, "events").select("event_id", "user_id", "value")
    bad = X.corrupt(ev, ["user_id", "value"], "event_id", frac=0.5, null_share=0.5,
                    scheme="gauss", salt=SALT)
    plan = plan_features(bad, keep=["event_id"])
    return encode(bad, plan, keep=["event_id"], vector_col=None)


@register("category_topk", f"""
WITH {_topk_cte('part', ['p_name', 'p_brand', 'p_type'])}
SELECT col AS "column", value, n, CAST(code AS INTEGER) AS code FROM t
""")
def category_topk(spark, sf_dir):
    """The 62 most frequent values per text column with their codes."""
    part = load(spark, sf_dir, "part")
    return category_table(part, ["p_name", "p_brand", "p_type"], MAX_CATS)


# ---------------------------------------------------------------- E: suggestions

from tablewise.operators.suggest import (SUGGESTION_FIELDS, check_suggestions, column_profile,  # noqa: E402
                                         grouped, suggest,
                                         suggest_from_profile)
from tablewise.plans.oracle_sql import SUGGEST_KINDS, suggest_sql  # noqa: E402

_COMPARED = SUGGESTION_FIELDS + ["sql_predicate"]
_FIELDS_SQL = ", ".join(_COMPARED)


def _suggest_query(table_fn, rule=None, with_rule=False):
    def q(spark, sf_dir):
        s = suggest(table_fn(spark, sf_dir))
        if rule:
            s = s.filter(F.col("rule") == rule)
        cols = _COMPARED + (["rule"] if with_rule else [])
        return s.select(*cols)
    return q


def _orders(spark, sf_dir):
    return load(spark, sf_dir, "orders")


def _part(spark, sf_dir):
    return load(spark, sf_dir, "part")


def _events_k(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type")


_EVENTS_K_SQL = ("(SELECT event_id, json_extract_string(props, '$.k') AS k, event_type "
                 "FROM events)")


def _rule_sql(src, kinds, rule=None, extra=""):
    where = f"WHERE rule = '{rule}'" if rule else ""
    return f"SELECT {_FIELDS_SQL}{extra} FROM ({suggest_sql(src, kinds)}) AS s {where}"


register("suggest_complete", _rule_sql("orders", SUGGEST_KINDS["orders"], "complete"))(
    _suggest_query(_orders, "complete"))
register("suggest_retain_completeness",
         _rule_sql(f"({CORRUPT_ORDERS_SQL})", SUGGEST_KINDS["orders"], "completeness"))(
    _suggest_query(corrupted_orders, "completeness"))
register("suggest_type", _rule_sql(_EVENTS_K_SQL, SUGGEST_KINDS["events_k"], "type"))(
    _suggest_query(_events_k, "type"))
register("suggest_categorical", _rule_sql("orders", SUGGEST_KINDS["orders"], "categorical"))(
    _suggest_query(_orders, "categorical"))
register("suggest_fractional_categorical",
         _rule_sql("part", SUGGEST_KINDS["part"], "fractional_categorical"))(
    _suggest_query(_part, "fractional_categorical"))
register("suggestions_flat", _rule_sql("orders", SUGGEST_KINDS["orders"], extra=", rule"))(
    _suggest_query(_orders, with_rule=True))


@register("suggest_non_negative", f"""
SELECT 'customer' AS "table", * FROM ({_rule_sql('customer', SUGGEST_KINDS['customer'], 'non_negative')}) AS a
UNION ALL
SELECT 'lineitem', * FROM ({_rule_sql('lineitem', SUGGEST_KINDS['lineitem'], 'non_negative')}) AS b
""")
def suggest_non_negative(spark, sf_dir):
    """E9 on two tables (customer has negative balances, so no rule for c_acctbal)."""
    parts = []
    for t in ("customer", "lineitem"):
        s = suggest(load(spark, sf_dir, t)).filter(F.col("rule") == "non_negative")
        parts.append(s.select(F.lit(t).alias("table"), *_COMPARED))
    return parts[0].unionByName(parts[1])


@register("suggestions_grouped", f"""
SELECT column_name AS "column", count(*) AS n_suggestions,
       string_agg(code_for_constraint, '; ' ORDER BY code_for_constraint) AS codes
FROM ({suggest_sql('orders', SUGGEST_KINDS['orders'])}) AS s GROUP BY column_name
""")
def suggestions_grouped(spark, sf_dir):
    """Suggestions grouped by column."""
    g = grouped(suggest(_orders(spark, sf_dir)))
    return g.select("column", F.size("suggestions").cast("bigint").alias("n_suggestions"),
                    F.array_join(F.transform("suggestions", lambda s: s["codeForConstraint"]),
                                 "; ").alias("codes"))


def _check_sql():
    kinds = SUGGEST_KINDS["orders"]
    longs = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS v, "
        f"{'TRY_CAST(' + c + ' AS DOUBLE)' if k in ('integral', 'fractional') else 'NULL::DOUBLE'} AS d "
        f"FROM bad" for c, k in kinds)
    vals = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM orders "
        f"WHERE {c} IS NOT NULL" for c, k in kinds if k == "string")
    return f"""
WITH rules AS ({suggest_sql('orders', kinds)}),
bad AS ({CORRUPT_ORDERS_SQL}),
vals AS ({vals}),
long AS ({longs})
SELECT r.column_name, r.rule,
  round(avg(CASE r.rule
    WHEN 'complete' THEN CASE WHEN l.v IS NOT NULL THEN 1.0 ELSE 0.0 END
    WHEN 'completeness' THEN CASE WHEN l.v IS NOT NULL THEN 1.0 ELSE 0.0 END
    WHEN 'non_negative' THEN CASE WHEN l.v IS NULL OR l.d >= 0 THEN 1.0 ELSE 0.0 END
    WHEN 'categorical' THEN CASE WHEN l.v IS NULL OR l.v IN
        (SELECT value FROM vals WHERE vals.col = r.column_name) THEN 1.0 ELSE 0.0 END
  END), 4) + 0.0 AS pass_fraction,
  avg(CASE r.rule
    WHEN 'complete' THEN CASE WHEN l.v IS NOT NULL THEN 1.0 ELSE 0.0 END
    WHEN 'completeness' THEN CASE WHEN l.v IS NOT NULL THEN 1.0 ELSE 0.0 END
    WHEN 'non_negative' THEN CASE WHEN l.v IS NULL OR l.d >= 0 THEN 1.0 ELSE 0.0 END
    WHEN 'categorical' THEN CASE WHEN l.v IS NULL OR l.v IN
        (SELECT value FROM vals WHERE vals.col = r.column_name) THEN 1.0 ELSE 0.0 END
  END) >= max(r.min_fraction) AS passed
FROM rules r JOIN long l ON l.col = r.column_name
GROUP BY r.column_name, r.rule
"""


@register("check_suggestions", _check_sql())
def check_suggestions_q(spark, sf_dir):
    """Rules learnt on clean orders, checked on corrupted orders."""
    rules = suggest(_orders(spark, sf_dir))
    res = check_suggestions(corrupted_orders(spark, sf_dir), rules)
    return res.select("column_name", "rule",
                      (F.round("pass_fraction", 4) + F.lit(0.0)).alias("pass_fraction"), "passed")


_TEXTS = ("a\\b", "it's", 'x"y', "tail\\")        # values with marks that predicates must escape
_TEXT_SQL = ("CASE o_orderkey % 4 " + " ".join(
    f"WHEN {i} THEN '{v}'".replace("'s'", "''s'") for i, v in enumerate(_TEXTS)) + " END")
_TEXT_BAD_SQL = f"""(SELECT o_orderkey,
  CASE WHEN {uhash_sql('o_orderkey', 'text')} < 0.25 THEN {_TEXT_SQL} || '\\' ELSE {_TEXT_SQL} END AS t,
  CASE WHEN {uhash_sql('o_orderkey', 'num')} < 0.1 THEN 'n/a'
       WHEN {uhash_sql('o_orderkey', 'num')} < 0.2 THEN '-' || CAST(o_custkey AS VARCHAR)
       WHEN {uhash_sql('o_orderkey', 'num')} < 0.3 THEN NULL
       ELSE CAST(o_custkey AS VARCHAR) END AS num FROM orders)"""


@register("check_suggestions_text", f"""
SELECT c AS column_name, rule, round(share, 6) AS pass_fraction, share >= 1.0 AS passed FROM (
  SELECT 'o_orderkey' AS c, 'complete' AS rule, avg(CAST(o_orderkey IS NOT NULL AS DOUBLE)) AS share
  FROM {_TEXT_BAD_SQL} AS a UNION ALL
  SELECT 'o_orderkey', 'non_negative', avg(CAST(o_orderkey >= 0 AS DOUBLE)) FROM {_TEXT_BAD_SQL} AS b
  UNION ALL SELECT 't', 'complete', avg(CAST(t IS NOT NULL AS DOUBLE)) FROM {_TEXT_BAD_SQL} AS c
  UNION ALL SELECT 't', 'categorical', avg(CAST(t IN (SELECT {_TEXT_SQL} FROM orders) AS DOUBLE))
  FROM {_TEXT_BAD_SQL} AS d
  UNION ALL SELECT 'num', 'complete', avg(CAST(num IS NOT NULL AS DOUBLE)) FROM {_TEXT_BAD_SQL} AS e
  UNION ALL SELECT 'num', 'type', avg(CAST(num IS NULL OR regexp_full_match(num, '[+-]?[0-9]+')
                                           AS DOUBLE)) FROM {_TEXT_BAD_SQL} AS f
  UNION ALL SELECT 'num', 'non_negative', avg(CAST(num IS NULL OR
      coalesce(TRY_CAST(num AS DOUBLE) >= 0, false) AS DOUBLE)) FROM {_TEXT_BAD_SQL} AS g) AS r
""")
def check_suggestions_text(spark, sf_dir):
    """E7, E9, E13 on values with quotes and backslashes and on text that is no number."""
    o = load(spark, sf_dir, "orders")
    t = F.element_at(F.array(*[F.lit(v) for v in _TEXTS]), (F.col("o_orderkey") % 4).cast("int") + 1)
    num = F.col("o_custkey").cast("string")
    u, v = unit_hash("o_orderkey", "text"), unit_hash("o_orderkey", "num")
    bad = o.select("o_orderkey", F.when(u < 0.25, F.concat(t, F.lit("\\"))).otherwise(t).alias("t"),
                   F.when(v < 0.1, F.lit("n/a")).when(v < 0.2, F.concat(F.lit("-"), num))
                   .when(v >= 0.3, num).alias("num"))
    rules = suggest(o.select("o_orderkey", t.alias("t"), num.alias("num")))
    return check_suggestions(bad, rules).select(
        "column_name", "rule", F.round("pass_fraction", 6).alias("pass_fraction"), "passed")


# ---------------------------------------------------------------- M4-M8, M11: metrics

from tablewise.operators.metrics import confusion, metric_rows, rates, roc_auc  # noqa: E402


@register("confusion_metrics", """
WITH c AS (SELECT count_if(quality = 1 AND toxic = 1) AS tp, count_if(quality = 0 AND toxic = 1) AS fp,
                  count_if(quality = 1 AND toxic = 0) AS fn, count_if(quality = 0 AND toxic = 0) AS tn
           FROM labels),
r AS (SELECT
  coalesce((tp + tn) / nullif(CAST(tp + fp + fn + tn AS DOUBLE), 0), 0.0) AS accuracy,
  coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
  coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
  coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1_score FROM c)
SELECT 'labels' AS "table", 'MLMetric' AS type, NULL::VARCHAR AS "column", metric,
       round(value, 6) AS value
FROM (UNPIVOT r ON accuracy, precision, recall, f1_score INTO NAME metric VALUE value)
""")
def confusion_metrics(spark, sf_dir):
    """M5-M8 + M11: quality is the truth, toxic the prediction."""
    lab = load(spark, sf_dir, "labels")
    r = rates(confusion(lab, "quality", "toxic"))
    rows = metric_rows(r, ["accuracy", "precision", "recall", "f1_score"], "labels")
    return rows.withColumn("value", F.round("value", 6))


@register("roc_auc", """
WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS score, l.quality AS y
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
g AS (SELECT score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM s
      WHERE score IS NOT NULL GROUP BY score),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM r
""")
def roc_auc_q(spark, sf_dir):
    """M4: AUC of document length as a score for quality (labels joined to documents)."""
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars")
    scored = lab.join(docs, "doc_id")
    # small ranges so that the multi-range path runs on the small tables too
    return roc_auc(scored, "quality", "n_chars", buckets=16, range_rows=50).select(
        F.round("roc_auc", 6).alias("roc_auc"))


# Text columns with 115 to 125 values around the limit of 120, one of them nullable.
_EDGE_VALUES = (115, 119, 120, 121, 125)


def _edge_values_sql(n: int) -> str:
    return f"SELECT 'v{n}' AS column_name, CAST(l_partkey % {n} AS VARCHAR) AS v FROM lineitem"


@register("histogram_limit", f"""
WITH v AS ({' UNION ALL '.join(_edge_values_sql(n) for n in _EDGE_VALUES)}
           UNION ALL SELECT 'nullable', CASE WHEN l_linenumber > 1 THEN CAST(l_partkey % 120 AS VARCHAR) END
           FROM lineitem),
c AS (SELECT column_name, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY column_name, v),
s AS (SELECT column_name, count(*) AS n_values, sum(n) AS n_rows,
             count_if(n = 1) / count(*) AS once FROM c GROUP BY column_name)
SELECT column_name, n_values, CAST(n_rows AS BIGINT) AS n_rows FROM s WHERE n_values <= 120 AND once <= 0.1
""")
def histogram_limit(spark, sf_dir):
    """Which columns get a categorical rule is decided by their exact number of values,
    from the one scan of the profile."""
    li = load(spark, sf_dir, "lineitem")
    text = [(F.col("l_partkey") % n).cast("string").alias(f"v{n}") for n in _EDGE_VALUES]
    nullable = F.when(F.col("l_linenumber") > 1, (F.col("l_partkey") % 120).cast("string"))
    df = li.select(*text, nullable.alias("nullable"))
    prof = column_profile(df)
    rules = suggest_from_profile(df, prof).where("rule = 'categorical'")
    counts = prof.select(F.col("column").alias("column_name"), F.expr(
        "filter(top, t -> t.item is not null)").alias("top"))
    return rules.join(counts, "column_name").select(
        "column_name", F.size("top").cast("bigint").alias("n_values"),
        F.aggregate("top", F.lit(0).cast("bigint"), lambda a, t: a + t["count"]).alias("n_rows"))


# ---------------------------------------------------------------- M1-M3, M9-M12, J1-J3
# A trained model has no SQL equivalent: its numbers are compared with bounds, recomputed
# from the scored rows, or checked row by row; everything around it is compared as it is.

from tablewise.operators.boosting import (MISSING, BoostedTrees, gradient_table,  # noqa: E402
                                          quantile_edges, root_split)
from tablewise.operators.drift import DriftParams, drift_model  # noqa: E402
from tablewise.plans.jobs import RunConfig, drift_report, quality_report, table_report  # noqa: E402

DRIFT_DAY = dt.datetime(2024, 1, 30)
DRIFT_PARAMS = DriftParams(max_depth=4)
RUN_TS = "2024-01-31 00:00:00"


def _drifted_events(spark, sf_dir):
    """Newest day against the two before, day grain; half of value / event_type of the
    newest day corrupted (nulls, noise, suffixes)."""
    ev = load(spark, sf_dir, "events")
    sl = slice_days(ev, "ts", DRIFT_DAY, "day", 3)
    bad = X.corrupt(sl, ["value", "event_type"], "event_id", 0.5, scheme="gauss", salt=SALT,
                    only_where=F.col("label") == 1)
    return sample_by_class(bad, "label", SAMPLE_FRAC, SEED, method="hash", key="event_id")


def _drift_result(spark, sf_dir, with_shap):
    s = _drifted_events(spark, sf_dir).cache()
    try:
        # the results come back written, so the sample can be released
        return drift_model(s, "event_id", "events", exclude=["ts"], params=DRIFT_PARAMS,
                           with_shap=with_shap, keep_rows=True)
    finally:
        s.unpersist()


def _day_sql(n_days: int, from_day: str = "TIMESTAMP '2024-01-30'") -> str:
    days = " OR ".join(f"(ts >= {from_day} - to_days({i}) AND ts < {from_day} + to_days({1 - i}))"
                       for i in range(n_days))
    return (f"(SELECT *, CASE WHEN ts >= {from_day} THEN 1 ELSE 0 END AS label FROM events "
            f"WHERE {days})")


_TEST_KEYS_SQL = f"""
SELECT event_id FROM (
  SELECT event_id, row_number() OVER (PARTITION BY label ORDER BY
           {hash_sql('event_id', f'split:{SEED}')}, CAST(event_id AS VARCHAR)) AS rn,
         count(*) OVER (PARTITION BY label) AS n
  FROM {_day_sql(3)} AS s WHERE {uhash_sql('event_id', f'sample:{SEED}')} < {SAMPLE_FRAC}) AS r
WHERE rn <= round(n * {TEST_SHARE})"""


@register("drift_model_metrics", """
SELECT metric, true AS as_recomputed, true AS in_bounds
FROM (VALUES ('roc_auc'), ('accuracy'), ('precision'), ('recall'), ('f1_score')) AS v(metric)
""")
def drift_model_metrics(spark, sf_dir):
    """The metric rows equal those recomputed from the scored test rows by plain
    aggregates, and the injected drift is found."""
    res = _drift_result(spark, sf_dir, with_shap=False)
    p, y = F.col("prediction") == 1, F.col("label") == 1
    c = res.scored.select(
        F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"),
        F.count_if(p == y).alias("ok"), F.count("*").alias("n"), F.count_if(y).alias("pos"))
    c = c.first()
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                        numBins=0).evaluate(res.scored)
    numbers = {"roc_auc": auc, "accuracy": c.ok / c.n, "precision": c.tp / (c.tp + c.fp),
               "recall": c.tp / (c.tp + c.fn), "f1_score": 2 * c.tp / (2 * c.tp + c.fp + c.fn)}
    again = spark.createDataFrame(list(numbers.items()), "metric string, again double")
    return res.metrics.join(again, "metric").select(
        "metric", (F.abs(F.col("value") - F.col("again")) < 1e-9).alias("as_recomputed"),
        F.col("value").between(F.when(F.col("metric") == "roc_auc", 0.6).otherwise(0.0), 1.0)
        .alias("in_bounds"))


@register("shap_mean_abs", f"""
SELECT event_id, true AS additive, true AS injected_lead FROM ({_TEST_KEYS_SQL}) AS t
""")
def shap_mean_abs_q(spark, sf_dir):
    """Every test row is explained, its SHAP values add up to the model's log-odds, and
    the corrupted columns have the largest mean |SHAP|."""
    res = _drift_result(spark, sf_dir, with_shap=True)
    mean = {r["column"]: r["value"] for r in res.metrics.where("type = 'SHAP'").collect()}
    lead = min(mean["value"], mean["event_type"]) > max(
        v for c, v in mean.items() if c not in ("value", "event_type"))
    rows = res.shap.join(res.scored.select("event_id", "margin"), "event_id")
    total = F.aggregate("shap", F.col("expected_value"), lambda a, x: a + x)
    return rows.select("event_id", (F.abs(total - F.col("margin")) < 1e-6).alias("additive"),
                       F.lit(lead).alias("injected_lead"))


# A table with numbers, categories and missing values for the trees: ``late`` is the label, one row
# in five is a test row, and ``known_price`` is missing for some rows of the later ones.
_TREE_ROWS_SQL = f"""
SELECT *, CASE WHEN l_shipdate >= TIMESTAMP '1999-01-01' THEN 1 ELSE 0 END AS late,
       {uhash_sql('l_orderkey', 'tree-test')} < {TEST_SHARE} AS is_test,
       CASE WHEN NOT (l_shipdate >= TIMESTAMP '1999-01-01' AND l_quantity > 30) THEN l_tax END
         AS known_tax,
       CAST(CAST(l_quantity AS INT) % 23 AS VARCHAR) AS lot
FROM lineitem"""


def _tree_rows(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    late = F.col("l_shipdate") >= F.lit("1999-01-01").cast(li.schema["l_shipdate"].dataType)
    return li.withColumns({
        "late": late.cast("int"),
        "is_test": unit_hash("l_orderkey", "tree-test") < TEST_SHARE,
        "known_tax": F.when(~(late & (F.col("l_quantity") > 30)), F.col("l_tax")),
        "lot": (F.col("l_quantity").cast("int") % 23).cast("string")})


def _tree_model(rows, plan):
    """A model without trees: the margin is the log-odds of the label share."""
    train = rows.where("not is_test")
    share = train.agg(F.avg("late")).first()[0]
    category = [c in plan.categorical for c in plan.slot_sources]
    data = encode(rows, plan, keep=["late", "is_test"], vector_col=None)
    edges = quantile_edges(data.where("not is_test"), plan.slot_names, category)
    return data, BoostedTrees(plan.slot_names, edges, math.log(share / (1.0 - share)), [])


def _tree_plan(rows, *columns):
    return plan_features(rows.select("late", "is_test", *columns), label_col="late",
                         keep=["is_test"], encoding="native")


@register("gradient_histogram", f"""
WITH t AS (SELECT * FROM ({_TREE_ROWS_SQL}) AS r WHERE NOT is_test),
p AS (SELECT avg(late) AS p FROM t),
v AS (SELECT 'l_linenumber' AS slot, CAST(l_linenumber AS VARCHAR) AS bin, late FROM t
      UNION ALL SELECT 'known_tax', coalesce(CAST(known_tax AS VARCHAR), 'missing'), late FROM t
      UNION ALL SELECT 'lot', lot, late FROM t
      UNION ALL SELECT 'l_returnflag', l_returnflag, late FROM t)
SELECT slot, bin, round(sum(p - late), 4) AS gradient, round(sum(p * (1 - p)), 4) AS hessian
FROM v, p GROUP BY slot, bin
""")
def gradient_histogram(spark, sf_dir):
    """M1: gradient and hessian sums per slot and bin at the root, bins by their values."""
    rows = _tree_rows(spark, sf_dir)
    plan = _tree_plan(rows, "l_linenumber", "known_tax", "lot", "l_returnflag")
    data, model = _tree_model(rows, plan)
    names = []
    for slot, edges in zip(model.slots, model.edges):
        values = (plan.categorical[slot] if edges is None else
                  [str(int(e)) if slot == "l_linenumber" else str(float(e)) for e in edges])
        names += [(slot, i, v) for i, v in enumerate(values)] + [(slot, MISSING, "missing")]
    table = gradient_table(data, model, "late", "is_test")
    return table.withColumnRenamed("bin", "number").join(F.broadcast(spark.createDataFrame(
        names, "slot string, number int, bin string")), ["slot", "number"]).select(
        "slot", "bin", F.round("gradient", 4).alias("gradient"), F.round("hessian", 4).alias("hessian"))


@register("category_split_gain", f"""
WITH t AS (SELECT * FROM ({_TREE_ROWS_SQL}) AS r WHERE NOT is_test),
p AS (SELECT avg(late) AS p FROM t),
c AS (SELECT lot, sum(p - late) AS g, sum(p * (1 - p)) AS h FROM t, p GROUP BY lot),
s AS (SELECT lot, g, h, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(g) OVER () AS tg,
             sum(h) OVER () AS th, row_number() OVER w AS n
      FROM c WINDOW w AS (ORDER BY g / h)),
x AS (SELECT *, 0.5 * (lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1)
                       - tg * tg / (th + 1)) AS gain FROM s WHERE lh >= 1 AND th - lh >= 1),
b AS (SELECT arg_max(n, gain) AS n, max(gain) AS gain FROM x)
SELECT string_agg(lot, ',' ORDER BY lot) AS left_values, round(any_value(b.gain), 6) AS gain
FROM s, b WHERE s.n <= b.n
""")
def category_split_gain(spark, sf_dir):
    """The best subset of a category's values, by the order of gradient / hessian."""
    rows = _tree_rows(spark, sf_dir)
    plan = _tree_plan(rows, "lot")
    data, model = _tree_model(rows, plan)
    split = root_split(data, model, "late", "is_test")
    left = sorted(v for i, v in enumerate(plan.categorical["lot"]) if split.goes_left[i])
    return spark.createDataFrame([(",".join(left), round(split.gain, 6))],
                                 "left_values string, gain double")


@register("missing_direction", f"""
WITH t AS (SELECT * FROM ({_TREE_ROWS_SQL}) AS r WHERE NOT is_test),
p AS (SELECT avg(late) AS p FROM t),
c AS (SELECT known_tax AS x, sum(p - late) AS g, sum(p * (1 - p)) AS h FROM t, p GROUP BY known_tax),
m AS (SELECT coalesce(sum(g) FILTER (x IS NULL), 0) AS mg, coalesce(sum(h) FILTER (x IS NULL), 0) AS mh,
             sum(g) AS tg, sum(h) AS th FROM c),
s AS (SELECT x, sum(g) OVER (ORDER BY x) AS lg, sum(h) OVER (ORDER BY x) AS lh FROM c WHERE x IS NOT NULL),
k AS (SELECT x, side, lg + CASE WHEN side THEN mg ELSE 0 END AS lg,
             lh + CASE WHEN side THEN mh ELSE 0 END AS lh, tg, th
      FROM s, m, (VALUES (false), (true)) AS d(side)),
b AS (SELECT x, side, 0.5 * (lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1)
                             - tg * tg / (th + 1)) AS gain
      FROM k WHERE lh >= 1 AND th - lh >= 1)
SELECT x AS threshold, side AS missing_left, round(gain, 6) AS gain
FROM b ORDER BY gain DESC LIMIT 1
""")
def missing_direction(spark, sf_dir):
    """The best threshold of a column with nulls, and the side on which they are better."""
    rows = _tree_rows(spark, sf_dir)
    data, model = _tree_model(rows, _tree_plan(rows, "known_tax"))
    split = root_split(data, model, "late", "is_test")
    bound = float(model.edges[0][split.goes_left[:MISSING].sum() - 1])
    return spark.createDataFrame([(bound, bool(split.goes_left[MISSING]), round(split.gain, 6))],
                                 "threshold double, missing_left boolean, gain double")


def _events_cfg(**kw):
    base = dict(table="events", ts_col="ts", key="event_id", grain="day", n_days=3,
                sample_frac=SAMPLE_FRAC, seed=SEED, max_depth=4, run_ts=RUN_TS, path="events")
    base.update(kw)
    return RunConfig(**base)


def _report_rows(rows: DataFrame, df: DataFrame, auc=(0.0, 1.0)) -> DataFrame:
    """Report rows for the comparison: distinct counts as 1 if within 10 % of the exact ones (or
    off by at most one), drift metrics as 1 if within bounds, SHAP rows left to their own query."""
    exact = (df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
        for c in df.columns]))).where("v is not null").distinct()
        .groupBy("column").agg(F.count("*").alias("exact")))
    rows = rows.where("type <> 'SHAP'").join(exact, "column", "left")
    v = F.col("value")
    close = F.abs(v - F.col("exact")) <= F.greatest(F.lit(1.0), 0.1 * F.col("exact"))
    bounded = F.when(F.col("metric") == "roc_auc", v.between(*auc)).otherwise(v.between(0.0, 1.0))
    value = (F.when(F.col("metric") == "ApproxCountDistinct", close.cast("double"))
             .when(F.col("section") == "drift", bounded.cast("double"))
             .when(F.col("metric") == "Sum", F.round(v, 2)).otherwise(F.round(v, 4)))
    return rows.select(ts_text("timestamp").alias("timestamp"), "path", "section", "table", "type",
                       F.coalesce("column", F.lit("")).alias("column"), "metric",
                       (value + F.lit(0.0)).alias("value"))


def _report_sql(table: str, src: str, path: str, ts: str, profile_cols, kinds=None, counts=None,
                metrics=()) -> str:
    """The rows of a report: profile, suggestions (``kinds``), counts (of ``counts``), and one row
    of 1.0 for each of the drift ``metrics``."""
    cols = ", ".join(f"('{c}')" for c, _ in profile_cols)
    parts = [f"SELECT 'profile' AS section, entity AS type, instance AS \"column\", name AS metric, value "
             f"FROM ({profile_sql(src, profile_cols)}) AS p",
             f"SELECT 'profile', 'Column', c, 'ApproxCountDistinct', 1.0 FROM (VALUES {cols}) AS v(c)"]
    if kinds:
        parts.append(f"SELECT 'suggestions', rule, column_name, code_for_constraint, "
                     f"round(min_fraction, 4) FROM ({suggest_sql(src, kinds)}) AS s")
    if counts:
        for name, cond in (("n_total", "true"), ("n_current", "label = 1"), ("n_previous", "label = 0")):
            parts.append(f"SELECT 'counts', 'Count', '', '{name}', "
                         f"CAST(count_if({cond}) AS DOUBLE) FROM {counts} AS c")
    parts += [f"SELECT 'drift', 'MLMetric', '', '{m}', 1.0" for m in metrics]
    body = " UNION ALL ".join(parts)
    return (f"SELECT '{ts}.000000' AS timestamp, '{path}' AS path, section, '{table}' AS \"table\", "
            f"type, \"column\", metric, value FROM ({body}) AS r")


_MODEL_METRICS = ("roc_auc", "precision", "recall", "f1_score")
_LAST_DAY_SQL = "(SELECT date_trunc('day', max(ts)) FROM events)"


@register("drift_report", _report_sql(
    "events", f"(SELECT * EXCLUDE (label) FROM {_day_sql(2, _LAST_DAY_SQL)})", "events", RUN_TS,
    TABLE_COLUMNS["events"], counts=_day_sql(2, _LAST_DAY_SQL), metrics=_MODEL_METRICS))
def drift_report_q(spark, sf_dir):
    """Newest day against the day before, on the clean table (AUC near one half)."""
    ev = load(spark, sf_dir, "events")
    sl = latest_slice(ev, "ts", "day", n_days=2).drop("label")
    return _report_rows(drift_report(ev, _events_cfg()).rows(), sl, (0.25, 0.75))


@register("quality_report", _report_sql(
    "events", "(SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31')",
    "events", RUN_TS, TABLE_COLUMNS["events"], kinds=SUGGEST_KINDS["events"], counts=_day_sql(3),
    metrics=_MODEL_METRICS + ("accuracy",)))
def quality_report_q(spark, sf_dir):
    """Suggestions + profile of one day, then the three-day drift model."""
    ev = load(spark, sf_dir, "events")
    rows = quality_report(ev, _events_cfg(at="2024-01-30")).rows()
    return _report_rows(rows, slice_at(ev, "ts", DRIFT_DAY, "day"), (0.25, 0.75))


@register("table_report", _report_sql("orders", "orders", "orders", RUN_TS, TABLE_COLUMNS["orders"],
                                      kinds=SUGGEST_KINDS["orders"]))
def table_report_q(spark, sf_dir):
    """Suggestions + profile of a whole table."""
    o = load(spark, sf_dir, "orders")
    return _report_rows(table_report(o, "orders", RUN_TS).rows(), o)


# ---------------------------------------------------------------- A: sources and sinks

from tablewise.session import shared_dir  # noqa: E402
from tablewise.sources.readers import read_csv, write_csv  # noqa: E402
from tablewise.functions.timeslice import day_key  # noqa: E402
from tablewise.sources.sinks import (PROFILE_METRIC, append_metrics, exposition_lines,  # noqa: E402
                                     profile_exposition)


def _esc_sql(x: str) -> str:
    return f"replace(replace(replace({x}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"


@register("exposition_lines", f"""
WITH p AS (SELECT 'region' AS tbl, * FROM ({profile_sql('region', TABLE_COLUMNS['region'])}) AS a
           UNION ALL
           SELECT 'nation', * FROM ({profile_sql('nation', TABLE_COLUMNS['nation'])}) AS b)
SELECT '{PROFILE_METRIC}{{table="' || {_esc_sql('tbl')} || '",entity="' || {_esc_sql('entity')}
       || '",instance="' || {_esc_sql('instance')} || '",name="' || {_esc_sql('name')} || '"}} '
       || CAST(CAST(round(value, 6) AS DECIMAL(38,6)) AS VARCHAR) AS line
FROM p
""")
def exposition_lines_q(spark, sf_dir):
    """Profile metrics of region and nation as exposition text lines."""
    out = None
    for t in ("region", "nation"):
        lines = profile_exposition(rounded(profile(load(spark, sf_dir, t), approx_distinct=False)), t,
                                   decimals=6)
        out = lines if out is None else out.unionByName(lines)
    return out


@register("exposition_edge_values", """
SELECT 'm{region="' || r_name || '"} ' || v AS line FROM (
  SELECT r_name, CASE r_regionkey WHEN 0 THEN 'NaN' WHEN 1 THEN '+Inf' WHEN 2 THEN '1.0E33'
                                  WHEN 3 THEN '2.0E-8' END AS v FROM region) AS t WHERE v IS NOT NULL
""")
def exposition_edge_values(spark, sf_dir):
    """NaN, an infinity, very large and very small values as they are; text is skipped."""
    values = F.array(*[F.lit(v) for v in ("NaN", "Infinity", "1e33", "2e-8", "no number")])
    df = load(spark, sf_dir, "region").select(
        "r_name", F.element_at(values, F.col("r_regionkey").cast("int") + 1).alias("value"))
    return exposition_lines(df, "m", [("region", F.col("r_name"))])


@register("csv_events", f"""
SELECT event_id, {ts_text_sql('ts + to_microseconds(event_id % 1000)')} AS ts,
       CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN event_type || chr(10) || 'a, "b" \\ '
                         WHEN 2 THEN '' WHEN 3 THEN ' ' || event_type ELSE event_type END AS note
FROM events
""")
def csv_events(spark, sf_dir):
    """A4: microseconds, nulls, empty texts, line breaks, quotes and blanks survive CSV."""
    i, t = F.col("event_id"), F.col("event_type")
    note = (F.when(i % 5 == 1, F.concat(t, F.lit('\na, "b" \\ '))).when(i % 5 == 2, F.lit(""))
            .when(i % 5 == 3, F.concat(F.lit(" "), t)).when(i % 5 == 4, t))
    ev = load(spark, sf_dir, "events").select("event_id", F.timestamp_micros(
        F.unix_micros(F.col("ts").cast("timestamp")) + i % 1000).cast("timestamp_ntz").alias("ts"),
        note.alias("note"))
    path = shared_dir(spark, "csv-events")
    write_csv(ev, path)
    return read_csv(spark, path, ev.schema).select("event_id", ts_text("ts").alias("ts"), "note")


@register("events_per_day", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL
""")
def events_per_day(spark, sf_dir):
    """Rows per day key."""
    ev = load(spark, sf_dir, "events")
    return (ev.groupBy(day_key("ts").cast("string").alias("day")).agg(F.count("*").alias("n")))


@register("csv_roundtrip", "SELECT * FROM nation")
def csv_roundtrip(spark, sf_dir):
    """A4: nation written as CSV (header, no index) to the shared folder, read back typed."""
    nation = load(spark, sf_dir, "nation")
    path = shared_dir(spark, "csv-nation")
    write_csv(nation, path)
    return read_csv(spark, path, nation.schema)


@register("metrics_append", f"""
SELECT 'region' AS "table", * FROM ({profile_sql('region', TABLE_COLUMNS['region'])}) AS a
UNION ALL
SELECT 'nation', * FROM ({profile_sql('nation', TABLE_COLUMNS['nation'])}) AS b
""")
def metrics_append(spark, sf_dir):
    """A5: metric rows of two tables appended to one table partitioned by ``table``."""
    path = shared_dir(spark, "metrics")
    for t in ("region", "nation"):
        rows = rounded(profile(load(spark, sf_dir, t), approx_distinct=False))
        append_metrics(rows.withColumn("table", F.lit(t)), path)
    back = spark.read.parquet(path)
    return back.select("table", "entity", "instance", "name", "value")


@register("metrics_published", ORACLES["metrics_append"])
def metrics_published(spark, sf_dir):
    """A5: two runs published, the second after an attempt that died between its outputs and a
    first success that a retry replaces: every metric row once, read through the manifests."""
    out = shared_dir(spark, "published")

    def write(table, dies=False):
        def put(folder):
            rows = rounded(profile(load(spark, sf_dir, table), approx_distinct=False))
            append_metrics(rows.withColumn("table", F.lit(table)), f"{folder}/metrics",
                           partition_by=())
            if dies:
                raise InterruptedError(table)
        return put

    publish_run(spark, out, "run region", write("region"))
    for attempt in (True, False, False):
        try:
            publish_run(spark, out, "run nation", write("nation", dies=attempt))
        except InterruptedError:
            continue
    back = read_published(spark, out, "metrics")
    return back.select("table", "entity", "instance", "name", "value")


# ---------------------------------------------------------------- more surface

from tablewise.functions.timeslice import hhmm  # noqa: E402
from tablewise.sources.sinks import ML_METRIC, ml_exposition  # noqa: E402

_CONF_SQL = ORACLES["confusion_metrics"]


@register("ml_exposition_lines", f"""
SELECT '{ML_METRIC}{{table="' || {_esc_sql('"table"')} || '",metric_type="' || {_esc_sql('type')}
       || '",column="' || {_esc_sql("coalesce(\"column\", '')")} || '",metric="' || {_esc_sql('metric')}
       || '"}} ' || CAST(CAST(round(value, 6) AS DECIMAL(38,6)) AS VARCHAR) AS line
FROM ({_CONF_SQL}) AS m
""")
def ml_exposition_lines(spark, sf_dir):
    """A9 + A10: model metric rows as exposition lines; the null column label is empty."""
    return ml_exposition(confusion_metrics(spark, sf_dir), decimals=6)


_DIRTY_COLS = X.choose_columns_from(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                     "o_orderdate", "o_orderpriority"],
                                    X.SCHEMES["shift"][3], exclude={"o_orderkey"}, seed=SEED)


def _dirty_sql():
    key = "o_orderkey"
    kinds = dict(SUGGEST_KINDS["orders"])
    sel = []
    for c, _ in SUGGEST_KINDS["orders"]:
        if c not in _DIRTY_COLS:
            sel.append(ts_text_sql(c) + f" AS {c}" if kinds[c] == "other" else c)
            continue
        nul = f"{_hit_sql(key, c, 0.3)} AND {uhash_sql(key, f'{SALT}:null:{c}')} < 0.5"
        if kinds[c] == "string":
            changed = f"coalesce({c}, 'None') || {_suffix_sql(key, c, 5)}"
        elif kinds[c] in ("integral", "fractional"):
            changed = f"{c} + 100 + {hash_sql(key, f'{SALT}:shift:{c}')} % 900"
        else:
            changed = None
        out = ts_text_sql(c) if kinds[c] == "other" else c
        if changed is None:
            sel.append(f"CASE WHEN {nul} THEN NULL ELSE {out} END AS {c}")
        else:
            sel.append(f"CASE WHEN {nul} THEN NULL WHEN {_hit_sql(key, c, 0.3)} THEN {changed} "
                       f"ELSE {c} END AS {c}")
    # integer columns that may hold nulls are compared as doubles (a nullable integer
    # column turns into floats in pandas on one side only)
    outer = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if kinds[c] == "integral" else c
                      for c, _ in SUGGEST_KINDS["orders"])
    return f"SELECT {outer} FROM (SELECT " + ", ".join(sel) + " FROM orders) AS d"


@register("make_dirty_orders", _dirty_sql())
def make_dirty_orders(spark, sf_dir):
    """X1 + X2-X4, X6 ("shift" scheme): up to 5 seeded columns, 30 % of rows each;
    nulls, 5-character suffixes (a null reads as "None"), integer shifts in [100, 1000)."""
    o = load(spark, sf_dir, "orders")
    bad, cols = X.make_dirty(o, "o_orderkey", frac=0.3, scheme="shift", seed=SEED, salt=SALT)
    assert sorted(cols) == sorted(_DIRTY_COLS)
    return bad.select(F.col("o_orderkey").cast("double"), F.col("o_custkey").cast("double"),
                      "o_orderstatus", "o_totalprice",
                      ts_text("o_orderdate").alias("o_orderdate"), "o_orderpriority")


_MINUTE = dt.datetime(2024, 1, 30, 7, 13)


@register("slice_minute_all_days", f"""
SELECT event_id, {ts_text_sql('ts')} AS ts, strftime(ts, '%H:%M') AS hhmm,
       CASE WHEN ts >= {_ts_lit(_MINUTE)} THEN 1 ELSE 0 END AS label
FROM events
WHERE ({' OR '.join(f"(ts >= {_ts_lit(_MINUTE - dt.timedelta(days=i))} AND ts < {_ts_lit(_MINUTE - dt.timedelta(days=i) + dt.timedelta(minutes=1))})" for i in range(30))})
""")
def slice_minute_all_days(spark, sf_dir):
    """B2 + B5 + B6 at the reference's grain: the same HH:mm on 30 days, 30 pushed ranges."""
    sl = slice_days(load(spark, sf_dir, "events"), "ts", _MINUTE, "minute", 30)
    return sl.select("event_id", ts_text("ts").alias("ts"), hhmm("ts").alias("hhmm"), "label")
