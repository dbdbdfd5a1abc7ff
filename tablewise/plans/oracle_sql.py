"""DuckDB text builders for the oracle queries (correctness gate only).

They restate the semantics of the Spark operators in plain SQL over the same parquet
tables.  Nothing here runs on Spark.
"""

from __future__ import annotations

from tablewise.functions.hashing import portable_hash_sql, unit_hash_sql

# Column kinds of the driver tables: "num" numeric, "str" string, "other" anything else.
TABLE_COLUMNS = {
    "region": [("r_regionkey", "num"), ("r_name", "str")],
    "nation": [("n_nationkey", "num"), ("n_name", "str"), ("n_regionkey", "num")],
    "customer": [("c_custkey", "num"), ("c_name", "str"), ("c_nationkey", "num"),
                 ("c_acctbal", "num"), ("c_mktsegment", "str")],
    "part": [("p_partkey", "num"), ("p_name", "str"), ("p_brand", "str"), ("p_type", "str"),
             ("p_size", "num"), ("p_retailprice", "num")],
    "orders": [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "str"),
               ("o_totalprice", "num"), ("o_orderdate", "other"), ("o_orderpriority", "str")],
    "lineitem": [("l_orderkey", "num"), ("l_partkey", "num"), ("l_suppkey", "num"),
                 ("l_linenumber", "num"), ("l_quantity", "num"), ("l_extendedprice", "num"),
                 ("l_discount", "num"), ("l_tax", "num"), ("l_returnflag", "str"),
                 ("l_linestatus", "str"), ("l_shipdate", "other")],
    "events": [("event_id", "num"), ("ts", "other"), ("user_id", "num"),
               ("event_type", "str"), ("value", "num"), ("props", "str")],
    "documents": [("doc_id", "num"), ("text", "str"), ("lang", "str"), ("source", "str"),
                  ("n_chars", "num")],
    "embeddings": [("vec_id", "num"), ("embedding", "other"), ("label", "num")],
    "labels": [("doc_id", "num"), ("quality", "num"), ("toxic", "num")],
}

# rounding used on both sides of the compare
# (+ 0.0 turns a negative zero into 0.0)
ROUND_VALUE_SQL = "(CASE WHEN name = 'Sum' THEN round(value, 2) ELSE round(value, 4) END) + 0.0"


def profile_sql(src: str, cols, group: str | None = None) -> str:
    """Long metric rows of ``src`` (a table name or a parenthesised sub-query)."""
    g_sel = f"{group}, " if group else ""
    g_by = f" GROUP BY {group}" if group else ""
    parts = [f"SELECT {g_sel}'Dataset' AS entity, '*' AS instance, 'Size' AS name, "
             f"CAST(count(*) AS DOUBLE) AS value FROM {src} AS s{g_by}"]

    def add(inst, name, expr):
        parts.append(f"SELECT {g_sel}'Column', '{inst}', '{name}', CAST({expr} AS DOUBLE) "
                     f"FROM {src} AS s{g_by}")

    for c, kind in cols:
        add(c, "Completeness", f"count({c}) / nullif(count(*), 0)")
        if kind == "num":
            add(c, "Minimum", f"min({c})")
            add(c, "Maximum", f"max({c})")
            add(c, "Mean", f"avg(CAST({c} AS DOUBLE))")
            add(c, "Sum", f"sum(CAST({c} AS DOUBLE))")
        elif kind == "str":
            add(c, "MaxLength", f"max(length({c}))")
            add(c, "MinLength", f"min(length({c}))")
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT {g_sel}entity, instance, name, {ROUND_VALUE_SQL} AS value "
            f"FROM (\n{body}\n) AS m WHERE value IS NOT NULL")


def hash_sql(key_sql: str, salt) -> str:
    return portable_hash_sql(key_sql, salt)


def uhash_sql(key_sql: str, salt) -> str:
    return unit_hash_sql(key_sql, salt)


def ts_text_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


__all__ = ["TABLE_COLUMNS", "ROUND_VALUE_SQL", "profile_sql", "hash_sql", "uhash_sql",
           "ts_text_sql"]


# ------------------------------------------------------------- suggestion rules (E)

SUGGEST_KINDS = {
    "orders": [("o_orderkey", "integral"), ("o_custkey", "integral"), ("o_orderstatus", "string"),
               ("o_totalprice", "fractional"), ("o_orderdate", "other"),
               ("o_orderpriority", "string")],
    "part": [("p_partkey", "integral"), ("p_name", "string"), ("p_brand", "string"),
             ("p_type", "string"), ("p_size", "integral"), ("p_retailprice", "fractional")],
    "customer": [("c_custkey", "integral"), ("c_name", "string"), ("c_nationkey", "integral"),
                 ("c_acctbal", "fractional"), ("c_mktsegment", "string")],
    "lineitem": [("l_orderkey", "integral"), ("l_partkey", "integral"), ("l_suppkey", "integral"),
                 ("l_linenumber", "integral"), ("l_quantity", "fractional"),
                 ("l_extendedprice", "fractional"), ("l_discount", "fractional"),
                 ("l_tax", "fractional"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "other")],
    "events": [("event_id", "integral"), ("ts", "other"), ("user_id", "integral"),
               ("event_type", "string"), ("value", "fractional"), ("props", "string")],
    "events_k": [("event_id", "integral"), ("k", "string"), ("event_type", "string")],
}

_INT_RE = r"^[+-]?[0-9]+$"
_FRAC_RE = r"^[+-]?([0-9]*\.[0-9]+|[0-9]+\.[0-9]*)([eE][+-]?[0-9]+)?$"
_NUM_RE = r"^[+-]?([0-9]+|([0-9]*\.[0-9]+|[0-9]+\.[0-9]*)([eE][+-]?[0-9]+)?)$"


def _dec_sql(x: str, scale: int) -> str:
    return f"CAST(CAST(round({x}, {scale}) AS DECIMAL(38,{scale})) AS VARCHAR)"


def _floor2(x: str) -> str:
    return f"greatest(0.0, floor(({x}) * 100.0) / 100.0)"


def suggest_sql(src: str, kinds) -> str:
    """All suggestion rows (7 fields + rule + min_fraction) of ``src``."""
    prof = []
    for c, k in kinds:
        if k == "string":
            t = f"trim({c})"
            prof.append(
                f"SELECT '{c}' AS col, 'string' AS kind, count(*) AS n, count({c}) AS non_null, "
                f"count(DISTINCT {c}) AS nd, "
                f"min(CASE WHEN regexp_full_match({t}, '{_NUM_RE}') THEN TRY_CAST({t} AS DOUBLE) END) AS minimum, "
                f"count_if(regexp_full_match({t}, '{_INT_RE}')) AS n_int, "
                f"count_if(NOT regexp_full_match({t}, '{_INT_RE}') AND regexp_full_match({t}, '{_FRAC_RE}')) AS n_frac, "
                f"count_if(lower({t}) IN ('true', 'false')) AS n_bool FROM {src}")
        else:
            mn = f"min(CAST({c} AS DOUBLE))" if k in ("integral", "fractional") else "NULL"
            prof.append(
                f"SELECT '{c}' AS col, '{k}' AS kind, count(*) AS n, count({c}) AS non_null, "
                f"count(DISTINCT {c}) AS nd, {mn} AS minimum, 0 AS n_int, 0 AS n_frac, "
                f"0 AS n_bool FROM {src}")
    hist = [f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM {src} "
            f"WHERE {c} IS NOT NULL GROUP BY 2" for c, k in kinds if k == "string"]
    if not hist:
        hist = ["SELECT NULL::VARCHAR AS col, NULL::VARCHAR AS value, 0 AS cnt WHERE false"]
    p_expr = "(CAST(non_null AS DOUBLE) / n)"
    inferred = ("CASE WHEN kind <> 'string' THEN upper(substr(kind, 1, 1)) || substr(kind, 2) "
                "WHEN non_null = 0 THEN 'Unknown' "
                "WHEN non_null - n_int - n_frac - n_bool > 0 THEN 'String' "
                "WHEN n_bool > 0 AND (n_int > 0 OR n_frac > 0) THEN 'String' "
                "WHEN n_bool > 0 THEN 'Boolean' WHEN n_frac > 0 THEN 'Fractional' "
                "ELSE 'Integral' END")
    bq = "'`' || col || '`'"
    q_sql = r"'''' || replace(replace(value, '\', '\\'), '''', '\''') || ''''"
    q_code = r"""'"' || replace(replace(value, '\', '\\'), '"', '\"') || '"'"""
    b5 = _floor2(f"p - 1.96 * sqrt(p * (1 - p) / n)")
    b8 = _floor2("cov - 1.96 * sqrt(cov * (1 - cov) / non_null)")
    num_pat = _NUM_RE.replace("\\", "\\\\")
    return f"""
WITH prof0 AS ({' UNION ALL '.join(prof)}),
prof AS (SELECT *, {p_expr} AS p, {inferred} AS inferred FROM prof0),
hist AS (SELECT h.* FROM ({' UNION ALL '.join(hist)}) AS h
         JOIN prof ON prof.col = h.col WHERE prof.kind = 'string' AND prof.nd <= 120),
hh AS (SELECT h.col, h.value, h.cnt, p.non_null,
         count(*) OVER (PARTITION BY h.col) AS dn,
         sum(CASE WHEN h.cnt = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY h.col) AS once,
         sum(h.cnt) OVER (PARTITION BY h.col ORDER BY h.cnt DESC, h.value
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
       FROM hist h JOIN prof p ON p.col = h.col),
e7 AS (SELECT col,
         string_agg({q_sql}, ', ' ORDER BY cnt DESC, value) AS vals_sql,
         string_agg({q_code}, ', ' ORDER BY cnt DESC, value) AS vals_code,
         count(*) AS k FROM hh GROUP BY col HAVING max(once) / max(dn) <= 0.1),
e8a AS (SELECT * FROM hh WHERE (run - cnt) / non_null < 0.9),
e8 AS (SELECT col, max(non_null) AS non_null, max(run) / max(non_null) AS cov,
         string_agg({q_sql}, ', ' ORDER BY cnt DESC, value) AS vals_sql,
         string_agg({q_code}, ', ' ORDER BY cnt DESC, value) AS vals_code,
         count(*) AS k, max(dn) AS dn FROM e8a GROUP BY col
       HAVING max(once) / max(dn) <= 0.4 AND count(*) < max(dn)),
e5 AS (SELECT *, {b5} AS b FROM prof WHERE p > 0.2 AND p < 1.0),
e8b AS (SELECT *, {b8} AS b FROM e8)
SELECT 'CompletenessConstraint' AS constraint_name, col AS column_name,
       'Completeness: 1.0' AS current_value, '''' || col || ''' is not null' AS description,
       'CompleteIfCompleteRule' AS suggesting_rule,
       'A column complete in the sample gets a NOT NULL constraint' AS rule_description,
       '.isComplete("' || col || '")' AS code_for_constraint, 'complete' AS rule,
       1.0::DOUBLE AS min_fraction, {bq} || ' IS NOT NULL' AS sql_predicate
FROM prof WHERE n > 0 AND non_null = n
UNION ALL
SELECT 'CompletenessConstraint', col, 'Completeness: ' || {_dec_sql('p', 4)},
       '''' || col || ''' has at most ' || {_dec_sql('(1 - b) * 100', 0)} || '% missing values',
       'RetainCompletenessRule',
       'A partly complete column gets a lower bound on its completeness',
       '.hasCompleteness("' || col || '", _ >= ' || {_dec_sql('b', 2)} || ')', 'completeness',
       b, {bq} || ' IS NOT NULL'
FROM e5
UNION ALL
SELECT 'DataTypeConstraint', col, 'DataType: ' || inferred,
       '''' || col || ''' has type ' || inferred, 'RetainTypeRule',
       'A text column whose values all read as one type keeps that type',
       '.hasDataType("' || col || '", ConstrainableDataTypes.' || inferred || ')', 'type', 1.0,
       {bq} || ' IS NULL OR trim(' || {bq} || ') RLIKE ''' ||
         CASE inferred WHEN 'Integral' THEN '{_INT_RE}' WHEN 'Fractional' THEN '{num_pat}'
              ELSE '^(?i)(true|false)$' END || ''''
FROM prof WHERE kind = 'string' AND inferred IN ('Integral', 'Fractional', 'Boolean')
UNION ALL
SELECT 'ComplianceConstraint', col, 'Distinct values: ' || CAST(k AS VARCHAR),
       '''' || col || ''' has value range ' || vals_sql, 'CategoricalRangeRule',
       'A low-cardinality column whose values repeat keeps its set of values',
       '.isContainedIn("' || col || '", Array(' || vals_code || '))', 'categorical', 1.0,
       {bq} || ' IS NULL OR ' || {bq} || ' IN (' || vals_sql || ')'
FROM e7
UNION ALL
SELECT 'ComplianceConstraint', col, 'Coverage: ' || {_dec_sql('cov', 4)},
       '''' || col || ''' has value range ' || vals_sql || ' for at least ' ||
         {_dec_sql('b * 100', 0)} || '% of values',
       'FractionalCategoricalRangeRule',
       'The most frequent values covering 90% of rows, with a lower bound on their share',
       '.isContainedIn("' || col || '", Array(' || vals_code || '), _ >= ' || {_dec_sql('b', 2)} || ')',
       'fractional_categorical', b,
       {bq} || ' IS NULL OR ' || {bq} || ' IN (' || vals_sql || ')'
FROM e8b
UNION ALL
SELECT 'ComplianceConstraint', col, 'Minimum: ' || {_dec_sql('minimum', 4)},
       '''' || col || ''' has no negative values', 'NonNegativeNumbersRule',
       'A numeric column without negative values stays non-negative',
       '.isNonNegative("' || col || '")', 'non_negative', 1.0,
       {bq} || ' IS NULL OR ' ||
         CASE WHEN kind = 'string' THEN 'TRY_CAST(trim(' || {bq} || ') AS DOUBLE)' ELSE {bq} END
         || ' >= 0'
FROM prof WHERE (kind IN ('integral', 'fractional')
                 OR (kind = 'string' AND inferred IN ('Integral', 'Fractional')))
            AND minimum >= 0
"""
