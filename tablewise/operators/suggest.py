"""Constraint suggestion.

The reference hands the slice to a JVM library with its default rule set and keeps
seven text fields per suggestion.  The rules are restated here (semantics after the
published description: Schelter et al., PVLDB 11(12), 2018; thresholds are our
parameters, see ``Thresholds``):

E1  column profile: one aggregate over the table - rows, non-null count, approximate
    distinct count, minimum, and for text columns the type-inference counts (E2)
E2  type of a text column from counts of integral / fractional / boolean values:
    other text present, or booleans mixed with numbers -> String; only booleans ->
    Boolean; any fractional -> Fractional; else Integral
E3  value histogram of text columns with at most ``max_histogram_values`` values, decided by
    exact counts: the aggregate of E1 also holds a bounded value summary per text column
    (``approx_top_k`` with more room than the limit, which counts exactly as long as a column
    fits).  Only columns with very long values are counted in a scan of their own
E4  CompleteIfComplete          completeness = 1             -> isComplete
E5  RetainCompleteness          0.2 < p < 1                  -> hasCompleteness(>= p - z*sqrt(p(1-p)/n), cut to 2 places)
E6  RetainType                  text column inferred Integral / Fractional / Boolean -> hasDataType
E7  CategoricalRange            histogram, once-only value share <= 0.1 -> isContainedIn(all values)
E8  FractionalCategoricalRange  histogram, once-only share <= 0.4; most frequent values up to
                                90 % of rows (not all values)  -> isContainedIn(values, >= bound)
E9  NonNegativeNumbers          numeric (or inferred numeric) minimum >= 0 -> isNonNegative
E10 the suggestion record (7 text fields) plus ``rule``, ``min_fraction``, ``value_list``
    and a runnable Spark SQL ``sql_predicate`` (E11)
E13 ``check_suggestions``: share of rows meeting each predicate on other data, one scan

Everything after E1/E3 works on frames with one row per column (or per histogram
value), so rule evaluation costs nothing next to the scan; ``profile_and_suggest`` shares it with
the metric profile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, DoubleType, FloatType, IntegralType,
                               NumericType, StringType, StructType)

from tablewise.functions.mathx import floor_to
from tablewise.operators.profile import metric_frame, metric_specs, qcol
from tablewise.session import written

# Text patterns of the type inference.
INTEGRAL_PATTERN = r"^[+-]?[0-9]+$"
FRACTIONAL_PATTERN = r"^[+-]?([0-9]*\.[0-9]+|[0-9]+\.[0-9]*)([eE][+-]?[0-9]+)?$"
NUMBER_PATTERN = r"^[+-]?([0-9]+|([0-9]*\.[0-9]+|[0-9]+\.[0-9]*)([eE][+-]?[0-9]+)?)$"
BOOLEAN_VALUES = ("true", "false")

SUGGESTION_FIELDS = ["constraint_name", "column_name", "current_value", "description",
                     "suggesting_rule", "rule_description", "code_for_constraint"]


@dataclass(frozen=True)
class Thresholds:
    max_histogram_values: int = 120
    retain_completeness_min: float = 0.2
    z: float = 1.96
    categorical_unique_share: float = 0.1
    fractional_unique_share: float = 0.4
    fractional_coverage: float = 0.9


def _kind(dtype) -> str:
    if isinstance(dtype, StringType):
        return "string"
    if isinstance(dtype, BooleanType):
        return "boolean"
    if isinstance(dtype, IntegralType):
        return "integral"
    if isinstance(dtype, (FloatType, DoubleType, DecimalType)) or isinstance(dtype, NumericType):
        return "fractional"
    return "other"


LONG_VALUE = 1_000           # longer texts stay out of the value summary, which holds values


def summary_room(limit: int) -> int:
    """Values that a column's summary holds exactly; the distinct estimate below half of it
    proves that they fitted (an error of over ten standard deviations apart)."""
    return 4 * limit + 32


def profile_aggregates(df: DataFrame, columns=None, rsd: float = 0.05, sketch_all: bool = False,
                       limit: int = 120) -> list[Column]:
    """E1 + E2 + E3 as aggregate expressions over ``df``.  The rules only use the distinct count
    of text columns, so only those are sketched unless ``sketch_all``; ``limit`` is the largest
    number of values of a histogram."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(_profiled(df, columns)):
        c = qcol(f.name)
        kind = _kind(f.dataType)
        aggs += [F.count(c).alias(f"nn{i}")]
        if sketch_all or kind == "string":
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"ad{i}"))
        if kind in ("integral", "fractional"):
            aggs.append(F.min(c.cast("double")).alias(f"mn{i}"))
        elif kind == "string":
            t = F.trim(c)
            is_int = t.rlike(INTEGRAL_PATTERN)
            is_frac = ~is_int & t.rlike(FRACTIONAL_PATTERN)
            is_bool = F.lower(t).isin(*BOOLEAN_VALUES)
            # cast only text that reads as a number: a failing cast costs an exception
            numeric = F.when(t.rlike(NUMBER_PATTERN), t.cast("double"))
            short = F.when(F.length(c) <= LONG_VALUE, c)
            aggs += [F.call_function("approx_top_k", short, F.lit(limit + 2),
                                     F.lit(summary_room(limit))).alias(f"tk{i}"),
                     F.count_if(F.length(c) > LONG_VALUE).alias(f"lg{i}")]
            aggs += [F.min(numeric).alias(f"mn{i}"),
                     F.count_if(is_int).alias(f"ci{i}"), F.count_if(is_frac).alias(f"cf{i}"),
                     F.count_if(is_bool).alias(f"cb{i}")]
    return aggs


def _profiled(df: DataFrame, columns=None) -> list:
    return [f for f in df.schema.fields if columns is None or f.name in set(columns)]


def one_row(df: DataFrame, aggs: list[Column], chunk: int = 256):
    """``(schema, values)`` of global aggregates, in one scan (very wide tables: one per ``chunk``
    expressions, each reading only its columns).  One row, bounded by the column count."""
    fields, values = [], ()
    for start in range(0, len(aggs), chunk):
        part = df.agg(*aggs[start:start + chunk])
        fields += list(part.schema.fields)
        values += tuple(part.first())
    return StructType(fields), values


def column_profile(df: DataFrame, columns=None, rsd: float = 0.05, sketch_all: bool = False,
                   chunk: int = 256, limit: int = 120) -> DataFrame:
    """E1 + E2 + E3: one row per column, from one aggregate over ``df``.

    Columns: column, kind, n, non_null, completeness, approx_distinct, minimum,
    n_integral, n_fractional, n_boolean, n_long, top (the value summary), inferred_type.
    """
    schema, values = one_row(df, profile_aggregates(df, columns, rsd, sketch_all, limit), chunk)
    return profile_frame(df, schema, values, columns)


TOP_TYPE = "array<struct<item:string,count:bigint>>"


def profile_frame(df: DataFrame, schema: StructType, values, columns=None) -> DataFrame:
    """The column profile from the values of :func:`profile_aggregates`."""
    fields = _profiled(df, columns)
    wide = df.sparkSession.createDataFrame([tuple(values)], schema).coalesce(1)

    def num_or_null(name, typ):
        return F.col(name).cast(typ) if name in wide.columns else F.lit(None).cast(typ)

    structs = []
    for i, f in enumerate(fields):
        kind = _kind(f.dataType)
        structs.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(kind).alias("kind"),
            F.col("_n").alias("n"), F.col(f"nn{i}").alias("non_null"),
            num_or_null(f"ad{i}", "bigint").alias("approx_distinct"),
            num_or_null(f"mn{i}", "double").alias("minimum"),
            num_or_null(f"ci{i}", "bigint").alias("n_integral"),
            num_or_null(f"cf{i}", "bigint").alias("n_fractional"),
            num_or_null(f"cb{i}", "bigint").alias("n_boolean"),
            num_or_null(f"lg{i}", "bigint").alias("n_long"),
            num_or_null(f"tk{i}", TOP_TYPE).alias("top")))
    prof = wide.select(F.inline(F.array(*structs)))
    n_other = F.col("non_null") - F.col("n_integral") - F.col("n_fractional") - F.col("n_boolean")
    inferred = (F.when(F.col("kind") != "string",
                       F.initcap(F.col("kind")))
                 .when(F.col("non_null") == 0, F.lit("Unknown"))
                 .when(n_other > 0, F.lit("String"))
                 .when((F.col("n_boolean") > 0) &
                       ((F.col("n_integral") > 0) | (F.col("n_fractional") > 0)), F.lit("String"))
                 .when(F.col("n_boolean") > 0, F.lit("Boolean"))
                 .when(F.col("n_fractional") > 0, F.lit("Fractional"))
                 .otherwise(F.lit("Integral")))
    return (prof.withColumn("completeness", F.try_divide(F.col("non_null").cast("double"),
                                                         F.col("n").cast("double")))
                .withColumn("inferred_type", inferred))


def histograms(df: DataFrame, columns) -> DataFrame:
    """``(column, value, cnt)`` for the given columns; one shuffle for all of them."""
    cols = list(columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, cnt long")
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value"))
        for c in cols]))).filter(F.col("value").isNotNull())
    return pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _dec(x: Column, scale: int) -> Column:
    return F.round(x, scale).cast(f"decimal(38,{scale})").cast("string")


def _quoted(v: Column, mark: str) -> Column:
    """A text literal: backslashes first, then the quotation mark."""
    v = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit(mark), F.lit("\\" + mark))
    return F.concat(F.lit(mark), v, F.lit(mark))


def _quote_sql(v: Column) -> Column:
    return _quoted(v, "'")


def _quote_code(v: Column) -> Column:
    return _quoted(v, '"')


def _record(column: Column, rule: str, constraint: str, current: Column, description: Column,
            rule_name: str, rule_description: str, code: Column, min_fraction: Column,
            predicate: Column, values: Column | None = None) -> list:
    return [
        F.lit(constraint).alias("constraint_name"), column.alias("column_name"),
        current.alias("current_value"), description.alias("description"),
        F.lit(rule_name).alias("suggesting_rule"), F.lit(rule_description).alias("rule_description"),
        code.alias("code_for_constraint"), F.lit(rule).alias("rule"),
        min_fraction.cast("double").alias("min_fraction"),
        (values if values is not None else F.lit(None).cast("array<string>")).alias("value_list"),
        predicate.alias("sql_predicate"),
    ]


def _bq(c: Column) -> Column:
    return F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`"))


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def rules_from_profile(prof: DataFrame, hist: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """E4-E11 on the profile and histogram frames."""
    col = F.col("column")
    p = F.col("completeness")
    n = F.col("n")
    out = []

    # E4
    e4 = prof.filter((n > 0) & (F.col("non_null") == n))
    out.append(e4.select(*_record(
        col, "complete", "CompletenessConstraint", F.lit("Completeness: 1.0"),
        F.format_string("'%s' is not null", col), "CompleteIfCompleteRule",
        "A column complete in the sample gets a NOT NULL constraint",
        F.format_string(".isComplete(%s)", _q(col)), F.lit(1.0),
        F.concat(_bq(col), F.lit(" IS NOT NULL")))))

    # E5
    bound = F.greatest(F.lit(0.0), floor_to(p - F.lit(th.z) * F.sqrt(p * (1 - p) / n), 2))
    e5 = prof.filter((p > th.retain_completeness_min) & (p < 1.0)).withColumn("_b", bound)
    out.append(e5.select(*_record(
        col, "completeness", "CompletenessConstraint",
        F.concat(F.lit("Completeness: "), _dec(p, 4)),
        F.format_string("'%s' has at most %s%% missing values", col,
                        _dec((1 - F.col("_b")) * 100, 0)),
        "RetainCompletenessRule",
        "A partly complete column gets a lower bound on its completeness",
        F.format_string(".hasCompleteness(%s, _ >= %s)", _q(col), _dec(F.col("_b"), 2)),
        F.col("_b"), F.concat(_bq(col), F.lit(" IS NOT NULL")))))

    # E6
    e6 = prof.filter((F.col("kind") == "string") &
                     F.col("inferred_type").isin("Integral", "Fractional", "Boolean"))
    typ = F.col("inferred_type")
    pattern = (F.when(typ == "Integral", F.lit(INTEGRAL_PATTERN))
                .when(typ == "Fractional", F.lit(NUMBER_PATTERN))
                .otherwise(F.lit("^(?i)(true|false)$")))
    out.append(e6.select(*_record(
        col, "type", "DataTypeConstraint", F.concat(F.lit("DataType: "), typ),
        F.format_string("'%s' has type %s", col, typ), "RetainTypeRule",
        "A text column whose values all read as one type keeps that type",
        F.format_string(".hasDataType(%s, ConstrainableDataTypes.%s)", _q(col), typ),
        F.lit(1.0),
        F.concat(_bq(col), F.lit(" IS NULL OR trim("), _bq(col), F.lit(") RLIKE '"),
                 F.replace(pattern, F.lit("\\"), F.lit("\\\\")), F.lit("'")))))

    # E7 / E8 on the histogram of text columns
    texts = prof.filter(F.col("kind") == "string").select("column", "non_null")
    h = hist.join(texts, "column")
    w_all = Window.partitionBy("column")
    w_run = Window.partitionBy("column").orderBy(F.desc("cnt"), F.asc("value")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hh = (h.withColumn("_distinct", F.count(F.lit(1)).over(w_all))
           .withColumn("_once", F.sum((F.col("cnt") == 1).cast("long")).over(w_all))
           .withColumn("_run", F.sum("cnt").over(w_run))
           .withColumn("_ratio", F.col("_run") / F.col("non_null"))
           .withColumn("_prev", (F.col("_run") - F.col("cnt")) / F.col("non_null")))
    per_col = hh.groupBy("column").agg(
        F.first("_distinct").alias("distinct"), F.first("_once").alias("once"),
        F.first("non_null").alias("non_null"),
        F.sort_array(F.collect_list(F.struct(-F.col("cnt"), F.col("value")))).alias("_all"),
        F.sort_array(F.collect_list(F.when(F.col("_prev") < th.fractional_coverage,
                                           F.struct(-F.col("cnt"), F.col("value"),
                                                    F.col("_ratio"))))).alias("_top"))
    unique_share = F.col("once") / F.col("distinct")
    all_values = F.transform("_all", lambda s: s["value"])
    top_values = F.transform("_top", lambda s: s["value"])
    coverage = F.element_at("_top", -1)["_ratio"]

    e7 = per_col.filter(unique_share <= th.categorical_unique_share) \
        .withColumn("_vals", all_values)
    out.append(e7.select(*_record(
        col, "categorical", "ComplianceConstraint",
        F.concat(F.lit("Distinct values: "), F.size("_vals").cast("string")),
        F.format_string("'%s' has value range %s", col,
                        F.array_join(F.transform("_vals", _quote_sql), ", ")),
        "CategoricalRangeRule",
        "A low-cardinality column whose values repeat keeps its set of values",
        F.format_string(".isContainedIn(%s, Array(%s))", _q(col),
                        F.array_join(F.transform("_vals", _quote_code), ", ")),
        F.lit(1.0),
        F.concat(_bq(col), F.lit(" IS NULL OR "), _bq(col), F.lit(" IN ("),
                 F.array_join(F.transform("_vals", _quote_sql), ", "), F.lit(")")),
        F.col("_vals"))))

    cov_bound = F.greatest(F.lit(0.0), floor_to(
        F.col("_cov") - F.lit(th.z) * F.sqrt(F.col("_cov") * (1 - F.col("_cov")) / F.col("non_null")), 2))
    e8 = (per_col.filter(unique_share <= th.fractional_unique_share)
          .withColumn("_vals", top_values).withColumn("_cov", coverage)
          .filter(F.size("_vals") < F.col("distinct"))
          .withColumn("_b", cov_bound))
    out.append(e8.select(*_record(
        col, "fractional_categorical", "ComplianceConstraint",
        F.concat(F.lit("Coverage: "), _dec(F.col("_cov"), 4)),
        F.format_string("'%s' has value range %s for at least %s%% of values", col,
                        F.array_join(F.transform("_vals", _quote_sql), ", "),
                        _dec(F.col("_b") * 100, 0)),
        "FractionalCategoricalRangeRule",
        "The most frequent values covering 90% of rows, with a lower bound on their share",
        F.format_string(".isContainedIn(%s, Array(%s), _ >= %s)", _q(col),
                        F.array_join(F.transform("_vals", _quote_code), ", "),
                        _dec(F.col("_b"), 2)),
        F.col("_b"),
        F.concat(_bq(col), F.lit(" IS NULL OR "), _bq(col), F.lit(" IN ("),
                 F.array_join(F.transform("_vals", _quote_sql), ", "), F.lit(")")),
        F.col("_vals"))))

    # E9
    numeric_like = F.col("kind").isin("integral", "fractional") | (
        (F.col("kind") == "string") & F.col("inferred_type").isin("Integral", "Fractional"))
    e9 = prof.filter(numeric_like & (F.col("minimum") >= 0))
    value_expr = F.when(F.col("kind") == "string",
                        F.concat(F.lit("TRY_CAST(trim("), _bq(col), F.lit(") AS DOUBLE)"))) \
        .otherwise(_bq(col))
    out.append(e9.select(*_record(
        col, "non_negative", "ComplianceConstraint",
        F.concat(F.lit("Minimum: "), _dec(F.col("minimum"), 4)),
        F.format_string("'%s' has no negative values", col), "NonNegativeNumbersRule",
        "A numeric column without negative values stays non-negative",
        F.format_string(".isNonNegative(%s)", _q(col)), F.lit(1.0),
        F.concat(_bq(col), F.lit(" IS NULL OR "), value_expr, F.lit(" >= 0")))))

    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def suggest(df: DataFrame, columns=None, th: Thresholds = Thresholds(),
            rsd: float = 0.05) -> DataFrame:
    """Suggestion rows for ``df``, from one scan."""
    return suggest_from_profile(df, column_profile(df, columns, rsd, limit=th.max_histogram_values),
                                th)


def exact_values(row, limit: int) -> list | None:
    """``(value, count)`` of all values of a text column of the profile; an empty list if it has more than
    ``limit``; None if its summary cannot tell, as some values are long."""
    if row["approx_distinct"] > summary_room(limit) // 2:
        return []
    if row["n_long"]:
        return None
    values = [(t["item"], t["count"]) for t in row["top"] if t["item"] is not None]
    # more than fitted: the summary was cut at limit + 2 entries, one of them null
    return values if len(values) <= limit and sum(n for _, n in values) == row["non_null"] else []


def suggest_from_profile(df: DataFrame, prof_df: DataFrame,
                         th: Thresholds = Thresholds()) -> DataFrame:
    """Suggestions from a column profile at hand (of the same ``max_histogram_values``).

    The profile has one row per column with at most ``limit + 2`` short values, so it is brought to
    the driver (bounded by the schema, not the data).  Text columns that have values beyond
    ``LONG_VALUE`` characters and few values by the estimate are counted in one more scan.
    """
    spark = df.sparkSession
    limit = th.max_histogram_values
    rows = prof_df.collect()
    # one row per column: a single partition avoids a task per empty slice
    prof = spark.createDataFrame(rows, prof_df.schema).coalesce(1)
    known = {r["column"]: exact_values(r, limit) for r in rows if r["kind"] == "string"}
    hist = spark.createDataFrame([(c, v, n) for c, values in known.items() for v, n in values or []],
                                 "column string, value string, cnt long").coalesce(1)
    long = [c for c, values in known.items() if values is None]
    if long:
        # written, as values may be long texts
        counted = written(histograms(df, long), "histograms")
        few = counted.groupBy("column").count().where(F.col("count") <= limit).select("column")
        hist = hist.unionByName(counted.join(F.broadcast(few), "column"))   # a row per column
    return rules_from_profile(prof, hist, th)


def profile_and_suggest(df: DataFrame, th: Thresholds = Thresholds(), rsd: float = 0.05,
                        chunk: int = 256) -> tuple[DataFrame, DataFrame]:
    """``(metric rows, suggestions)`` of a table in one scan: one aggregate gives the metrics
    (D10), the column profile (E1) and the value summaries (E3)."""
    specs = metric_specs(df.schema, None, True, rsd)
    own = profile_aggregates(df, None, rsd, limit=th.max_histogram_values)
    aggs = [s.expr.alias(f"_m{i}") for i, s in enumerate(specs)]
    schema, values = one_row(df, aggs + own, chunk)
    metrics = metric_frame(df.sparkSession, specs, values[:len(specs)])
    prof = profile_frame(df, StructType(schema.fields[len(specs):]), values[len(specs):])
    return metrics, suggest_from_profile(df, prof, th)


def flat(suggestions: DataFrame) -> DataFrame:
    """The reference's seven text fields."""
    return suggestions.select(*SUGGESTION_FIELDS)


def grouped(suggestions: DataFrame) -> DataFrame:
    """One row per column with its suggestions, ordered by constraint code."""
    return (suggestions.groupBy(F.col("column_name").alias("column"))
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("code_for_constraint").alias("codeForConstraint"),
                F.col("description"), F.col("constraint_name").alias("constraint")))
            ).alias("suggestions")))


def check_suggestions(df: DataFrame, suggestions, chunk: int = 256) -> DataFrame:
    """Share of rows of ``df`` meeting each suggested predicate, one scan per
    ``chunk`` predicates.

    ``suggestions``: a suggestion frame (collected - it is one row per constraint) or a
    list of rows.  Returns column_name, rule, code_for_constraint, min_fraction,
    pass_fraction, passed.
    """
    rows = suggestions.collect() if isinstance(suggestions, DataFrame) else list(suggestions)
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column_name string, rule string, code_for_constraint string, "
                "min_fraction double, pass_fraction double, passed boolean")
    out = None
    for start in range(0, len(rows), chunk):
        part = rows[start:start + chunk]
        # a predicate that cannot be decided (a number test on other text) is not met
        aggs = [F.avg(F.coalesce(F.expr(r["sql_predicate"]), F.lit(False)).cast("double"))
                .alias(f"p{i}")
                for i, r in enumerate(part)]
        wide = df.agg(*aggs)
        structs = [F.struct(F.lit(r["column_name"]).alias("column_name"),
                            F.lit(r["rule"]).alias("rule"),
                            F.lit(r["code_for_constraint"]).alias("code_for_constraint"),
                            F.lit(float(r["min_fraction"])).alias("min_fraction"),
                            F.col(f"p{i}").alias("pass_fraction"))
                   for i, r in enumerate(part)]
        res = wide.select(F.inline(F.array(*structs)))
        out = res if out is None else out.unionByName(res)
    return out.withColumn("passed", F.coalesce(F.col("pass_fraction") >= F.col("min_fraction"),
                                               F.lit(True)))


__all__ = ["column_profile", "profile_and_suggest", "histograms", "rules_from_profile", "suggest", "flat", "grouped",
           "check_suggestions", "Thresholds", "SUGGESTION_FIELDS", "INTEGRAL_PATTERN",
           "FRACTIONAL_PATTERN"]
