"""Sinks (A5-A11).

* A5  metric rows appended to a table partitioned by ``table``
* A6  suggestions as one JSON document per table ``{"table": .., "suggestions": [..]}``
* A7  suggestions grouped by column, one JSON line per column
* A8-A11 metric exposition text lines ``name{label="value",...} number``: label values
  escaped (backslash, double quote, newline), a null label is "" (A10), rows whose value
  is not a number are skipped (A11).  Lines are a DataFrame - write them with
  ``write.text`` or hand them to any pusher; no network client is built here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.operators.suggest import SUGGESTION_FIELDS, grouped

# Default metric names of the exposition lines (ours; the caller may pass others).
PROFILE_METRIC = "tablewise_profile_metric"
ML_METRIC = "tablewise_ml_metric"


def append_metrics(df: DataFrame, path: str, partition_by=("table",), fmt: str = "parquet",
                   mode: str = "append") -> None:
    """A5: append metric rows; ``partitionBy`` keeps one folder per table."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def suggestions_document(suggestions: DataFrame, table: str) -> DataFrame:
    """One row, column ``json``: ``{"table": .., "suggestions": [7-field records]}``.

    The suggestion list is one record per (column, rule) - bounded by the schema.
    """
    recs = F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in SUGGESTION_FIELDS])))
    return suggestions.agg(recs.alias("suggestions")).select(
        F.to_json(F.struct(F.lit(table).alias("table"), F.col("suggestions"))).alias("json"))


def suggestions_by_column(suggestions: DataFrame) -> DataFrame:
    """One JSON line per column ``{"column":.., "suggestions":[{codeForConstraint,
    description, constraint}]}``."""
    return grouped(suggestions).select(F.to_json(F.struct("column", "suggestions")).alias("json"))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-column ``json`` frame as text lines."""
    df.select("json").write.mode(mode).text(path)


def escape_label(c: Column) -> Column:
    """Exposition escaping; null becomes the empty string."""
    v = F.coalesce(c.cast("string"), F.lit(""))
    v = F.replace(v, F.lit("\\"), F.lit("\\\\"))
    v = F.replace(v, F.lit('"'), F.lit('\\"'))
    return F.replace(v, F.lit("\n"), F.lit("\\n"))


def number_text(c: Column, decimals: int | None = None) -> Column:
    """Value text: the shortest text that reads back as the same double, ``NaN``, ``+Inf`` or
    ``-Inf``; with ``decimals``, finite values below 1e18 have that many fixed places."""
    d = c.cast("double")
    text = d.cast("string")
    if decimals is not None:
        text = F.when(F.abs(d) < 1e18, F.round(d, decimals).cast(f"decimal(38,{decimals})")
                      .cast("string")).otherwise(text)
    return (F.when(F.isnan(d), F.lit("NaN")).when(d == float("inf"), F.lit("+Inf"))
            .when(d == float("-inf"), F.lit("-Inf")).otherwise(text))


def exposition_lines(df: DataFrame, metric: str, labels, value_col: str = "value",
                     decimals: int | None = None) -> DataFrame:
    """``metric{l1="..",l2=".."} value`` per row whose value is a number (NaN and the
    infinities included).

    ``labels``: list of (label name, Column).
    """
    value = F.col(value_col).cast("string").try_cast("double")
    parts = []
    for i, (name, col) in enumerate(labels):
        parts += [F.lit(("," if i else "") + f'{name}="'), escape_label(col), F.lit('"')]
    line = F.concat(F.lit(metric + "{"), *parts, F.lit("} "), number_text(value, decimals))
    return df.filter(value.isNotNull()).select(line.alias("line"))


def profile_exposition(profile_df: DataFrame, table: str, metric: str = PROFILE_METRIC,
                       decimals: int | None = None) -> DataFrame:
    """Labels (table, entity, instance, name)."""
    return exposition_lines(profile_df, metric,
                            [("table", F.lit(table)), ("entity", F.col("entity")),
                             ("instance", F.col("instance")), ("name", F.col("name"))],
                            decimals=decimals)


def ml_exposition(ml_df: DataFrame, metric: str = ML_METRIC, with_path: bool = False,
                  decimals: int | None = None) -> DataFrame:
    """Labels ([path,] table, metric_type, column, metric)."""
    labels = ([("path", F.col("path"))] if with_path else []) + [
        ("table", F.col("table")), ("metric_type", F.col("type")),
        ("column", F.col("column")), ("metric", F.col("metric"))]
    return exposition_lines(ml_df, metric, labels, decimals=decimals)


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.write.mode(mode).text(path)


__all__ = ["append_metrics", "suggestions_document", "suggestions_by_column",
           "write_json_lines", "escape_label", "number_text", "exposition_lines",
           "profile_exposition", "ml_exposition", "write_lines", "PROFILE_METRIC", "ML_METRIC"]
