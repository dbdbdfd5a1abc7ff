"""Feature table for the drift classifier.

The reference pulled the sample into pandas, replaced lists by their length, turned
datetimes into text and made every text column a pandas category.  Here the same
decisions are taken from the schema plus one small aggregate, and the encoding is a
``select`` of column expressions, so the table never leaves the executors:

* B12/B13  drop columns by name and by prefix
* B14      keep numeric (incl. decimal, boolean as 0/1), text as categories,
           arrays as their length; drop maps, structs, binaries
* B15      array -> ``size`` (null stays missing)
* B16      timestamps: excluded by default (in a day-vs-day test the time column gives
           the label away); ``time_as_category=True`` formats them as text categories
* B17      categories, three encodings.  ``encoding="rate"``: every value of
           every text column counts; a value becomes the smoothed share of label-1 rows
           among the training rows that have it (for a training row: those of the other
           folds), joined from a ``(column, value)`` table.  ``encoding="codes"``: the
           ``max_categories`` most frequent values (count desc, value asc) keep a code, the
           rest share ``other``, null has its own; the column carries nominal metadata.
           ``encoding="native"`` (the drift model, whose trees split categories themselves): a
           text column with at most ``NATIVE_CATEGORIES`` values, and ``ROWS_PER_CATEGORY``
           rows for each on average, has a code for every one of them and null for null; a
           column with more values, or too few rows to tell them apart, gets its (smoothed)
           label rates
* B18      numeric nulls and NaNs: filled with 0 plus a 0/1 ``<col>__isnull`` indicator, both
           attributed to the source column; with ``native`` they stay null and the trees learn
           the side of missing rows
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DateType, DoubleType, FloatType, MapType,
                               NumericType, StringType, StructType, TimestampNTZType,
                               TimestampType)

from tablewise.operators.profile import qcol
from tablewise.session import shared_dir

OTHER = "__other__"
NULL = "__null__"


@dataclass
class FeaturePlan:
    numeric: list = field(default_factory=list)        # source columns used as numbers
    arrays: list = field(default_factory=list)         # array columns (length feature)
    categorical: dict = field(default_factory=dict)    # column -> kept values, in code order
    time_text: list = field(default_factory=list)      # time columns used as text categories
    null_flags: list = field(default_factory=list)     # numeric columns with an indicator
    dropped: dict = field(default_factory=dict)        # column -> reason
    rated: list = field(default_factory=list)          # text columns encoded by label rate
    slots: list = field(default_factory=list)          # (slot name, source column)
    distinct_ratio: dict = field(default_factory=dict)  # text column -> approx distinct / rows
    native: bool = False                               # missing stays null, codes for all values

    @property
    def slot_names(self):
        return [s for s, _ in self.slots]

    @property
    def slot_sources(self):
        return [c for _, c in self.slots]

    def max_categories(self) -> int:
        return max([len(v) + 2 for v in self.categorical.values()] or [2])


def _kind(dtype) -> str:
    if isinstance(dtype, BooleanType):
        return "bool"
    if isinstance(dtype, NumericType):
        return "num"
    if isinstance(dtype, StringType):
        return "text"
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return "time"
    if isinstance(dtype, ArrayType):
        return "array"
    if isinstance(dtype, (MapType, StructType, BinaryType)):
        return "nested"
    return "other"


def category_table(df: DataFrame, columns, k: int = 62) -> DataFrame:
    """``(column, value, n, code)`` for the ``k`` most frequent values of each column.

    All columns are unpivoted into one ``(column, value)`` frame and counted with one
    shuffle (map-side combined); Spark plans the rank filter as a limit per group before the
    second one, so a column with very many values sends ``k`` rows per task.
    """
    cols = list(columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, n long, code int")
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("value"))
        for c in cols]))).filter(F.col("value").isNotNull())
    freq = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value")))
    return (freq.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("column", "value", "n", (F.col("rank") - 1).cast("int").alias("code")))


FOLDS = 5
NATIVE_CATEGORIES = 254      # codes that fit a byte beside the mark of missing rows
ROWS_PER_CATEGORY = 20       # fewer rows a value: free subsets of values would fit noise


def value_text(c: Column) -> Column:
    """A value as join text; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def label_rates(df: DataFrame, columns, label_col: str, fold: Column, train: Column) -> DataFrame:
    """``(column, value, n, n1, folds)`` over the training rows: rows and label-1 rows of every
    value of every column, in all and per fold.  Written to the shared folder, one part per
    column, so that joins know the sizes."""
    lab = qcol(label_col).cast("int")
    pairs = (df.where(train).select(lab.alias("y"), fold.alias("f"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), value_text(qcol(c)).alias("value")) for c in columns]))))
    per = pairs.groupBy("column", "value", "f").agg(F.count(F.lit(1)).alias("n"),
                                                    F.sum("y").alias("n1"))
    rates = per.groupBy("column", "value").agg(
        F.sum("n").alias("n"), F.sum("n1").alias("n1"),
        F.map_from_entries(F.collect_list(F.struct("f", F.struct("n", "n1")))).alias("folds"))
    path = shared_dir(df.sparkSession, "label-rates")
    rates.write.partitionBy("column").parquet(path)
    return df.sparkSession.read.schema(rates.schema).parquet(path)


def with_rates(df: DataFrame, rates: DataFrame, columns, fold: Column, train: Column,
               base: float, smooth: float = 10.0) -> DataFrame:
    """``df`` with ``<column>__rate``: the smoothed label-1 share of the row's value, without the
    row's own fold for training rows; unseen values get the base rate."""
    for i, c in enumerate(columns):
        table = rates.where(F.col("column") == c).select(
            F.col("value").alias("_v"), F.col("n").alias("_n"), F.col("n1").alias("_n1"),
            F.col("folds").alias("_f"))
        own = F.when(train, F.try_element_at("_f", fold))
        n = F.coalesce("_n", F.lit(0)) - F.coalesce(own["n"], F.lit(0))
        n1 = F.coalesce("_n1", F.lit(0)) - F.coalesce(own["n1"], F.lit(0))
        rate = (n1 + F.lit(smooth * base)) / (n + F.lit(smooth))
        df = (df.join(table, value_text(qcol(c)) == F.col("_v"), "left")
              .withColumn(f"{c}__rate", rate).drop("_v", "_n", "_n1", "_f"))
    return df


def plan_features(df: DataFrame, label_col: str = "label", exclude=(), exclude_prefixes=(),
                  max_categories: int = 62, time_as_category: bool = False, keep=(),
                  encoding: str = "codes") -> FeaturePlan:
    """Decide the feature slots from the schema plus one aggregate.

    No text column is left out for its number of values (``distinct_ratio`` reports it); the
    caller excludes ids.  Data reaching the driver: one row of counts and, for codes, at most
    ``max_categories`` values per text column.
    """
    plan = FeaturePlan()
    skip = set(exclude) | {label_col} | set(keep)
    fields = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if any(f.name.startswith(p) for p in exclude_prefixes):
            plan.dropped[f.name] = "prefix"
            continue
        kind = _kind(f.dataType)
        if kind == "time" and not time_as_category:
            plan.dropped[f.name] = "time column"
            continue
        if kind in ("nested", "other"):
            plan.dropped[f.name] = f"type {f.dataType.simpleString()}"
            continue
        fields.append((f.name, kind))

    aggs = [F.count(F.lit(1)).alias("_rows")]
    for name, kind in fields:
        c = qcol(name)
        if kind in ("num", "bool", "array"):
            aggs.append(F.count(present(df, name)).alias(f"nn::{name}"))
        elif kind in ("text", "time"):
            aggs.append(F.approx_count_distinct(c).alias(f"nd::{name}"))
    stats = {}
    for start in range(0, len(aggs), 256):       # bounded aggregates for wide tables
        stats.update(df.agg(*aggs[start:start + 256]).first().asDict())
    rows = stats["_rows"] or 0

    cat_cols = []
    for name, kind in fields:
        if kind in ("num", "bool"):
            plan.numeric.append(name)
        elif kind == "array":
            plan.arrays.append(name)
        elif kind in ("text", "time"):
            plan.distinct_ratio[name] = (stats.get(f"nd::{name}") or 0) / max(rows, 1)
            cat_cols.append(name)
            if kind == "time":
                plan.time_text.append(name)
        if kind in ("num", "bool", "array") and stats.get(f"nn::{name}", rows) < rows:
            plan.null_flags.append(name)

    plan.native = encoding == "native"
    if plan.native:
        plan.null_flags = []
    if cat_cols and encoding == "rate":
        plan.rated = cat_cols
    elif cat_cols and plan.native:
        src = df.select(*[_text_of(df, c, plan) for c in cat_cols])
        found = {c: [] for c in cat_cols}
        most = min(NATIVE_CATEGORIES, rows // ROWS_PER_CATEGORY)
        # one value more than fits tells a column that has too many
        for r in category_table(src, cat_cols, most + 1).orderBy("column", "code").collect():
            found[r["column"]].append(r["value"])
        plan.categorical = {c: v for c, v in found.items() if len(v) <= most}
        plan.rated = [c for c in cat_cols if c not in plan.categorical]
    elif cat_cols:
        src = df.select(*[_text_of(df, c, plan) for c in cat_cols])
        plan.categorical = {c: [] for c in cat_cols}
        for r in category_table(src, cat_cols, max_categories).orderBy("column", "code").collect():
            plan.categorical[r["column"]].append(r["value"])

    for name, kind in fields:
        if name in plan.numeric or name in plan.arrays:
            plan.slots.append((name, name))
            if name in plan.null_flags:
                plan.slots.append((f"{name}__isnull", name))
        elif name in plan.categorical or name in plan.rated:
            plan.slots.append((name, name))
    return plan


def present(df: DataFrame, name: str) -> Column:
    """The value, or null if it is null or NaN."""
    c = qcol(name)
    return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType)) if isinstance(
        df.schema[name].dataType, (FloatType, DoubleType)) else c


def _text_of(df: DataFrame, name: str, plan: FeaturePlan) -> Column:
    """Time columns as ``yyyy-MM-dd HH:mm:ss`` text; text columns as they are."""
    if _kind(df.schema[name].dataType) == "time":
        return F.date_format(qcol(name), "yyyy-MM-dd HH:mm:ss").alias(name)
    return qcol(name)


def category_code(c: Column, values) -> Column:
    """Code of a value: position in ``values`` (0-based), ``len`` for other, ``len+1`` null."""
    m = len(values)
    if m == 0:
        return F.when(c.isNull(), F.lit(1.0)).otherwise(F.lit(0.0))
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), c)
    return (F.when(c.isNull(), F.lit(float(m + 1)))
             .when(pos > 0, (pos - 1).cast("double"))
             .otherwise(F.lit(float(m))))


def native_code(c: Column, values) -> Column:
    """Position of a value in ``values`` (0-based), null for null and for any other value."""
    known = F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")
    return F.nullif(F.array_position(known, c), F.lit(0)).cast("double") - 1.0


def feature_columns(df: DataFrame, plan: FeaturePlan) -> list:
    """The encoded slot columns (doubles; categories of the ``codes`` encoding with nominal
    metadata)."""
    out = []
    for slot, src in plan.slots:
        c = present(df, src)
        if src in plan.rated:
            out.append(qcol(f"{src}__rate").alias(slot))
        elif slot.endswith("__isnull"):
            out.append(F.when(c.isNull(), F.lit(1.0)).otherwise(F.lit(0.0)).alias(slot))
        elif src in plan.arrays:
            # size(null) is -1 under the legacy (non-ANSI) setting: guard it explicitly
            length = F.when(c.isNotNull(), F.size(c)).cast("double")
            out.append((F.coalesce(length, F.lit(0.0)) if src in plan.null_flags else length)
                       .alias(slot))
        elif src in plan.numeric:
            d = c.cast("double")
            out.append((F.coalesce(d, F.lit(0.0)) if src in plan.null_flags else d).alias(slot))
        elif plan.native:
            out.append(native_code(_text_of(df, src, plan), plan.categorical[src]).alias(slot))
        else:
            values = plan.categorical[src]
            text = _text_of(df, src, plan)
            meta = {"ml_attr": {"type": "nominal", "name": slot,
                                "num_vals": len(values) + 2}}
            out.append(category_code(text, values).alias(slot, metadata=meta))
    return out


def encode(df: DataFrame, plan: FeaturePlan, keep=(), vector_col: str | None = "features"):
    """Encoded frame: ``keep`` columns + slot columns (+ one vector column)."""
    enc = df.select(*[qcol(k) for k in keep], *feature_columns(df, plan))
    if vector_col:
        from pyspark.ml.feature import VectorAssembler
        va = VectorAssembler(inputCols=plan.slot_names, outputCol=vector_col,
                             handleInvalid="keep")
        enc = va.transform(enc)
    return enc


__all__ = ["FeaturePlan", "plan_features", "encode", "feature_columns", "category_table", "label_rates",
           "with_rates", "value_text", "FOLDS", "NATIVE_CATEGORIES",
           "category_code", "OTHER", "NULL"]
