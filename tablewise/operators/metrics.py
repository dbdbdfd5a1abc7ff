"""Classification metrics of the drift classifier.

All of them are aggregates of the scored frame:

* confusion counts, accuracy, precision, recall, F1: one aggregate, the zero-division
  rule of the reference (0 when a denominator is empty)
* ROC AUC: exact, with ties counted one half (the rank-sum / Mann-Whitney form).  It
  needs, for every score, the number of negatives with a lower score - a running sum
  over a global order.  Instead of one task sorting everything, the distinct scores are
  cut into ``buckets`` ranges at approximate quantiles; per-bucket totals (at most
  ``buckets`` rows) give each range its offset, and the running sum inside a range is
  a window over that range only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewise.functions.mathx import safe_ratio
from tablewise.operators.profile import qcol
from tablewise.session import written

# Metric names of the metric table.
ROC_AUC = "roc_auc"
ACCURACY = "accuracy"
PRECISION = "precision"
RECALL = "recall"
F1 = "f1_score"
ML_METRIC_TYPE = "MLMetric"


def confusion(scored: DataFrame, label_col: str = "label",
              pred_col: str = "prediction") -> DataFrame:
    """One row: tp, fp, fn, tn (bigint)."""
    y = qcol(label_col).cast("int")
    p = qcol(pred_col).cast("int")
    return scored.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                      F.count_if((y == 0) & (p == 1)).alias("fp"),
                      F.count_if((y == 1) & (p == 0)).alias("fn"),
                      F.count_if((y == 0) & (p == 0)).alias("tn"))


def rates(conf: DataFrame) -> DataFrame:
    """M5-M8 from confusion counts (0 on an empty denominator)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return conf.select(
        "tp", "fp", "fn", "tn",
        safe_ratio(tp + tn, tp + fp + fn + tn).alias(ACCURACY),
        safe_ratio(tp, tp + fp).alias(PRECISION),
        safe_ratio(tp, tp + fn).alias(RECALL),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias(F1))


def score_bucket_splits(g: DataFrame, score_col: str, buckets: int) -> list:
    """Approximate quantiles of the distinct scores (at most ``buckets`` values); the sketch is
    ten times finer than the ranges."""
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    q = g.agg(F.percentile_approx(F.col(score_col), probs, max(10_000, 10 * buckets))
              .alias("q")).first()["q"]
    return sorted({float(v) for v in (q or []) if v is not None})


RANGE_ROWS = 1_000_000     # distinct scores per range (one window each)
MAX_BUCKETS = 8_192        # split points brought to the driver


def roc_auc(scored: DataFrame, label_col: str = "label", score_col: str = "score",
            buckets: int = 1024, range_rows: int = RANGE_ROWS) -> DataFrame:
    """M4: one row ``roc_auc`` (null when a class is missing).

    The scored rows are read once: their counts per distinct score are written to the shared
    folder, and everything else reads that table.  Up to ``range_rows`` distinct scores are one
    range; beyond, there are at least ``buckets`` ranges, and as many as keep about
    ``range_rows`` scores in each (at most ``MAX_BUCKETS``; then ranges get larger).
    """
    y = qcol(label_col).cast("int")
    s = qcol(score_col).cast("double")
    g = written(scored.select(s.alias("_s"), y.alias("_y")).filter(F.col("_s").isNotNull())
                .groupBy("_s").agg(F.count_if(F.col("_y") == 1).alias("_pos"),
                                   F.count_if(F.col("_y") == 0).alias("_neg")), "auc")
    n_distinct = g.count()
    buckets = min(MAX_BUCKETS, max(buckets, -(-n_distinct // range_rows)))
    splits = score_bucket_splits(g, "_s", 1 if n_distinct <= range_rows else buckets)
    if splits:
        # bucket = number of split points <= score (binary search in the JVM)
        from pyspark.ml.feature import Bucketizer
        edges = [float("-inf")] + splits + [float("inf")]
        gb = Bucketizer(splits=edges, inputCol="_s", outputCol="_b",
                        handleInvalid="keep").transform(g)
    else:
        gb = g.withColumn("_b", F.lit(0.0))
    per_bucket = gb.groupBy("_b").agg(F.sum("_neg").alias("_bneg"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_bneg").over(before), F.lit(0)))
    # offsets has at most `buckets` + 1 rows: a bounded broadcast
    j = gb.join(F.broadcast(offsets.select("_b", "_off")), "_b")
    inside = Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    j = j.withColumn("_below", F.col("_off") + F.coalesce(F.sum("_neg").over(inside), F.lit(0)))
    num = F.sum(F.col("_pos").cast("double") *
                (F.col("_below").cast("double") + 0.5 * F.col("_neg").cast("double")))
    den = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return j.agg(F.try_divide(num, F.when(den > 0, den)).alias(ROC_AUC))


def metric_rows(wide: DataFrame, names, table: str, mtype: str = ML_METRIC_TYPE,
                ts=None, path: str | None = None) -> DataFrame:
    """M11 (+ M12): one-row metric frame -> rows (``[ts, path,] table, type, column,
    metric, value``); ``column`` is null for model-level metrics."""
    structs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
               for n in names]
    front = []
    if ts is not None or path is not None:
        front = [(F.lit(ts).cast("timestamp") if ts is not None
                  else F.current_timestamp()).alias("timestamp"),
                 F.lit(path).cast("string").alias("path")]
    return (wide.select(F.inline(F.array(*structs)))
            .select(*front, F.lit(table).alias("table"), F.lit(mtype).alias("type"),
                    F.lit(None).cast("string").alias("column"), "metric", "value"))


def classification_report(scored: DataFrame, table: str, label_col: str = "label",
                          pred_col: str = "prediction", score_col: str = "score",
                          with_accuracy: bool = True, buckets: int = 1024,
                          ts=None, path: str | None = None) -> DataFrame:
    """M4-M8 + M11: metric rows of a scored frame (AUC, [accuracy,] precision, recall, F1)."""
    r = rates(confusion(scored, label_col, pred_col))
    auc = roc_auc(scored, label_col, score_col, buckets)
    names = ([ACCURACY] if with_accuracy else []) + [PRECISION, RECALL, F1]
    # two one-row aggregates -> long rows each, then a union (no join needed)
    return (metric_rows(auc, [ROC_AUC], table, ts=ts, path=path)
            .unionByName(metric_rows(r, names, table, ts=ts, path=path)))


__all__ = ["confusion", "rates", "roc_auc", "metric_rows", "classification_report",
           "ROC_AUC", "ACCURACY", "PRECISION", "RECALL", "F1", "ML_METRIC_TYPE"]
