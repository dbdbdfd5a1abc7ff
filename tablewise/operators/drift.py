"""Classifier two-sample test for drift (M1-M3, M12), after Lopez-Paz & Oquab (ICLR 2017).

A boosted-tree classifier learns to tell the newest slice (label 1) from earlier ones
(label 0).  AUC near 0.5: the slices look alike; well above: the data changed, and the
mean absolute SHAP value per column names the columns that changed.

The trees (``boosting``) split categories and missing values themselves; sums of gradients are
taken on the executors, and boosting stops by the loss on the test rows, which also give the final
metrics.  Every value of a text column counts (as a category of its own, or by its label rate in
columns with very many values, see ``features``), and every test row is explained.  The feature
table is persisted once and released afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewise.functions.hashing import fast_hash
from tablewise.operators.boosting import BoostedTrees, BoostParams, fit_boosted, with_margin
from tablewise.operators.features import (FOLDS, FeaturePlan, encode, label_rates, plan_features,
                                          with_rates)
from tablewise.operators.metrics import (ACCURACY, F1, PRECISION, RECALL, ROC_AUC,
                                         classification_report, metric_rows)
from tablewise.operators.profile import label_counts, qcol
from tablewise.operators.sampling import bounded_sample, key_text, stratified_split
from tablewise.operators.shap import MAX_DEPTH as MAX_SHAP_DEPTH
from tablewise.operators.shap import mean_abs_shap, shap_values
from tablewise.session import ensure_checkpoint_dir, written


@dataclass(frozen=True)
class DriftParams:
    max_iter: int = 500          # boosting rounds at most
    patience: int = 20           # rounds after the best one before boosting stops
    max_depth: int = 6
    step_size: float = 0.3
    l2: float = 1.0              # weight of the L2 term on leaf values
    min_hessian: float = 1.0     # least hessian sum of a child
    seed: int = 42
    test_share: float = 0.2
    shap_rows: int | None = None  # None: every test row is explained
    auc_buckets: int = 1024
    with_accuracy: bool = True
    rows_per_partition: int = 250_000

    def __post_init__(self):
        if not 1 <= self.max_depth <= MAX_SHAP_DEPTH:
            raise ValueError(f"max_depth is 1 to {MAX_SHAP_DEPTH}")

    def boosting(self) -> BoostParams:
        return BoostParams(self.max_iter, self.patience, self.max_depth, self.step_size, self.l2,
                           self.min_hessian)


@dataclass
class DriftResult:
    metrics: DataFrame                 # [ts, path,] table, type, column, metric, value
    plan: FeaturePlan | None = None
    model: BoostedTrees | None = None
    scored: DataFrame | None = None    # with keep_rows: key, label, margin, prediction, score
    shap: DataFrame | None = None      # with keep_rows: the SHAP rows
    notes: dict = field(default_factory=dict)


def _null_metrics(spark, table, params: DriftParams, ts=None, path=None) -> DataFrame:
    names = [ROC_AUC] + ([ACCURACY] if params.with_accuracy else []) + [PRECISION, RECALL, F1]
    one = spark.range(1).select(*[F.lit(None).cast("double").alias(n) for n in names])
    return metric_rows(one, names, table, ts=ts, path=path)


def drift_model(labelled: DataFrame, key: str, table: str, label_col: str = "label",
                exclude=(), exclude_prefixes=(), params: DriftParams = DriftParams(),
                ts=None, path: str | None = None, with_shap: bool = True,
                keep_rows: bool = False) -> DriftResult:
    """M1-M3 + metrics (M4-M8, M11) + SHAP (M9-M10) for a labelled slice.

    ``key``: a unique row key (hash split and SHAP sample are keyed on it).
    Returns metric rows; model-level metrics are null (not an exception) when a class
    is missing or there are no usable features (the reference failed there).
    """
    spark = labelled.sparkSession
    ensure_checkpoint_dir(spark)   # written tables (rates, scored rows) go there
    counts = label_counts(labelled, label_col).first()
    plan = plan_features(labelled, label_col=label_col, exclude=set(exclude) | {key},
                         exclude_prefixes=exclude_prefixes, keep=[key], encoding="native")
    notes = {"class_counts": {1: counts["n_current"], 0: counts["n_previous"]},
             "dropped": plan.dropped, "distinct_ratio": plan.distinct_ratio}
    if not plan.slots or counts["n_current"] < 2 or counts["n_previous"] < 2:
        return DriftResult(_null_metrics(spark, table, params, ts, path), plan, notes=notes)

    split = stratified_split(labelled, label_col, key, params.test_share, params.seed)
    split = split.persist(StorageLevel.MEMORY_AND_DISK)
    n_parts = max(spark.sparkContext.defaultParallelism,
                  -(-counts["n_total"] // params.rows_per_partition))
    train = ~F.col("is_test")
    if plan.rated:
        fold = fast_hash(key_text(labelled, key), f"fold:{params.seed}") % FOLDS
        rates = label_rates(split, plan.rated, label_col, fold, train)
        rated = with_rates(split, rates, plan.rated, fold, train,
                           counts["n_current"] / counts["n_total"])
    else:
        rated = split
    # the encoded rows are binned, scored and explained: cached once, spread over the cluster
    data = (encode(rated, plan, keep=[key, label_col, "is_test"], vector_col=None)
            .withColumn(label_col, qcol(label_col).cast("double"))
            .repartition(n_parts).persist(StorageLevel.MEMORY_AND_DISK))
    scored = None
    try:
        test = data.filter(F.col("is_test"))
        model = fit_boosted(data, plan.slot_names, [c in plan.categorical for c in plan.slot_sources],
                            label_col, "is_test", params.boosting())
        scored = (with_margin(test, model, keep=[key, label_col])
                  .persist(StorageLevel.MEMORY_AND_DISK))
        metrics = _materialise(classification_report(
            scored, table, label_col, "prediction", "score", params.with_accuracy,
            params.auc_buckets, ts, path))
        kept_scores = kept_shap = None
        if keep_rows:
            kept_scores = written(scored.select(qcol(key), qcol(label_col), "margin", "prediction",
                                                "score"), "scored")
        if with_shap:
            sample = (bounded_sample(test, params.shap_rows, key, params.seed)
                      .repartition(spark.sparkContext.defaultParallelism)
                      if params.shap_rows else test)
            shap_df = shap_values(sample, model, plan.slot_sources, keep=[key, label_col])
            if keep_rows:
                shap_df = kept_shap = written(shap_df, "shap")
            sources = list(dict.fromkeys(plan.slot_sources))
            metrics = metrics.unionByName(_materialise(
                mean_abs_shap(shap_df, sources, table, ts, path)))
        notes["trees"], notes["fitted"] = len(model.trees), model.fitted
        notes["test_loss"] = model.losses[1:]
        return DriftResult(metrics, plan, model, kept_scores, kept_shap, notes)
    finally:
        for frame in (scored, data, split):
            if frame is not None:
                frame.unpersist()


def _materialise(df: DataFrame) -> DataFrame:
    """Metric frames are a handful of rows: compute them while the input is cached."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


__all__ = ["DriftParams", "DriftResult", "drift_model"]
