"""End-to-end jobs.

J1 ``table_report``   whole table -> suggestions + profile
J2 ``quality_report`` slice at a time -> suggestions + profile of the slice; the same slot
                      on ``n_days`` days -> sample -> drift classifier -> metric rows
J3 ``drift_report``   newest slot + the same slot the day before -> profile of the slice;
                      sample -> drift classifier (no accuracy) -> metric rows
J4 ``RunConfig``      run parameters, from keyword arguments or the Spark conf

Each report is a set of small, materialised DataFrames; ``rows()`` gives one long frame
``(timestamp, path, section, table, type, column, metric, value)`` for a metrics sink, so that
rows of several runs can be told apart.  Secrets (JDBC
credentials) are never defaults: the caller passes them in ``source_options``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, fields, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.operators.drift import DriftParams, drift_model
from tablewise.operators.profile import label_counts, profile
from tablewise.operators.sampling import sample_by_class
from tablewise.operators.slices import latest_slice, slice_at, slice_days
from tablewise.operators.suggest import profile_and_suggest

CONF_PREFIX = "spark.tablewise."

# Run-parameter keys of existing jobs accepted as aliases (first found wins).
CONF_ALIASES = {
    "table": ("spark.tableName", "spark.table"),
    "sample_frac": ("spark.sampleFrac",),
    "run_ts": ("spark.ts.value",),
}
JDBC_CONF_ALIASES = {"url": "spark.jdbc.url", "user": "spark.jdbc.user",
                     "password": "spark.jdbc.password", "driver": "spark.jdbc.driver",
                     "partition_column": "spark.jdbc.partitionColumn",
                     "lower_bound": "spark.jdbc.lowerBound",
                     "upper_bound": "spark.jdbc.upperBound",
                     "num_partitions": "spark.jdbc.numPartitions",
                     "fetchsize": "spark.jdbc.fetchsize"}


@dataclass(frozen=True)
class RunConfig:
    """Run parameters.  ``from_conf`` reads ``spark.tablewise.<name>`` keys."""
    table: str = "table"
    ts_col: str = "ts"
    key: str = "id"
    at: str | None = None            # slice time; None = newest (B7)
    grain: str = "minute"
    n_days: int = 3
    sample_frac: float = 0.5
    seed: int = 42
    test_share: float = 0.2
    max_iter: int = 500
    patience: int = 20
    max_depth: int = 6
    shap_rows: int | None = None     # None: every test row
    exclude: tuple = ()
    exclude_prefixes: tuple = ()
    run_ts: str | None = None        # time stamp on metric rows (M12); None = now
    path: str | None = None          # source path (written on metric rows too)
    source_format: str = "parquet"   # any Spark format; "jdbc" reads ``table`` via options
    # may hold credentials, so it is left out of the printed form
    source_options: dict = field(default_factory=dict, hash=False, compare=False, repr=False)

    @classmethod
    def from_conf(cls, spark: SparkSession, **overrides) -> "RunConfig":
        """``spark.tablewise.<field>`` keys, else the aliases in ``CONF_ALIASES``; JDBC
        connection, driver and split from their alias keys make the source a JDBC table."""
        vals = {}
        for f in fields(cls):
            if f.name == "source_options":
                continue
            raw = spark.conf.get(CONF_PREFIX + f.name, None)
            for alias in CONF_ALIASES.get(f.name, ()):
                if raw is None:
                    raw = spark.conf.get(alias, None)
            if raw is None:
                continue
            default = f.default
            if isinstance(default, bool):
                vals[f.name] = raw.lower() == "true"
            elif isinstance(default, int) or f.name == "shap_rows":
                vals[f.name] = int(raw)
            elif isinstance(default, float):
                vals[f.name] = float(raw)
            elif isinstance(default, tuple):
                vals[f.name] = tuple(x.strip() for x in raw.split(",") if x.strip())
            else:
                vals[f.name] = raw.replace("T", " ") if f.name == "run_ts" else raw
        jdbc = {k: spark.conf.get(v, None) for k, v in JDBC_CONF_ALIASES.items()}
        jdbc = {k: v for k, v in jdbc.items() if v is not None}
        if "url" in jdbc and "source_options" not in overrides:
            vals.setdefault("source_format", "jdbc")
            vals["source_options"] = jdbc
        return replace(cls(**vals), **overrides)

    def load(self, spark: SparkSession) -> DataFrame:
        """The source table: ``source_format`` + ``path`` / ``source_options``
        (credentials only from ``source_options``, never from defaults)."""
        from tablewise.sources.readers import read_jdbc, read_path
        if self.source_format == "jdbc":
            opts = dict(self.source_options)
            url = opts.pop("url")
            return read_jdbc(spark, url, opts.pop("dbtable", self.table), **opts)
        if not self.path:
            raise ValueError("RunConfig.path is needed for a path-based source")
        return read_path(spark, self.path, self.source_format, **self.source_options)

    def drift_params(self) -> DriftParams:
        return DriftParams(max_iter=self.max_iter, patience=self.patience,
                           max_depth=self.max_depth, seed=self.seed,
                           test_share=self.test_share, shap_rows=self.shap_rows)

    def stamp(self) -> dict:
        """Run time (now, if none is set) and source path of a report."""
        return {"ts": self.run_ts or dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"),
                "path": self.path or self.table}


@dataclass
class Report:
    table: str
    frames: dict
    ts: str | None = None
    path: str | None = None

    def rows(self) -> DataFrame:
        """One long frame: timestamp, path, section, table, type, column, metric, value."""
        out = None
        for section, df in self.frames.items():
            cols = set(df.columns)
            if {"entity", "instance", "name", "value"} <= cols:
                part = df.select(F.lit(section).alias("section"), F.lit(self.table).alias("table"),
                                 F.col("entity").alias("type"), F.col("instance").alias("column"),
                                 F.col("name").alias("metric"), F.col("value").cast("double"))
            elif {"type", "column", "metric", "value"} <= cols:
                part = df.select(F.lit(section).alias("section"), F.lit(self.table).alias("table"),
                                 "type", "column", "metric", F.col("value").cast("double"))
            elif "code_for_constraint" in cols:
                part = df.select(F.lit(section).alias("section"), F.lit(self.table).alias("table"),
                                 F.col("rule").alias("type"), F.col("column_name").alias("column"),
                                 F.col("code_for_constraint").alias("metric"),
                                 F.col("min_fraction").cast("double").alias("value"))
            else:
                continue
            out = part if out is None else out.unionByName(part)
        return out.select(F.lit(self.ts).cast("timestamp").alias("timestamp"),
                          F.lit(self.path).cast("string").alias("path"), "*")


def table_report(df: DataFrame, table: str, ts: str | None = None,
                 path: str | None = None) -> Report:
    """Suggestions and profile of a whole table, which is read once."""
    metrics, suggestions = profile_and_suggest(df)
    return Report(table, {"suggestions": _materialise(suggestions), "profile": metrics}, ts,
                  path or table)


def _label_counts_rows(sl: DataFrame, table: str) -> DataFrame:
    c = label_counts(sl)
    return c.select(F.inline(F.array(*[
        F.struct(F.lit("Count").alias("type"), F.lit(None).cast("string").alias("column"),
                 F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n in ("n_total", "n_current", "n_previous")])))


def quality_report(df: DataFrame, cfg: RunConfig, with_shap: bool = True) -> Report:
    """The Python rules + drift job of the reference, on Spark end to end."""
    at = cfg.at
    if at is None:
        from tablewise.operators.slices import newest_slot
        at = newest_slot(df, cfg.ts_col)
    current = slice_at(df, cfg.ts_col, at, cfg.grain).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        metrics, suggestions = profile_and_suggest(current)
        frames = {"suggestions": _materialise(suggestions), "profile": metrics}
    finally:
        current.unpersist()
    days = slice_days(df, cfg.ts_col, at, cfg.grain, cfg.n_days)
    return _with_drift(days, cfg, frames, cfg.drift_params(), with_shap)


def drift_report(df: DataFrame, cfg: RunConfig, with_shap: bool = True, n_days: int = 2,
                 profile_sample: bool = False) -> Report:
    """Newest slot against the same slot of the previous day(s).  The profile reads the
    whole slice; ``profile_sample`` profiles the sample instead."""
    sl = latest_slice(df, cfg.ts_col, cfg.grain, n_days=n_days)
    params = replace(cfg.drift_params(), with_accuracy=False)
    return _with_drift(sl, cfg, {}, params, with_shap, "sample" if profile_sample else "slice")


def _with_drift(labelled: DataFrame, cfg: RunConfig, frames: dict, params: DriftParams,
                with_shap: bool, profiled: str | None = None) -> Report:
    """Counts, profile (of the ``slice`` or the ``sample``) and drift metrics of a labelled
    slice, which is read once and kept while they are computed."""
    stamp = cfg.stamp()
    labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sampled = sample_by_class(labelled, "label", cfg.sample_frac, cfg.seed, method="hash",
                                  key=cfg.key)
        if profiled:
            part = sampled if profiled == "sample" else labelled
            frames["profile"] = _materialise(profile(part.drop("label")))
        frames["counts"] = _materialise(_label_counts_rows(labelled, cfg.table))
        frames["drift"] = drift_model(
            sampled, cfg.key, cfg.table, exclude=(cfg.ts_col,) + tuple(cfg.exclude),
            exclude_prefixes=cfg.exclude_prefixes, params=params, ts=stamp["ts"],
            path=stamp["path"], with_shap=with_shap).metrics
    finally:
        labelled.unpersist()
    return Report(cfg.table, frames, **stamp)


def _materialise(df: DataFrame) -> DataFrame:
    """Small result frames computed while their cached input is alive."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


__all__ = ["RunConfig", "Report", "table_report", "quality_report", "drift_report", "CONF_PREFIX"]
