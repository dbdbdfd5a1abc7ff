"""Sessions without any configuration, run parameters, and how often sources are read."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tablewise.plans.jobs import RunConfig, drift_report, table_report
from tablewise.plans.queries import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_session_without_configuration(tmp_path):
    """No checkpoint folder is configured: a local session gets a scratch one, removed at exit."""
    code = ("from tablewise.session import get_spark, release_shared, shared_dir, written\n"
            "import os\n"
            "s = get_spark('local[1]', 1)\n"
            "t = written(s.range(5).toDF('x'), 'numbers')\n"
            "n, folder = t.count(), os.path.dirname(shared_dir(s, 'a')).removeprefix('file:')\n"
            "there = os.path.isdir(folder)\n"
            "release_shared(s)\n"
            "print('RESULT', n, there, os.path.isdir(folder), folder)\n")
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=300)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    _, n, there, after, folder = line[0].split()
    assert (n, there, after) == ("5", "True", "False")
    assert not os.path.exists(os.path.dirname(folder))


def test_jdbc_run_parameters(spark):
    keys = {"spark.jdbc.url": "jdbc:x://h/db", "spark.jdbc.password": "secret",
            "spark.jdbc.driver": "org.x.Driver", "spark.jdbc.partitionColumn": "id",
            "spark.jdbc.lowerBound": "0", "spark.jdbc.upperBound": "100",
            "spark.jdbc.numPartitions": "8"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        cfg = RunConfig.from_conf(spark)
    finally:
        for k in keys:
            spark.conf.unset(k)
    from tablewise.sources.readers import jdbc_options
    opts = dict(cfg.source_options)
    got = jdbc_options(opts.pop("url"), "t", **opts)
    assert got["driver"] == "org.x.Driver" and got["numPartitions"] == "8"
    assert got["partitionColumn"] == "id" and "secret" not in repr(cfg)
    assert cfg.shap_rows is None and cfg.max_iter == 500 and cfg.patience == 20


@pytest.fixture
def counted(spark):
    """``df -> (df, rows read so far)``: rows are counted as they leave the source."""
    def wrap(df):
        seen = spark.sparkContext.accumulator(0)

        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return df.mapInArrow(run, df.schema), seen
    return wrap


def test_table_report_reads_its_table_once(spark, sf001, counted):
    orders = spark.read.parquet(f"{sf001}/orders.parquet")
    df, seen = counted(orders)
    report = table_report(df, "orders", "2024-01-01 00:00:00", "p")
    rows = report.rows().collect()
    report.rows().count()
    assert seen.value == orders.count()
    assert {(str(r.timestamp), r.path) for r in rows} == {("2024-01-01 00:00:00", "p")}


def test_drift_report_profiles_the_whole_slice(spark, sf001, counted):
    ev = spark.read.parquet(f"{sf001}/events.parquet")
    df, seen = counted(ev)
    cfg = RunConfig(table="events", ts_col="ts", key="event_id", grain="day", max_iter=3,
                    max_depth=2)
    rows = drift_report(df, cfg, with_shap=False).rows()
    assert seen.value == 2 * ev.count()                # the newest slot, then the slice
    size = {r.metric: r.value for r in rows.where("metric in ('Size', 'n_total')").collect()}
    assert size["Size"] == size["n_total"]
    assert rows.where("metric = 'accuracy'").isEmpty()


def test_roc_auc_reads_its_rows_once(spark, counted):
    from tablewise.operators.metrics import roc_auc
    base = spark.range(500).select((F.col("id") % 37).cast("double").alias("score"),
                                   (F.col("id") % 3 == 0).cast("int").alias("label"))
    df, seen = counted(base)
    roc_auc(df, buckets=4, range_rows=5).collect()
    assert seen.value == 500


def test_model_rows_are_spread(spark, monkeypatch):
    """The encoded rows do not shrink to one partition, whatever the source's layout."""
    from tablewise.operators import drift
    seen = []
    monkeypatch.setattr(drift, "fit_boosted", lambda data, *a: seen.append(
        data.rdd.getNumPartitions()) or 1 / 0)
    df = spark.range(300).select(F.col("id"), F.rand(1).alias("x"),
                                 (F.col("id") % 2).cast("int").alias("label")).coalesce(1)
    with pytest.raises(ZeroDivisionError):
        drift.drift_model(df, "id", "t")
    assert seen[0] >= spark.sparkContext.defaultParallelism
