"""Session helpers.

The library never creates folders on a machine-local disk behind the user's back:
anything that has to be materialised (lineage cuts, model files) goes under the
shared folder named by ``spark.checkpoint.dir``.  Tests set it to a scratch folder
only when the session does not already carry one.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tablewise", extra: dict | None = None) -> SparkSession:
    """Get (or create) a session with the defaults above.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; locally
    ``master="local[8]"``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SCRATCH: dict[str, str] = {}     # application id -> scratch folder of a local session


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a scratch folder (tests, laptops; removed
    when the process ends); on a cluster a machine-local folder would be lost with its
    executor, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    d = (spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
         or _SCRATCH.get(sc.applicationId))
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)")
        d = tempfile.mkdtemp(prefix="tablewise-ckpt-")
        _SCRATCH[sc.applicationId] = d
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def _application_dir(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tablewise-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the application's part of the shared checkpoint folder (for written
    tables, models)."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release_shared(spark: SparkSession) -> None:
    """Delete everything the application has put into the shared folder.  Results that are still
    lazy read it: call this when they have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors, and of a
    size that the planner knows."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["get_spark", "ensure_checkpoint_dir", "shared_dir", "release_shared", "written",
           "DEFAULT_CONF"]
