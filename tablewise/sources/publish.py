"""Publishing the outputs of a run as a whole.

A run writes all its outputs into a folder of its own, ``runs/<run id>/<attempt>``, and then names
that folder in one small manifest, ``manifests/<run id>.json``, which is put in place by a
rename.  Readers go by the manifests.  So a run that dies between two outputs has published
nothing, and a run that is tried again under the same id replaces what it had published: no metric
row appears twice, whatever the retries.  Attempts that no manifest names can be deleted at
any time (``drop_unpublished``).

Run ids are file names: everything but letters, digits, ``.``, ``_`` and ``-`` is replaced, with a
digest of the id behind it, so that different ids stay different.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_name(run_id: str) -> str:
    safe = re.sub(r"[^A-Za-z0-9._-]", "_", run_id)
    if safe == run_id and not run_id.startswith((".", "_")):
        return run_id
    return f"r{safe}-{hashlib.sha256(run_id.encode()).hexdigest()[:12]}"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _put(spark: SparkSession, path: str, text: str) -> None:
    """One small file in one step: written beside its place and renamed over it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, draft = _path(spark, path), _path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    fs = target.getFileSystem(conf)
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    context.rename(context.makeQualified(draft), context.makeQualified(target), options)


def publish_run(spark: SparkSession, out: str, run_id: str, write: Callable[[str], None]) -> str:
    """Let ``write(folder)`` put the run's outputs into a fresh folder, then publish it under
    ``run_id``.  Returns the folder; if ``write`` fails, nothing is published."""
    out, name = out.rstrip("/"), run_name(run_id)
    folder = f"{out}/runs/{name}/{uuid.uuid4().hex[:12]}"
    write(folder)
    _put(spark, f"{out}/manifests/{name}.json", json.dumps({"run": run_id, "folder": folder}))
    return folder


def published(spark: SparkSession, out: str) -> dict[str, str]:
    """Run id -> folder of every published run (one small file each)."""
    found = _path(spark, f"{out.rstrip('/')}/manifests")
    fs = found.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(found):
        return {}
    rows = (spark.read.schema("run string, folder string").option("pathGlobFilter", "*.json")
            .json(found.toString()).collect())
    return {r["run"]: r["folder"] for r in rows}


def read_published(spark: SparkSession, out: str, part: str, schema=None,
                   runs=None) -> DataFrame:
    """The parquet rows of output ``part`` (not partitioned by folders) of all published runs, or of
    ``runs``.  ``schema`` is
    what an output without any run has; without it, there must be a run."""
    folders = [f"{folder}/{part}" for run, folder in sorted(published(spark, out).items())
               if runs is None or run in set(runs)]
    if not folders and schema is not None:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*folders)


def drop_unpublished(spark: SparkSession, out: str) -> int:
    """Delete the attempts that no manifest names; their number.  Not while a run is writing."""
    named = set(published(spark, out).values())
    out = out.rstrip("/")
    runs = _path(spark, f"{out}/runs")
    fs = runs.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(runs):
        return 0
    gone = 0
    for run in fs.listStatus(runs):
        for attempt in fs.listStatus(run.getPath()):
            path = attempt.getPath()
            if f"{out}/runs/{run.getPath().getName()}/{path.getName()}" not in named:
                fs.delete(path, True)
                gone += 1
    return gone


__all__ = ["publish_run", "published", "read_published", "drop_unpublished", "run_name"]
