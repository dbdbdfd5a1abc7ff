"""Run a job from the Spark conf (spark-submit entry point).

    spark-submit --conf spark.tablewise.job=quality \\
                 --conf spark.tablewise.path=s3://bucket/table --conf spark.tablewise.ts_col=ts \\
                 --conf spark.tablewise.key=record_id --conf spark.tablewise.output=s3://bucket/dq \\
                 -m tablewise.plans.run

``spark.tablewise.job``: ``table`` (J1), ``quality`` (J2, default) or ``drift`` (J3).
With ``spark.tablewise.output`` set, the report is published there as a whole (``sources.publish``),
under the run id ``spark.tablewise.run_id`` (default: job, table and time stamp).  A run's folder
holds

* ``metrics/``            all rows (A5)
* ``suggestions_flat/``   one JSON document (A6)
* ``suggestions_by_column/`` one JSON line per column (A7)
* ``exposition/profile/`` metric exposition lines of the profile (A8)
* ``exposition/ml/``      those of the drift model (A9)

Otherwise the rows are printed.
"""

from __future__ import annotations

import sys

from tablewise.plans.jobs import CONF_PREFIX, RunConfig, drift_report, quality_report, table_report
from tablewise.session import get_spark, release_shared
from tablewise.sources.publish import publish_run
from tablewise.sources.sinks import (append_metrics, ml_exposition, profile_exposition,
                                     suggestions_by_column, suggestions_document, write_json_lines,
                                     write_lines)

JOBS = {"table": lambda df, cfg: table_report(df, cfg.table, **cfg.stamp()),
        "quality": quality_report,
        "drift": drift_report}


def run(spark, job: str | None = None, output: str | None = None):
    job = job or spark.conf.get(CONF_PREFIX + "job", "quality")
    output = output or spark.conf.get(CONF_PREFIX + "output", None)
    cfg = RunConfig.from_conf(spark)
    report = JOBS[job](cfg.load(spark), cfg)
    rows = report.rows()
    if not output:
        rows.show(rows.count(), truncate=False)
        return report
    frames = report.frames

    def write(folder: str) -> None:
        append_metrics(rows, f"{folder}/metrics", partition_by=())     # one table a run
        if "suggestions" in frames:
            write_json_lines(suggestions_document(frames["suggestions"], cfg.table),
                             f"{folder}/suggestions_flat")
            write_json_lines(suggestions_by_column(frames["suggestions"]),
                             f"{folder}/suggestions_by_column")
        if "profile" in frames:
            write_lines(profile_exposition(frames["profile"], cfg.table),
                        f"{folder}/exposition/profile")
        if "drift" in frames:
            write_lines(ml_exposition(frames["drift"], with_path=True), f"{folder}/exposition/ml")

    run_id = spark.conf.get(CONF_PREFIX + "run_id", f"{job}-{cfg.table}-{report.ts}")
    publish_run(spark, output, run_id, write)
    return report


def main(argv=None) -> int:
    spark = get_spark()
    try:
        run(spark)
    finally:
        release_shared(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
