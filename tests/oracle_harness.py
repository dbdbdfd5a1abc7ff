"""Spark query vs DuckDB oracle, order-insensitive (used by tests and by hand).

    PYTHONPATH=. python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(dtype) -> str:
    k = getattr(dtype, "kind", "O")
    if k in "iu":
        return "int"
    if k == "f":
        return "float"
    if k == "b":
        return "bool"
    if k == "M":
        return "time"
    return "object"


def _canon(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return repr(v + 0.0)      # exact (only a negative zero is folded)
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def frame_rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = sorted(tuple(_canon(v) for v in r) for r in df[cols].itertuples(index=False))
    return cols, rows


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame):
    sc, sr = frame_rows(spark_pdf)
    dc, dr = frame_rows(duck_pdf)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    sk = [_kind(spark_pdf[c].dtype) for c in sc]
    dk = [_kind(duck_pdf[c].dtype) for c in dc]
    notes = "" if sk == dk else f" (dtype kinds spark={sk} duck={dk})"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}{notes}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ, first: {diff}{notes}"
    return True, f"{len(sr)} rows{notes}"


def run(spark, sf_dir: str, names=None, verbose=True):
    from tablewise.plans.queries import ORACLES, QUERIES
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(QUERIES):
        if name not in ORACLES:
            continue
        t0 = time.time()
        try:
            sp = QUERIES[name](spark, sf_dir).toPandas()
            t1 = time.time()
            dp = con.execute(ORACLES[name]).df()
            ok, msg = compare(sp, dp)
        except Exception as e:  # noqa: BLE001 - report and continue
            ok, msg, t1 = False, f"error: {type(e).__name__}: {str(e)[:400]}", time.time()
        results[name] = (ok, msg)
        if verbose:
            print(f"{'OK ' if ok else 'BAD'} {name:34s} {t1 - t0:6.2f}s  {msg}", flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tablewise.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sel = sys.argv[2:] or None
    s = get_spark("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    res = run(s, sf, sel)
    bad = [k for k, (ok, _) in res.items() if not ok]
    print(f"{len(res) - len(bad)}/{len(res)} match; bad: {bad}")
