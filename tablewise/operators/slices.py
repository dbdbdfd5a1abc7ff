"""Time slices and day labels.

``slice_at``        rows of one slot (minute / hour / day) on one day          (B5)
``slice_days``      the same slot on day d, d-1, ..., with label 1 on day d   (B6, B9)
``newest_slot``     the newest timestamp of the slice column                  (B7, D14)
``latest_slice``    newest slot + the same slot on the previous day(s)        (B8)

Every predicate is a half-open range on the raw column, so parquet row groups and
JDBC partitions outside the slot are skipped at the source.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablewise.functions.timeslice import (current_day_label, in_ranges, slice_ranges,
                                           time_column)
from tablewise.operators.profile import qcol


def _as_datetime(at) -> dt.datetime:
    if isinstance(at, dt.datetime):
        return at
    if isinstance(at, dt.date):
        return dt.datetime(at.year, at.month, at.day)
    text = str(at).replace("T", " ")
    for fmt in ("%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d"):
        try:
            return dt.datetime.strptime(text, fmt)
        except ValueError:
            continue
    raise ValueError(f"cannot read a time from {at!r}")


def _with_time(df: DataFrame, ts_col: str, lenient: bool):
    """Text time columns are replaced by their lenient cast."""
    c, ctype = time_column(df, ts_col, lenient)
    if isinstance(df.schema[ts_col].dataType, StringType):
        df = df.withColumn(ts_col, c)
        c = qcol(ts_col)
    return df, c, ctype


def slice_at(df: DataFrame, ts_col: str, at, grain: str = "minute",
             lenient: bool = True) -> DataFrame:
    """Rows with ``ts`` in the slot of ``at`` (null times drop out)."""
    at = _as_datetime(at)
    df, c, ctype = _with_time(df, ts_col, lenient)
    return df.filter(in_ranges(c, slice_ranges(at, grain, 1), ctype))


def slice_days(df: DataFrame, ts_col: str, at, grain: str = "minute", n_days: int = 3,
               label_col: str = "label", lenient: bool = True) -> DataFrame:
    """B6 + B9: the slot of ``at`` on ``n_days`` consecutive days, label 1 on the newest."""
    at = _as_datetime(at)
    df, c, ctype = _with_time(df, ts_col, lenient)
    return (df.filter(in_ranges(c, slice_ranges(at, grain, n_days), ctype))
              .withColumn(label_col, current_day_label(c, at, grain, ctype)))


def newest_slot(df: DataFrame, ts_col: str, lenient: bool = True):
    """Newest time of the column as a wall-clock ``datetime``.  Reads that
    column only (A3).  The value is formatted by Spark (session zone for zoned timestamps), so
    the slot ranges built from it mean the same wall clock."""
    df, c, _ = _with_time(df.select(qcol(ts_col)), ts_col, lenient)
    text = df.agg(F.date_format(F.max(c), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m")).first()["m"]
    return None if text is None else dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S.%f")


def latest_slice(df: DataFrame, ts_col: str, grain: str = "minute", n_days: int = 2,
                 label_col: str = "label", lenient: bool = True) -> DataFrame:
    """Newest slot and the same slot on the previous ``n_days - 1`` days, labelled."""
    newest = newest_slot(df, ts_col, lenient)
    if newest is None:
        # empty table: an empty slice with the label column
        return df.filter(F.lit(False)).withColumn(label_col, F.lit(0).cast("int"))
    return slice_days(df, ts_col, newest, grain, n_days, label_col, lenient)


__all__ = ["slice_at", "slice_days", "newest_slot", "latest_slice"]
