"""Time-slice predicates.

The reference selects a slice with ``to_date(ts) = d AND date_format(ts, 'HH:mm') = t``.
Wrapped in functions, neither test reaches the parquet / JDBC scan.  Here the same
slice is a half-open range on the raw column, ``start <= ts < start + grain``, which
Catalyst pushes down (``PushedFilters`` shows both bounds).  Several days become an
OR of ranges.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

GRAINS = {
    "minute": dt.timedelta(minutes=1),
    "hour": dt.timedelta(hours=1),
    "day": dt.timedelta(days=1),
}


def lenient_timestamp(c, ntz: bool = True) -> Column:
    """B1: cast to timestamp, null (not an error) on bad text, as the cast did on Spark 3."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("timestamp_ntz" if ntz else "timestamp")


def hhmm(c) -> Column:
    """B2: time-of-day key ``HH:mm``."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "HH:mm")


def day_key(c) -> Column:
    """Calendar day."""
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def hour_bucket(c) -> Column:
    """Start cut to the hour, kept zone-less."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("hour", col).cast("timestamp_ntz")


def slice_start(at: dt.datetime, grain: str) -> dt.datetime:
    """Floor ``at`` to the grain (minute: the reference's HH:mm key)."""
    if grain == "minute":
        return at.replace(second=0, microsecond=0)
    if grain == "hour":
        return at.replace(minute=0, second=0, microsecond=0)
    if grain == "day":
        return at.replace(hour=0, minute=0, second=0, microsecond=0)
    raise ValueError(f"unknown grain {grain!r}; use one of {sorted(GRAINS)}")


def _lit_for(col_type, value: dt.datetime) -> Column:
    """Slot bound as a literal of the column's type, built from text: text -> timestamp_ntz
    is zone-free, text -> timestamp reads the wall clock in the session zone.  (A Python
    datetime literal would be read in the Python process's zone instead.)"""
    text = F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f"))
    if isinstance(col_type, TimestampNTZType) or col_type is None:
        return text.cast("timestamp_ntz")
    if isinstance(col_type, TimestampType):
        return text.cast("timestamp")
    return text.cast("timestamp_ntz")


def slice_ranges(at: dt.datetime, grain: str = "minute", n_days: int = 1):
    """[(start, end), ...] for day d, d-1, ... d-(n_days-1), newest first."""
    start = slice_start(at, grain)
    width = GRAINS[grain]
    return [(start - dt.timedelta(days=i), start - dt.timedelta(days=i) + width)
            for i in range(n_days)]


def in_ranges(c, ranges, col_type=None) -> Column:
    """OR of half-open ranges on the raw column (pushdown friendly)."""
    col = F.col(c) if isinstance(c, str) else c
    cond = None
    for lo, hi in ranges:
        part = (col >= _lit_for(col_type, lo)) & (col < _lit_for(col_type, hi))
        cond = part if cond is None else (cond | part)
    return cond


def current_day_label(c, at: dt.datetime, grain: str = "minute", col_type=None) -> Column:
    """1 for rows of the newest day's range, else 0."""
    lo, hi = slice_ranges(at, grain, 1)[0]
    col = F.col(c) if isinstance(c, str) else c
    return F.when((col >= _lit_for(col_type, lo)) & (col < _lit_for(col_type, hi)), F.lit(1)) \
        .otherwise(F.lit(0)).cast("int")


def time_column(df, ts_col: str, lenient: bool = True):
    """Return (Column, type) for the slice column; text columns get the lenient cast (B1)."""
    field = df.schema[ts_col]
    if isinstance(field.dataType, StringType):
        return (lenient_timestamp(ts_col) if lenient else F.col(ts_col).cast("timestamp_ntz"),
                TimestampNTZType())
    return F.col(ts_col), field.dataType


__all__ = ["GRAINS", "lenient_timestamp", "hhmm", "day_key", "hour_bucket", "slice_start",
           "slice_ranges", "in_ranges", "current_day_label", "time_column"]
