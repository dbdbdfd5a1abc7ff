"""Column-expression helpers (all JVM-side, codegen friendly)."""

from tablewise.functions.hashing import (  # noqa: F401
    fast_hash, portable_hash, portable_hash_sql, row_key, unit_hash, unit_hash_sql)
from tablewise.functions.mathx import (  # noqa: F401
    floor_to, normal_from_uniforms, ratio_or_null, safe_ratio)
from tablewise.functions.timeslice import (  # noqa: F401
    current_day_label, day_key, hhmm, hour_bucket, in_ranges, lenient_timestamp,
    slice_ranges, slice_start, time_column)
