"""Small numeric helpers kept as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num, den, zero=0.0) -> Column:
    """num / den, ``zero`` when the denominator is 0 or null (the zero_division=0 rule)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(zero))


def ratio_or_null(num, den) -> Column:
    """num / den, null on an empty denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def floor_to(x, decimals: int = 2) -> Column:
    """Cut (not round) to ``decimals`` places: ``floor(x * 10^d) / 10^d``."""
    s = 10.0 ** decimals
    return F.floor(_c(x) * F.lit(s)) / F.lit(s)


def normal_from_uniforms(u1, u2, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Box-Muller: one N(mean, sd) draw from two independent uniforms in [0, 1)."""
    # 1 - u keeps the log argument in (0, 1]
    r = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _c(u1)))
    return F.lit(mean) + F.lit(sd) * r * F.cos(F.lit(2.0 * 3.141592653589793) * _c(u2))


__all__ = ["safe_ratio", "ratio_or_null", "floor_to", "normal_from_uniforms"]
