"""Numeric helpers with engine-independent results.

Spark's ``round`` rounds the shortest decimal text of a double (HALF_UP on
``BigDecimal``), so ``round(1.005, 2)`` is 1.01.  The published figures are
defined the other way: scale the binary value, round half away from zero,
scale back, which gives 1.0.  ``round_at`` does the latter with built-ins,
exactly: for ``t >= 0`` the difference ``t - floor(t)`` is computed without
error, so the half-way test is exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_at(col: Column, digits: int) -> Column:
    """Round half away from zero at ``digits`` decimals on the binary value."""
    scale = float(10 ** digits)
    t = col.cast("double") * F.lit(scale)
    a = F.abs(t)
    whole = F.floor(a).cast("double")
    up = F.when(a - whole >= F.lit(0.5), whole + F.lit(1.0)).otherwise(whole)
    signed = F.when(t < F.lit(0.0), -up).otherwise(up)
    return signed / F.lit(scale)


def pct_of(part: Column, total: Column, digits: int = 4) -> Column:
    """``round(part * 100.0 / total, digits)`` as DOUBLE (never DECIMAL)."""
    return round_at(part.cast("double") * F.lit(100.0) / total.cast("double"), digits)
