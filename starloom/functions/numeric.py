"""Exact decimal averages: round half away from zero once, at the target scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(sum_col: Column, n_col: Column, scale: int, precision: int = 18) -> Column:
    """sum / n rounded half away from zero to ``scale`` digits, using integer arithmetic on the
    unscaled value (no intermediate rounding). NULL when n is 0 or the sum is NULL."""
    u = (sum_col * F.lit(10 ** scale)).cast("decimal(38,0)")      # exact: sums carry <= scale digits
    n = n_col.cast("decimal(38,0)")
    q = (F.abs(u) * 2 + n).cast("decimal(38,0)")
    d = (n * 2).cast("decimal(38,0)")
    # (q - q mod d) is an exact multiple of d, so the division has no rounding step.
    r = ((q - q % d) / d).cast("decimal(38,0)")
    signed = F.when(u < 0, -r).otherwise(r)
    return F.when(n > 0, (signed / F.lit(10 ** scale)).cast(f"decimal({precision},{scale})"))
