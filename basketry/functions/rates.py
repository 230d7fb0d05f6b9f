"""Guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_rate(numerator: Column | str, denominator: Column | str, scale: int | None = 4) -> Column:
    """``numerator / denominator`` as double, ``0.0`` when the denominator is
    not positive (or null); rounded HALF_UP to ``scale`` digits unless
    ``scale`` is ``None``. A rate may exceed 1 (more purchases than views)."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    ratio = num.cast("double") / den
    if scale is not None:
        ratio = F.round(ratio, scale)
    return F.when(den > 0, ratio).otherwise(F.lit(0.0))
