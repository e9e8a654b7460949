"""Rates and bands (P9, P11, P12, A9, A10). Integer arithmetic keeps the
results exact and equal across engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_


def rate_pct(num, den) -> Column:
    """Stored two-digit rate as integer percent, rounded half up; 0 when
    the denominator is 0: ``(200*a + t) div (2*t)``."""
    a = col_(num).cast("bigint")
    t = col_(den).cast("bigint")
    return F.when(t > 0, F.floor((F.lit(200) * a + t) / (F.lit(2) * t)).cast("bigint")) \
        .otherwise(F.lit(0).cast("bigint"))


def ratio_pct_even(num, den) -> Column:
    """Raw ratio printed with ``.0%``: half-to-even on the double."""
    a = col_(num).cast("double")
    t = col_(den).cast("double")
    return F.when(t > 0, F.bround(a / t * F.lit(100.0), 0).cast("bigint")) \
        .otherwise(F.lit(0).cast("bigint"))


def signal_band(pct) -> Column:
    """>= 30 % strong, >= 15 % fair, > 0 weak, else none."""
    p = col_(pct)
    return (F.when(p >= 30, F.lit("GREEN")).when(p >= 15, F.lit("YELLOW"))
            .when(p > 0, F.lit("ORANGE")).otherwise(F.lit("RED")))


def bar_fill(pct, width: int = 20) -> Column:
    """Filled cells of a bar of ``width`` for a two-digit rate."""
    return F.floor(col_(pct) * F.lit(width) / F.lit(100)).cast("bigint")


def feed_status(consecutive_failures, threshold: int = 3) -> Column:
    c = col_(consecutive_failures)
    return (F.when(c >= threshold, F.lit("DEAD")).when(c > 0, F.lit("WARN"))
            .otherwise(F.lit("LIVE")))


def avg_even(num, den) -> Column:
    """Average printed with ``.0f`` (half-to-even); 0 when ``den`` is 0."""
    a = col_(num).cast("double")
    t = col_(den).cast("double")
    return F.when(t > 0, F.bround(a / t, 0).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def noise_pct(surfaced, fetched) -> Column:
    """``1 - surfaced/fetched`` printed as ``.0%``; 0 when nothing fetched."""
    s = F.coalesce(col_(surfaced), F.lit(0)).cast("double")
    f = F.coalesce(col_(fetched), F.lit(0)).cast("double")
    return F.when(f > 0, F.bround((F.lit(1.0) - s / f) * F.lit(100.0), 0).cast("bigint")) \
        .otherwise(F.lit(0).cast("bigint"))
