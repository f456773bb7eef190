"""Exact sums with one final division, and null-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def exact_mean(value: Column, window: WindowSpec | None = None) -> Column:
    """Mean as DOUBLE from an exact decimal sum, independent of row order."""
    total, count = F.sum(value), F.count(value)
    if window is not None:
        total, count = total.over(window), count.over(window)
    return F.try_divide(total.cast("double"), count.cast("double"))


def rounded_mean(value: Column, digits: int = 2, window: WindowSpec | None = None) -> Column:
    """Mean of a decimal column rounded half-up, computed in decimals throughout."""
    total, count = F.sum(value), F.count(value)
    if window is not None:
        total, count = total.over(window), count.over(window)
    return F.round(F.try_divide(total, count.cast("decimal(20,0)")), digits)


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; null where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def clamp_at_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("decimal(18,4)"))


def two_digits(value: Column) -> Column:
    """Half-up rounding to two digits."""
    return F.round(value, 2)
