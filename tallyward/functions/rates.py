"""Percentages with warehouse semantics: a zero or NULL denominator gives NULL, two decimals, half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_pct(numerator: Column, denominator: Column) -> Column:
    """``100 * numerator / denominator``, unrounded; NULL instead of a division error."""
    return F.try_divide(numerator, denominator) * 100


def percent(numerator: Column, denominator: Column) -> Column:
    return F.round(ratio_pct(numerator, denominator), 2)


def capped_percent(numerator: Column, denominator: Column, cap: float = 100.0) -> Column:
    """As :func:`percent`, cut off at ``cap`` before rounding.

    Spark's ``least`` skips NULLs and would turn "no rate" into the cap, so NULL is kept by hand.
    """
    rate = ratio_pct(numerator, denominator)
    return F.when(rate.isNotNull(), F.round(F.least(rate, F.lit(cap)), 2))
