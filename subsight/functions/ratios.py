"""Counts and ratios of aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: bigint, 0 on no match.

    Kept as a sum (not ``count_if``) so that the type and the NULL handling
    equal the source formula."""
    return F.sum(F.when(cond, 1).otherwise(0))


def percent(numerator: Column | str, denominator: Column | str, digits: int = 1) -> Column:
    """``round(num / den * 100, digits)``; a zero denominator gives NULL
    instead of the ANSI division error."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.round(F.try_divide(num, den) * 100, digits)
