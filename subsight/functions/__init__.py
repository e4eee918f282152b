"""Column-expression helpers. All are built-in Spark expressions (JVM side,
whole-stage codegen); none is a UDF."""

from subsight.functions.bands import band_below, band_at_least
from subsight.functions.dates import parse_date, parse_timestamp, month_of, days_between
from subsight.functions.ratios import percent, count_where

__all__ = [
    "band_below",
    "band_at_least",
    "parse_date",
    "parse_timestamp",
    "month_of",
    "days_between",
    "percent",
    "count_where",
]
