"""Banding: a chained CASE built from a bounds list.

``band_below(age, [30, 40], ["a", "b", "c"])`` is
``CASE WHEN age < 30 THEN 'a' WHEN age < 40 THEN 'b' ELSE 'c' END``.
The default label also catches NULL, as ``otherwise`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chain(tests: Sequence[Column], labels: Sequence[str]) -> Column:
    if len(labels) != len(tests) + 1:
        raise ValueError("need exactly one label more than bounds")
    expr = None
    for test, label in zip(tests, labels):
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    if expr is None:
        return F.lit(labels[-1])
    return expr.otherwise(labels[-1])


def band_below(col: Column, upper_bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open bands ``[.., b0), [b0, b1), ...`` on ascending upper bounds."""
    if list(upper_bounds) != sorted(upper_bounds):
        raise ValueError("upper bounds must ascend")
    return _chain([col < b for b in upper_bounds], labels)


def band_at_least(col: Column, lower_bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Bands ``>= b0, >= b1, ...`` on descending lower bounds."""
    if list(lower_bounds) != sorted(lower_bounds, reverse=True):
        raise ValueError("lower bounds must descend")
    return _chain([col >= b for b in lower_bounds], labels)
