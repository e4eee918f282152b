"""Date and time parsing that never raises (ANSI mode is on in Spark 4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subsight.model import MONTH_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str) -> Column:
    """Text -> DATE; empty or invalid text -> NULL."""
    return _col(c).try_cast("date")


def parse_timestamp(c: Column | str) -> Column:
    """Text -> TIMESTAMP in the session time zone; invalid -> NULL."""
    return _col(c).try_cast("timestamp")


def month_of(c: Column | str) -> Column:
    """Sortable month text ``yyyy-MM``; NULL stays NULL."""
    return F.date_format(_col(c), MONTH_FORMAT)


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole days ``end - start``."""
    return F.datediff(_col(end), _col(start))
