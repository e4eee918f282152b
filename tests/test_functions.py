import datetime as dt

import pytest
from pyspark.sql import functions as F

from subsight.functions import (
    band_at_least,
    band_below,
    count_where,
    days_between,
    month_of,
    parse_date,
    parse_timestamp,
    percent,
)


def test_band_bounds_are_validated(spark):
    with pytest.raises(ValueError):
        band_below(F.col("x"), [40, 30], ["a", "b", "c"])
    with pytest.raises(ValueError):
        band_at_least(F.col("x"), [2, 8], ["a", "b", "c"])
    with pytest.raises(ValueError):
        band_below(F.col("x"), [30], ["a"])


def test_bands_half_open_and_default(spark):
    df = spark.createDataFrame([(v,) for v in [None, -1, 0, 9, 10, 19, 20, 100]], "x int")
    below = [r[0] for r in df.select(band_below(F.col("x"), [10, 20], ["lo", "mid", "hi"])).collect()]
    assert below == ["hi", "lo", "lo", "lo", "mid", "mid", "hi", "hi"]
    at_least = [r[0] for r in df.select(band_at_least(F.col("x"), [20, 10], ["hi", "mid", "lo"])).collect()]
    assert at_least == ["lo", "lo", "lo", "lo", "mid", "mid", "hi", "hi"]
    only = [r[0] for r in df.select(band_below(F.col("x"), [], ["all"])).collect()]
    assert set(only) == {"all"}


def test_percent_and_count_where(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, None), (1, 8)], "a bigint, b bigint")
    got = [r[0] for r in df.select(percent("a", "b")).collect()]
    assert got == [33.3, None, None, 12.5]
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"), 3)).collect()][0] == 33.333
    row = df.agg(count_where(F.col("a") > 0).alias("n"), count_where(F.col("a") > 5).alias("none")).first()
    assert (row.n, row.none) == (3, 0)


def test_date_helpers(spark):
    df = spark.createDataFrame([("2025-07-31", "2025-07-31 23:59:59"), ("", "x"), (None, None)], "d string, t string")
    rows = df.select(parse_date("d").alias("d"), parse_timestamp("t").alias("t")).collect()
    assert rows[0].d == dt.date(2025, 7, 31) and rows[0].t == dt.datetime(2025, 7, 31, 23, 59, 59)
    assert (rows[1].d, rows[1].t) == (None, None) and (rows[2].d, rows[2].t) == (None, None)
    out = df.select(month_of(parse_date("d")).alias("m"),
                    days_between(parse_date("d"), F.lit("2025-07-01").cast("date")).alias("n")).collect()
    assert (out[0].m, out[0].n) == ("2025-07", 30) and (out[1].m, out[1].n) == (None, None)
