"""Stored sketches: merged parts equal the whole, answers lie within the stated errors, one hash aggregate over one scan."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from subsight import model as M
from subsight.lake import Lake
from subsight.operators import gold, sketches
from subsight.plans import pipeline
from subsight.plans.registry import QUERIES
from subsight.sources.catalog import LakeConfig, read_table


def dist(df, **options):
    return {r.column_name: r.asDict() for r in sketches.distribution(df, **options).collect()}


def test_values_of_every_type(spark):
    day, time = dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 1, 2, 3, 400)
    rows = [(i, float(i) / 4, i % 3 == 0, day + dt.timedelta(days=i), time + dt.timedelta(seconds=i), f"t{i % 5}", None, [i], b"x") for i in range(1, 9)]
    rows += [(None,) * 9]
    df = spark.createDataFrame(rows, "i int, d double, b boolean, day date, at timestamp, s string, n bigint, a array<int>, raw binary")
    out = dist(sketches.sketched(df, top=["s", "b"]))
    assert [out["i"][k] for k in ("row_count", "null_count", "distinct_count", "min_value", "p25", "median", "p75", "max_value")] == \
        [9, 1, 8, "1", "2", "4", "6", "8"]
    assert (out["d"]["p25"], out["d"]["max_value"], out["d"]["distinct_count"]) == ("0.5", "2.0", 8)
    assert (out["b"]["min_value"], out["b"]["max_value"], out["b"]["top_values"]) == ("false", "true", "false: 6, true: 2")
    assert (out["day"]["median"], out["at"]["min_value"]) == ("2024-03-04", "2024-02-29 01:02:04.0004")
    assert (out["s"]["top_values"], out["s"]["min_value"], out["s"]["p25"]) == ("t1: 2, t2: 2, t3: 2, t0: 1, t4: 1", "t0", None)
    assert (out["n"]["null_count"], out["n"]["distinct_count"], out["n"]["median"], out["n"]["min_value"]) == (9, 0, None, None)
    assert (out["a"]["null_count"], out["a"]["distinct_count"], out["raw"]["distinct_count"]) == (1, None, None)
    empty = dist(sketches.sketched(df.limit(0), top=["s"]))
    assert (empty["i"]["row_count"], empty["i"]["null_pct"], empty["i"]["median"], empty["s"]["top_values"]) == (0, None, None, "")


def test_merged_months_equal_the_whole(spark):
    logs = Lake.from_testdata(spark, SF_SMALL)["silver_reading_logs"]
    whole = dist(sketches.log_sketches(logs))
    parts = sketches.log_sketches(logs, by=["ym"])
    assert parts.select("ym").distinct().count() == logs.select("ym").distinct().count()
    assert dist(sketches.merged(parts)) == whole
    some = ["1996-01", "1996-02"]
    assert dist(sketches.merged(parts.where(F.col("ym").isin(some)))) == dist(sketches.log_sketches(logs.where(F.col("ym").isin(some))))


def test_errors_stay_within_those_stated(spark):
    """Small sketches of many values, cut in ten parts: ranks, distinct counts and the order of frequent values."""
    n, k, bits = 300_000, 200, 10
    df = spark.range(n).select((F.col("id") % 10).alias("part"), (F.xxhash64("id") % 1_000_000).alias("v"),
                               F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("s"))
    rows = sketches.merged(sketches.sketched(df, by=["part"], top=["s"], accuracy=k, distinct_bits=bits, tracked=64), k, bits, 64)
    out = dist(rows, tracked=64)
    for name, share in sketches.QUARTILES:
        rank = df.where(F.col("v") <= int(out["v"][name])).count() / n
        assert abs(rank - share) < 2.296 / k**0.9021
    exact = df.agg(F.count_distinct("v")).first()[0]
    assert abs(out["v"]["distinct_count"] / exact - 1) < 3 / 2 ** (bits / 2)
    assert out["s"]["top_values"].startswith("hot: ")


def test_one_scan_and_no_sort(spark):
    """The profile of the logs is one hash aggregate: each table is scanned once, nothing is sorted or expanded."""
    lake = Lake.from_testdata(spark, SF_SMALL)
    df = QUERIES["log_distribution"](lake)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("lineitem.parquet") == 1 and plan.count("part.parquet") == 1
    assert "SortAggregate" not in plan and "Expand" not in plan and "ObjectHashAggregate" in plan


@pytest.mark.parametrize("first,last,categories", [(None, None, None), ("1996-03", "1997-08", None), ("1995-01", "1995-01", ["STANDARD"]),
                                                   ("1996-01", None, ["PROMO", "STANDARD"]), ("2090-01", None, None)])
def test_readers_of_any_period(spark, first, last, categories):
    activity = gold.member_month_activity(Lake.from_testdata(spark, SF_SMALL)["silver_reading_logs"])
    rows = lambda df: sorted(map(str, df.collect()))
    exact = rows(sketches.readers_exact(activity, first, last, categories))
    assert rows(sketches.readers(sketches.reader_sketches(activity), first, last, categories)) == exact and len(exact) >= 1


def test_readers_beyond_the_sketch_stay_within_the_error(spark):
    activity = spark.range(200_000).select(F.lit("2025-01").alias("ym"), (F.col("id") % 2).cast("string").alias("category"),
                                           (F.col("id") % 150_000).alias("member_id"), F.lit(1).alias("views"))
    got = {(r.scope, r.category): r.unique_readers for r in sketches.readers(sketches.reader_sketches(activity, 12), bits=12).collect()}
    assert abs(got[("all", None)] / 150_000 - 1) < 4 / 64


def test_stored_sketches_follow_a_refresh(spark):
    """From stored tables the answers read sketches only; a refresh makes the partition of its month anew, and no other."""
    from pathlib import Path
    from urllib.parse import urlparse

    config = LakeConfig(schema="sketch_store")
    raw = Lake.from_testdata(spark, SF_SMALL)
    pipeline.ingest_bronze(spark, config, raw)
    pipeline.run_pipeline(spark, config)
    pipeline.run_sketches(spark, config)
    lake = Lake.from_catalog(spark, config)
    for name in ("log_distribution", "readers_in_period"):
        df = QUERIES[name](lake)
        assert sorted(map(str, df.collect())) == sorted(map(str, QUERIES[name](raw).collect()))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "reading_seconds" not in plan and "views" not in plan
    logs = read_table(spark, config, "silver_reading_logs")
    extra = spark.createDataFrame(logs.where("ym = '1996-05'").limit(3).collect(), logs.schema)
    extra.write.mode("append").format(config.fmt).partitionBy("ym").saveAsTable(config.fqn("silver_reading_logs"))
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {config.fqn(M.SKETCH_TABLE)}").where("col_name = 'Location'").first()[1]
    files = lambda: {str(p) for p in Path(urlparse(where).path).glob("ym=*/*.parquet")}
    before = files()
    pipeline.refresh_months(spark, config, ["1996-05"])
    assert {Path(p).parent.name for p in before ^ files()} == {"ym=1996-05", "ym=__HIVE_DEFAULT_PARTITION__"}
    lake = Lake.from_catalog(spark, config)
    assert dist(sketches.merged(lake[M.SKETCH_TABLE])) == dist(sketches.log_sketches(lake["silver_reading_logs"]))
