import datetime as dt
from decimal import Decimal

from subsight.operators import cost


def _usage(d, end, sku, qty, job="j1", wh="w1", user="u@x"):
    return (d, end, sku, Decimal(qty), (job, wh), (user,))


def _price(sku, start, end, price):
    return (sku, "USD", start, end, ((Decimal(price),),))


T = dt.datetime


def test_price_bounds_missing_and_overlap(spark, frames):
    usage = frames("usage", [
        _usage(dt.date(2025, 1, 1), T(2025, 1, 1), "A", "1"),      # exactly at start of v1
        _usage(dt.date(2025, 2, 1), T(2025, 2, 1), "A", "1"),      # exactly at end of v1 -> v2
        _usage(dt.date(2025, 3, 1), T(2025, 3, 1), "A", "1"),      # open end of v2
        _usage(dt.date(2025, 3, 1), T(2025, 3, 1), "B", "5"),      # no price for B
        _usage(dt.date(2025, 3, 1), T(2025, 3, 1), "C", "2"),      # two versions valid at once
    ])
    prices = frames("prices", [
        _price("A", T(2025, 1, 1), T(2025, 2, 1), "1.0"),
        _price("A", T(2025, 2, 1), None, "2.0"),
        _price("C", T(2025, 1, 1), None, "1.0"),
        _price("C", T(2025, 2, 1), None, "3.0"),
    ])
    out = {r.sku_name: r for r in cost.estimated_cost_by_sku(usage, prices, days=None).collect()}
    assert set(out) == {"A", "C"}
    assert (out["A"].dbus, out["A"].estimated_cost, out["A"].currency) == (3.0, 5.0, "USD")
    assert (out["C"].dbus, out["C"].estimated_cost) == (4.0, 8.0)  # counted twice, as the SQL join does
    by_sku = {r.sku_name: r.dbus for r in cost.usage_by_sku(usage, days=None).collect()}
    assert by_sku == {"A": 3.0, "B": 5.0, "C": 2.0}


def test_windows_relative_to_latest_day(spark, frames):
    rows = [_usage(dt.date(2025, 1, d), T(2025, 1, d), "A", "1.005") for d in range(1, 32)]
    usage = frames("usage", rows)
    daily = cost.daily_usage(usage, days=30).collect()
    assert [r.usage_date for r in daily][0] == dt.date(2025, 1, 1)
    assert len(daily) == 31
    assert len(cost.daily_usage(usage, days=6).collect()) == 7
    # both bounds: days 4..10
    past = cost.daily_usage(usage, days=6, as_of="2025-01-10").collect()
    assert [r.usage_date.day for r in past] == list(range(4, 11))
    assert cost.latest_usage_day(usage) == dt.date(2025, 1, 31)
    assert cost.daily_usage(usage, days=0).collect()[0].dbus == 1.01  # decimal half-up


def test_top_k_is_stable_with_ties(spark, frames):
    rows = [_usage(dt.date(2025, 1, 1), T(2025, 1, 1), "A", "1", job=f"j{i:02d}", user="me")
            for i in range(60)]
    rows.append(_usage(dt.date(2025, 1, 1), T(2025, 1, 1), "A", "1", job="other", user="you"))
    usage = frames("usage", rows)
    first = [tuple(r) for r in cost.my_usage_by_job(usage, "me", days=None, k=50).collect()]
    again = [tuple(r) for r in cost.my_usage_by_job(usage, "me", days=None, k=50).collect()]
    assert len(first) == 50 and first == again
    assert [r[1] for r in first] == [f"j{i:02d}" for i in range(50)]
    top = cost.top_sku_recent(frames("usage", rows[:3] + [_usage(dt.date(2025, 1, 1), T(2025, 1, 1), "B", "9")]),
                              days=7).collect()
    assert [(r.sku_name, r.dbus) for r in top] == [("B", 9.0)]


def test_cost_by_job(spark, frames):
    usage = frames("usage", [_usage(dt.date(2025, 1, 1), T(2025, 1, 1), "A", "2", job="x"),
                             _usage(dt.date(2025, 1, 1), T(2025, 1, 1), "A", "1", job="y")])
    prices = frames("prices", [_price("A", T(2024, 1, 1), None, "0.5")])
    out = [(r.job_id, r.estimated_cost) for r in cost.estimated_cost_by_job(usage, prices, days=None).collect()]
    assert out == [("x", 1.0), ("y", 0.5)]


def test_no_job_before_the_result_is_asked_for(spark, frames):
    usage = frames("usage", [_usage(dt.date(2025, 1, 1), T(2025, 1, 1), "A", "2")])
    prices = frames("prices", [_price("A", T(2024, 1, 1), None, "0.5")])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job expected")
    try:
        for build in (cost.daily_usage, cost.usage_by_sku, cost.top_sku_recent, cost.my_usage_by_job):
            build(usage)
        cost.estimated_cost_by_sku(usage, prices)
        cost.estimated_cost_by_job(usage, prices)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_prices_cut_at_time_buckets(spark, frames):
    """Equal to the plain join for open, touching, overlapping and foreign intervals, at any bucket width."""
    import random

    r = random.Random(4)
    at = lambda h: dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)
    usage = [(at(h).date(), at(h), r.choice(["A", "B", "C", None]), Decimal(r.randint(1, 9)), (f"j{h % 3}", None), ("u",))
             for h in (r.randrange(400) for _ in range(120))] + [(None, None, "A", Decimal(1), None, None)]
    prices = [(s, "USD", at(a), None if z is None else at(z), ((Decimal(p),),))
              for s, a, z, p in [("A", -500, 48, 1), ("A", 48, 120, 2), ("A", 100, None, 3), ("B", 24, 24, 4), ("B", 30, 31, 5),
                                 ("C", 900, None, 6), ("C", -90, -50, 7), ("B", 200, 350, 8)]]
    u, p = frames("usage", usage), frames("prices", prices)
    want = sorted(map(str, cost.priced(u, p).collect()))
    for days in (1, 3, 30):
        assert sorted(map(str, cost.priced_by_time(u, p, days).collect())) == want
    assert cost.priced_by_time(u.limit(0), p).count() == 0
    assert cost.estimated_cost_by_sku(u, p, None, bucket_days=2).collect() == cost.estimated_cost_by_sku(u, p, None).collect()


def test_a_hot_sku_is_spread_without_broadcast(spark):
    """90 % of the usage on one SKU and no broadcast: no task joins over three times the median."""
    from pyspark.sql import functions as F

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        time = F.timestamp_add("MINUTE", (F.col("id") * 13).cast("int"), F.lit("2024-01-01").cast("timestamp"))
        usage = spark.range(60_000).select(
            F.to_date(time).alias("usage_date"), time.alias("usage_end_time"), F.when(F.col("id") % 10 > 0, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 70).cast("string"))).alias("sku_name"),
            F.lit(1).cast("decimal(18,6)").alias("usage_quantity"), F.struct(F.lit("j").alias("job_id")).alias("usage_metadata"))
        prices = usage.select("sku_name").distinct().select(
            "sku_name", F.lit("USD").alias("currency_code"), F.lit("2020-01-01").cast("timestamp").alias("price_start_time"), F.lit(None).cast("timestamp").alias("price_end_time"),
            F.struct(F.struct(F.lit(2).cast("decimal(18,6)").alias("default")).alias("effective_list")).alias("pricing"))
        per_task = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        spread, plain = per_task(cost.priced_by_time(usage, prices)), per_task(cost.priced(usage, prices))
        assert sum(spread) == sum(plain) == 60_000 and max(plain) >= 54_000
        assert max(spread) <= 3 * spread[len(spread) // 2]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
