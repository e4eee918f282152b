"""One member holds a third of all events: results equal a brute-force
count on the driver-side rows of a small fixture."""

import collections

from conftest import article, log, member

from subsight import model as M
from subsight.operators import explore, gold, silver


def test_hot_member(spark, frames):
    rows, lid = [], 0
    types = [M.READ_START, M.READ_COMPLETE, M.PAYWALL_HIT, M.SUBSCRIBE]
    for i in range(300):                       # member 1: a third of the rows
        lid += 1
        rows.append(log(lid, 1, 1 + i % 3, types[i % 4], f"2025-0{1 + i % 3}-10 10:00:00"))
    for m in range(2, 602):                    # 600 other members, one event each
        lid += 1
        rows.append(log(lid, m, 1 + m % 3, types[m % 4], f"2025-0{1 + m % 3}-11 10:00:00"))
    members = [member(m, age=20 + m % 50) for m in range(1, 602)]
    arts = silver.silver_articles(frames("articles", [article(1, "a"), article(2, "b"), article(3, "c")]))
    logs = silver.silver_reading_logs(frames("logs", rows), arts)
    mem = silver.silver_members(frames("members", members))
    act = gold.member_month_activity(logs)

    want = collections.Counter((r[2] if r[3] == M.READ_COMPLETE else None) for r in rows)
    got = {r.member_id: r.reads_completed for r in explore.reads_by_member(logs).collect()}
    assert got[1] == 75 and sum(got.values()) == sum(v for k, v in want.items() if k is not None)

    seg = {r.member_id: r.total_events for r in gold.member_segment(mem, act).collect()}
    assert seg[1] == 300 and sum(seg.values()) == 900

    conv = gold.paywall_conversion(act, mem).collect()
    assert sum(r.paywall_hits for r in conv) == sum(1 for r in rows if r[3] == M.PAYWALL_HIT)
    assert sum(r.conversions for r in conv) == sum(1 for r in rows if r[3] == M.SUBSCRIBE)

    eng = gold.monthly_engagement(act).collect()
    assert sum(r.article_views for r in eng) == sum(1 for r in rows if r[3] in (M.READ_START, M.READ_COMPLETE))


def test_hot_article_split_when_not_broadcast(spark, frames):
    """No broadcast (the dimension is 'too big'): the left join of logs to
    articles is a sort-merge join, and AQE splits the partition of the hot
    article instead of giving it to one task."""
    from pyspark.sql import functions as F

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 60000
        rows = [log(i, i % 97, 1 if i % 3 == 0 else 2 + i % 200, M.READ_START) for i in range(n)]
        logs_raw = frames("logs", rows).repartition(8)
        arts = silver.silver_articles(frames("articles", [article(a, f"c{a % 5}") for a in range(1, 202)]))
        out = silver.silver_reading_logs(logs_raw, arts)
        counts = {r.article_id: r.n for r in out.groupBy("article_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert counts[1] == n // 3 and sum(counts.values()) == n
        # the whole log row travels (skew is measured in shuffled bytes)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
