"""Changed articles: a stream of logs plus propagation equals the full refresh, and only months with their logs are read."""

import tempfile

from conftest import article, log, member, sub

from subsight import model as M
from subsight.lake import Lake
from subsight.plans import articles, pipeline
from subsight.sources.bronze import write_table
from subsight.sources.catalog import LakeConfig, read_table, table_exists
from subsight.operators import silver


def test_stream_and_propagation_equal_the_full_refresh(spark, frames):
    base = tempfile.mkdtemp(prefix="subsight-articles-")
    members = [member(1, age=25), member(2, age=45), member(3, age=65)]
    first = [article(1, "tech"), article(2, "econ"), article(3, "life"), article(4, "tech")]
    # 1 changes category, 2 its flag, 3 vanishes, 5 becomes known, 4 stays
    then = [article(1, "econ"), article(2, "econ", premium=1), article(4, "tech"), article(5, "life")]
    months = ["2025-01", "2025-02", "2025-03", "2025-04"]
    day1 = [log(i, 1 + i % 3, a, M.EVENT_TYPES[i % 4], f"{m}-0{1 + i % 5} 10:00:00")
            for i, (m, a) in enumerate([("2025-01", 1), ("2025-01", 2), ("2025-02", 3), ("2025-02", 5), ("2025-03", 4), ("2025-03", None)] * 3)]
    day2 = [log(100, 1, 1, M.READ_START, "2025-04-01 10:00:00"), log(101, 2, 3, M.READ_COMPLETE, "bad"), log(102, 2, 5, M.SUBSCRIBE, "2025-01-09 10:00:00")]

    def inputs(arts):
        return Lake.from_frames(spark, {"bronze_members": frames("members", members), "bronze_articles": frames("articles", arts),
                                        "bronze_subscriptions": frames("subs", [sub(1, 1)])})

    config = LakeConfig(schema="late_articles")
    frames("logs", day1).write.parquet(f"{base}/d1")
    pipeline.run_pipeline(spark, config, inputs(first), log_files=f"{base}/*")
    pipeline.index_articles(spark, config)
    pipeline.run_sketches(spark, config)
    assert articles.propagate(spark, config) is None
    frames("logs", day2).write.parquet(f"{base}/d2")
    refreshed = []
    real = pipeline.refresh_months
    pipeline.refresh_months = lambda s, c, m: (refreshed.append(list(m)), real(s, c, m))[1]
    try:
        pipeline.run_pipeline(spark, config, inputs(then), log_files=f"{base}/*")
    finally:
        pipeline.refresh_months = real
    assert refreshed == [["2025-01", "2025-02", "2025-04"]]      # no log of a changed article in March
    assert articles.propagate(spark, config) is None             # in force everywhere

    full = LakeConfig(schema="late_articles_full")
    lake = inputs(then)
    lake._loaders["bronze_reading_logs"] = lambda: frames("logs", day1 + day2)
    pipeline.run_pipeline(spark, full, lake)
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for t in [*pipeline.MARTS, M.ACTIVITY_TABLE, M.TOTALS_TABLE]:
        assert rows(read_table(spark, config, t)) == rows(read_table(spark, full, t)), t
    stored, again = Lake.from_catalog(spark, config), Lake.from_catalog(spark, full)
    assert rows(stored["silver_reading_logs"]) == rows(again["silver_reading_logs"])
    assert set(months) >= {r[0] for r in read_table(spark, config, M.ARTICLE_INDEX).select("ym").distinct().collect()} - {None}


def test_a_batch_refresh_needs_no_overrides(spark, frames):
    config = LakeConfig(schema="late_articles_batch")
    logs = [log(1, 1, 1, M.READ_START, "2025-01-05 10:00:00"), log(2, 1, 2, M.READ_START, "2025-02-05 10:00:00")]
    lake = lambda arts: Lake.from_frames(spark, {
        "bronze_members": frames("members", [member(1)]), "bronze_articles": frames("articles", arts),
        "bronze_reading_logs": frames("logs", logs), "bronze_subscriptions": frames("subs", [])})
    pipeline.run_pipeline(spark, config, lake([article(1, "tech"), article(2, "econ")]))
    pipeline.index_articles(spark, config)
    write_table(silver.silver_articles(frames("articles", [article(1, "life"), article(2, "econ")])), config, "silver_articles")
    pipeline.refresh_articles(spark, config)
    got = {(r.ym, r.category) for r in read_table(spark, config, "gold_monthly_engagement").collect()}
    assert got == {("2025-01", "life"), ("2025-02", "econ")} and table_exists(spark, config, M.OVERRIDES_TABLE)
    pipeline.run_silver(spark, config, lake([article(1, "life"), article(2, "econ")]))
    assert not table_exists(spark, config, M.OVERRIDES_TABLE)
    assert {r.category for r in Lake.from_catalog(spark, config)["silver_reading_logs"].collect()} == {"life", "econ"}
