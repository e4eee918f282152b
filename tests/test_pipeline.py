import pytest
from conftest import SF_SMALL

from subsight.lake import Lake
from subsight.plans import metadata, pipeline
from subsight.sources.catalog import LakeConfig, show_tables


def test_config_rejects_empty_names():
    with pytest.raises(ValueError):
        LakeConfig(schema="")
    with pytest.raises(ValueError):
        LakeConfig(schema="ok", catalog="")
    with pytest.raises(ValueError):
        LakeConfig(schema="bad; drop")


def _comments(spark, config, table):
    cols = {c.name: c.description for c in spark.catalog.listColumns(config.fqn(table))}
    return spark.catalog.getTable(config.fqn(table)).description, cols


def test_pipeline_end_to_end(spark):
    config = LakeConfig(schema="pipe_e2e")
    raw = Lake.from_testdata(spark, SF_SMALL)
    bronze = pipeline.ingest_bronze(spark, config, raw)
    assert bronze["bronze_reading_logs"] == 6000
    counts = pipeline.run_pipeline(spark, config)       # reads the stored bronze tables
    assert counts["silver_reading_logs"] == 6000
    assert counts["silver_members"] == 150
    assert counts["gold_member_segment"] == 150
    names = {r.tableName for r in show_tables(spark, config).collect()}
    assert {"silver_reading_logs", "gold_monthly_engagement", "gold_paywall_conversion"} <= names

    # stored marts equal the lazily derived ones
    stored = Lake.from_catalog(spark, config)
    lazy = Lake.from_testdata(spark, SF_SMALL)
    for t in ("gold_monthly_engagement", "gold_member_segment", "gold_paywall_conversion"):
        assert stored[t].exceptAll(lazy[t]).count() == 0
        assert lazy[t].exceptAll(stored[t]).count() == 0

    # comments: 4 tables, every column, present again after a second overwrite
    pipeline.run_gold(spark, config)
    n_cols = 0
    for table in metadata.TABLE_COMMENTS:
        desc, cols = _comments(spark, config, table)
        assert desc == metadata.TABLE_COMMENTS[table]
        assert cols == metadata.COLUMN_COMMENTS[table]
        n_cols += len(cols)
    assert n_cols == 29 and len(metadata.TABLE_COMMENTS) == 4


def test_gold_not_run_when_silver_fails(spark, monkeypatch):
    config = LakeConfig(schema="pipe_fail")
    ran = []
    monkeypatch.setattr(pipeline, "run_silver", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("x")))
    monkeypatch.setattr(pipeline, "run_gold", lambda *a, **k: ran.append(1))
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(spark, config)
    assert ran == []


def test_glossary(spark):
    g = metadata.glossary_frame(spark).collect()
    assert len(g) == 6
    assert {r.term for r in g} >= {"サイレント離脱", "読了率", "転換率"}


def test_sql_text_over_stored_tables(spark):
    """A text with named tables and values, GROUP BY ALL included, equals the DataFrame form."""
    from pyspark.sql import functions as F

    from subsight.plans import sql

    config = LakeConfig(schema="sql_texts")
    pipeline.ingest_bronze(spark, config, Lake.from_testdata(spark, SF_SMALL))
    pipeline.run_silver(spark, config)
    logs = Lake.from_catalog(spark, config)["silver_reading_logs"]
    got = sql.run(spark, config, sql.SECONDS_BY_DEVICE, {"logs": "silver_reading_logs"}, {"premium": 1, "deep": 50.0})
    want = logs.where("is_premium = 1").groupBy("category", "device").agg(
        F.sum("reading_seconds").alias("seconds"), (F.avg("scroll_depth") >= 50).alias("deep")
    ).orderBy(F.desc("seconds"), "category", "device")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()] and got.count() > 1
    with pytest.raises(ValueError):
        sql.run(spark, config, "SELECT 1", {"x": "silver_reading_logs"}, {"x": 1})
    with pytest.raises(ValueError):
        sql.run(spark, config, "SELECT 1", {"x": "t; drop"})


def test_raw_ingest_formats(spark, frames):
    """A1: raw files in several formats read with the declared schema,
    no inference, columns in contract order, values unchanged."""
    import tempfile

    from conftest import member

    from subsight.model import MEMBERS_SCHEMA
    from subsight.sources.bronze import read_raw

    src = frames("members", [member(1, age=30, plan="paid"), member(2, age=None)])
    base = tempfile.mkdtemp(prefix="subsight-raw-")
    src.write.option("header", True).csv(f"{base}/csv")
    src.write.json(f"{base}/json")
    src.select(*reversed(src.columns)).write.parquet(f"{base}/parquet")  # other column order
    for fmt, opts in (("csv", {"header": True}), ("json", {}), ("parquet", {})):
        df = read_raw(spark, "members", f"{base}/{fmt}", fmt, **opts)
        assert df.schema == MEMBERS_SCHEMA, fmt
        got = sorted(tuple(r) for r in df.collect())
        assert got == sorted(tuple(r) for r in src.collect()), fmt


def test_refresh_months_equals_full_refresh(spark, frames):
    """New logs in two months: refreshing those months equals a full refresh."""
    from conftest import article, log, member

    from subsight import model as M
    from subsight.operators import silver
    from subsight.sources.bronze import write_table
    from subsight.sources.catalog import read_table

    config = LakeConfig(schema="month_refresh")
    members = [member(1, age=25), member(2, age=45), member(3, age=65)]
    arts = [article(1, "tech"), article(2, "econ")]
    old = [log(1, 1, 1, M.READ_START, "2025-01-05 10:00:00"), log(2, 2, 2, M.READ_COMPLETE, "2025-02-05 10:00:00"),
           log(3, 3, 1, M.PAYWALL_HIT, "2025-03-05 10:00:00"), log(4, 1, 1, M.PAYWALL_HIT, "bad")]
    new = [log(5, 1, 1, M.READ_COMPLETE, "2025-02-06 10:00:00"), log(6, 2, 2, M.SUBSCRIBE, "2025-04-01 00:10:00"),
           log(7, 9, 1, M.READ_START, "2025-04-02 10:00:00"), log(8, 1, 1, M.READ_START, "not a time"),
           log(9, 3, 2, M.SUBSCRIBE, "")]
    inputs = Lake.from_frames(spark, {
        "bronze_members": frames("members", members), "bronze_articles": frames("articles", arts),
        "bronze_reading_logs": frames("logs", old), "bronze_subscriptions": frames("subs", [])})
    pipeline.run_pipeline(spark, config, inputs)
    # append the new logs to silver, then refresh only their months
    stored_articles = read_table(spark, config, "silver_articles")
    extra = silver.silver_reading_logs(frames("logs", new), stored_articles).checkpoint()
    extra.write.mode("append").format(config.fmt).partitionBy("ym").saveAsTable(config.fqn("silver_reading_logs"))
    pipeline.refresh_months(spark, config, ["2025-02", "2025-04"])
    pipeline.refresh_months(spark, config, ["2025-02", "2025-04"])   # twice: same result
    marts = {t: sorted((tuple(r) for r in read_table(spark, config, t).collect()), key=repr)
             for t in pipeline.MARTS}
    pipeline.run_gold(spark, config)                                 # full refresh over all logs
    for t in pipeline.MARTS:
        assert marts[t] == sorted((tuple(r) for r in read_table(spark, config, t).collect()), key=repr), t
    assert len(marts["gold_monthly_engagement"]) == 5
    seg = {r[0]: r[4] for r in marts["gold_member_segment"]}
    assert seg == {1: 4, 2: 2, 3: 2}                                 # total events per member



def test_cluster_settings_scale_with_input():
    from subsight.plans.session import cluster_settings

    big = cluster_settings(100 * 1024 ** 4, total_cores=8000)
    assert int(big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 40960
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)
    less = cluster_settings(100 * 1024 ** 4, total_cores=8000, shuffled_bytes=1024 ** 4)
    assert int(less["spark.sql.shuffle.partitions"]) == 16000                # two waves
    small = cluster_settings(10 * 1024 ** 2, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_failed_write_leaves_the_old_table(spark):
    from pyspark.sql import functions as F

    from subsight.sources.bronze import write_table
    from subsight.sources.catalog import read_table, use_schema

    config = LakeConfig(schema="failed_write")
    use_schema(spark, config)
    for parts in (None, ["k"]):
        name = "t_parts" if parts else "t_plain"
        df = spark.range(10).select("id", (F.col("id") % 3).cast("string").alias("k"))
        assert write_table(df, config, name, partition_by=parts) == 10
        bad = df.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).cast("long"))
        with pytest.raises(Exception, match="stopped"):
            write_table(bad, config, name, partition_by=parts)
        assert read_table(spark, config, name).count() == 10
        # a table may be rewritten from itself, with another schema
        again = read_table(spark, config, name).where("id < 4").withColumn("extra", F.lit(1))
        assert write_table(again, config, name, partition_by=parts) == 4
        assert read_table(spark, config, name).where("k = '0'").count() == 2
        assert "extra" in read_table(spark, config, name).columns


def test_month_refresh_writes_one_month(spark, frames):
    """A refresh replaces the files of its month (and of logs without one) and leaves the others as they are."""
    from pathlib import Path
    from urllib.parse import urlparse

    config = LakeConfig(schema="month_files")
    pipeline.ingest_bronze(spark, config, Lake.from_testdata(spark, SF_SMALL))
    pipeline.run_pipeline(spark, config)
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {config.fqn(pipeline.ACTIVITY)}").where("col_name = 'Location'").first()[1]
    files = lambda: {str(p) for p in Path(urlparse(where).path).glob("ym=*/*.parquet")}
    before = files()
    pipeline.refresh_months(spark, config, ["1998-07"])
    gone, new = before - files(), files() - before
    months = lambda paths: {Path(p).parent.name for p in paths}
    assert months(gone) == months(new) == {"ym=1998-07", "ym=__HIVE_DEFAULT_PARTITION__"}


def test_files_to_marts(spark, frames):
    """CSV and parquet folders to marts; later files only recompute the months they touch."""
    import os
    import tempfile

    from conftest import article, log, member, sub

    from subsight import model as M
    from subsight.sources.catalog import read_table

    base = tempfile.mkdtemp(prefix="subsight-files-")
    frames("members", [member(1, age=25), member(2, age=45)]).write.option("header", True).csv(f"{base}/members")
    frames("articles", [article(1, "tech"), article(2, "econ")]).write.option("header", True).csv(f"{base}/articles")
    frames("subs", [sub(1, 1)]).write.option("header", True).csv(f"{base}/subscriptions")
    day1 = [log(1, 1, 1, M.READ_START, "2025-01-05 10:00:00"), log(2, 2, 2, M.PAYWALL_HIT, "2025-02-06 10:00:00")]
    day2 = [log(3, 2, 2, M.SUBSCRIBE, "2025-02-07 00:10:00"), log(4, 1, 1, M.READ_COMPLETE, "bad")]
    frames("logs", day1).write.parquet(f"{base}/reading_logs/d1")
    paths = {n: f"{base}/{n}" for n in ("members", "articles", "subscriptions")}
    inputs = Lake.from_files(spark, {**paths, "reading_logs": f"{base}/reading_logs/*"}, fmt="csv", header=True)

    config = LakeConfig(schema="files_inc")
    logs_glob = os.path.join(base, "reading_logs", "*")
    pipeline.run_pipeline(spark, config, inputs, log_files=logs_glob)
    assert pipeline.grown_months(spark, config) == []
    frames("logs", day2).write.parquet(f"{base}/reading_logs/d2")
    pipeline.run_silver(spark, config, inputs, log_files=logs_glob)         # as if the run stopped here
    assert pipeline.grown_months(spark, config) == ["2025-02"]
    pipeline.run_pipeline(spark, config, inputs, log_files=logs_glob)       # no new files: still made up for

    full = LakeConfig(schema="files_full")
    both = Lake.from_files(spark, paths, fmt="csv", header=True)
    both._loaders["bronze_reading_logs"] = lambda: frames("logs", day1 + day2)
    pipeline.run_pipeline(spark, full, both)
    for t in pipeline.MARTS:
        got, want = (sorted(map(tuple, read_table(spark, c, t).collect()), key=repr) for c in (config, full))
        assert got == want, t
