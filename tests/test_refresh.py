"""Marts that follow their months: any order of refreshes equals a full run, reads no other month, and survives a kill."""

import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from conftest import article, log, member

from subsight import model as M
from subsight.lake import Lake
from subsight.operators import silver
from subsight.plans import pipeline, refresh
from subsight.sources.bronze import write_table
from subsight.sources.catalog import LakeConfig, read_table, recover_tables, use_schema

TABLES = [*pipeline.MARTS, M.TOTALS_TABLE, M.MONTHS_TABLE, M.ACTIVITY_TABLE]
ARTICLES = [article(1, "tech"), article(2, "econ"), article(3, "life")]


def rows_of(spark, config, tables=TABLES):
    out = {}
    for t in tables:
        df = read_table(spark, config, t)
        out[t] = sorted((str(r) for r in df.select(*sorted(df.columns)).collect()))
    return out


def random_logs(r, n, months, first=0):
    kinds = M.EVENT_TYPES
    out = []
    for i in range(n):
        m = r.choice(months)
        time = "" if r.random() < 0.05 else f"{m}-{r.randint(1, 28):02d} 10:00:00"
        out.append(log(first + i, r.choice([1, 2, 3, 4, 5, 99, None]), r.choice([1, 2, 3, 7]), r.choice(kinds), time))
    return out


def put_logs(spark, frames, config, logs):
    """Silver logs as a whole (a correction may take rows away)."""
    articles = silver.silver_articles(frames("articles", ARTICLES))
    write_table(silver.silver_reading_logs(frames("logs", logs), articles), config, "silver_reading_logs", partition_by=["ym"])


def put_members(spark, frames, config, ages):
    rows = [member(i, age=a, plan="paid") for i, a in ages.items()]
    write_table(silver.silver_members(frames("members", rows)), config, "silver_members")


def begin(spark, frames, name, logs, ages):
    config = LakeConfig(schema=name)
    use_schema(spark, config)
    put_members(spark, frames, config, ages)
    put_logs(spark, frames, config, logs)
    pipeline.run_gold(spark, config)
    return config


def months_of(logs):
    return {r[4][:7] for r in logs if r[4]}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_refreshes_equal_a_full_run(spark, frames, seed):
    """Late logs, months that lose some or all of their logs, members that turn up, vanish or change band."""
    r = random.Random(seed)
    months = [f"2025-0{i}" for i in range(1, 7)]
    ages = {1: 25, 2: 45, 3: 65, 4: 30}
    logs = random_logs(r, 40, months)
    config = begin(spark, frames, f"refresh_{seed}", logs, ages)
    for step in range(3):
        some = set(r.sample(months, 2))
        before = logs
        logs = [x for x in logs if x[4][:7] not in some or r.random() < (0.0 if step == 0 else 0.5)]
        logs = logs + random_logs(r, 6, sorted(some), first=1000 * (step + 1)) if step else logs
        if step:
            ages = {**ages, r.choice([1, 2, 5]): r.choice([22, 33, 44, 70])}
        put_logs(spark, frames, config, logs)
        put_members(spark, frames, config, ages)
        changed = sorted((months_of(logs) | months_of(before)) & some)
        pipeline.refresh_months(spark, config, changed)
        got = rows_of(spark, config)
        pipeline.run_gold(spark, config)
        assert got == rows_of(spark, config), step


def _files(spark, config, table, ym):
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {config.fqn(table)}").where("col_name = 'Location'").first()[1]
    return [p for p in Path(urlparse(where).path).glob("ym=*/*.parquet") if p.parent.name not in {f"ym={m}" for m in ym}]


def test_a_refresh_reads_its_month_and_no_other(spark, frames):
    """With every other month's files of logs and activity unreadable the refresh still runs, and equals the full one."""
    months = [f"2025-0{i}" for i in range(1, 7)]
    old = [log(i, 1 + i % 3, 1, M.EVENT_TYPES[i % 4], f"{m}-05 10:00:00") for i, m in enumerate(months * 3)]
    new = [*old, log(50, 1, 2, M.SUBSCRIBE, "2025-03-06 10:00:00"), log(51, 4, 2, M.PAYWALL_HIT, "2025-03-07 10:00:00")]
    ages = {1: 25, 2: 45, 3: 65, 4: 30}
    config = begin(spark, frames, "refresh_reads", old, ages)
    want = rows_of(spark, begin(spark, frames, "refresh_want", new, ages), pipeline.MARTS)
    put_logs(spark, frames, config, new)
    for table in ("silver_reading_logs", M.ACTIVITY_TABLE):
        for p in _files(spark, config, table, {"2025-03"}):
            p.write_bytes(b"not a parquet file")
            (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    pipeline.refresh_months(spark, config, ["2025-03"])
    assert rows_of(spark, config, pipeline.MARTS) == want


def test_a_day_that_fell_is_found_in_one_other_month(spark, frames):
    """A member loses its last month's logs: of the other months only its latest is read."""
    months = [f"2025-0{i}" for i in range(1, 6)]
    old = [log(i, 1, 1, M.READ_START, f"{m}-05 10:00:00") for i, m in enumerate(months)] + [log(9, 2, 1, M.READ_START, "2025-05-09 10:00:00")]
    new = [x for x in old if x[4][:7] != "2025-05"]
    ages = {1: 25, 2: 45}
    config = begin(spark, frames, "refresh_fell", old, ages)
    want = rows_of(spark, begin(spark, frames, "refresh_fell_want", new, ages), [*pipeline.MARTS, M.TOTALS_TABLE])
    put_logs(spark, frames, config, new)
    for p in _files(spark, config, M.ACTIVITY_TABLE, {"2025-05", "2025-04"}):
        p.write_bytes(b"not a parquet file")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    pipeline.refresh_months(spark, config, ["2025-05"])
    assert rows_of(spark, config, [*pipeline.MARTS, M.TOTALS_TABLE]) == want


@pytest.mark.parametrize("after", ["stage", M.TOTALS_TABLE, M.MONTHS_TABLE, "gold_paywall_conversion"])
def test_a_killed_refresh_is_finished_by_the_next(spark, frames, monkeypatch, after):
    """Killed after any step: the next refresh, of whatever months, takes the delta in once."""
    ages = {1: 25, 2: 45, 3: 65}
    old = [log(i, 1 + i % 3, 1, M.EVENT_TYPES[i % 4], f"2025-0{1 + i % 3}-05 10:00:00") for i in range(12)]
    new = [*old, log(50, 1, 2, M.SUBSCRIBE, "2025-02-06 10:00:00"), log(51, 3, 2, M.READ_START, "2025-05-07 10:00:00")]
    config = begin(spark, frames, f"killed_{after.lower()}", old, ages)
    put_logs(spark, frames, config, new)
    real = refresh.write_table

    def stops(df, config, table, *a, **k):
        out = real(df, config, table, *a, **k)
        if table == after:
            raise KeyboardInterrupt
        return out

    with monkeypatch.context() as m:
        if after == "stage":
            m.setattr(refresh, "apply", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        else:
            m.setattr(refresh, "write_table", stops)
        with pytest.raises(KeyboardInterrupt):
            pipeline.refresh_months(spark, config, ["2025-02", "2025-05"])
    assert refresh.pending(spark, config)[1] == ["2025-02", "2025-05"]
    pipeline.refresh_months(spark, config, ["2025-01"])
    assert refresh.pending(spark, config) is None
    got = rows_of(spark, config)
    pipeline.run_gold(spark, config)
    assert got == rows_of(spark, config)


def test_recover_a_table_between_drop_and_rename(spark):
    from pyspark.sql import functions as F

    config = LakeConfig(schema="recover")
    use_schema(spark, config)
    for parts in (None, ["k"]):
        name = "parted" if parts else "plain"
        df = spark.range(10).select("id", (F.col("id") % 3).cast("string").alias("k"))
        write_table(df, config, name, partition_by=parts)
        writer = df.where("id < 4").write.mode("overwrite")
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(config.fqn(f"{name}__next"))
    df.write.mode("overwrite").saveAsTable(config.fqn("kept__next"))
    df.where("id = 1").write.mode("overwrite").saveAsTable(config.fqn("kept"))
    for name in ("plain", "parted"):
        spark.sql(f"DROP TABLE {config.fqn(name)}")          # the driver is killed here
    assert recover_tables(spark, config) == ["parted", "plain"]
    assert [read_table(spark, config, n).count() for n in ("plain", "parted", "kept")] == [4, 4, 1]
    assert read_table(spark, config, "parted").where("k = '0'").count() == 2
    assert recover_tables(spark, config) == []


def test_raw_marts_push_their_events_and_join_no_article(spark):
    """From raw tables Q7 and Q18-Q23 join no article, and Q5 and Q7 filter their events below every aggregate."""
    from conftest import SF_SMALL

    from subsight.plans.registry import QUERIES

    lake = Lake.from_testdata(spark, SF_SMALL)
    for name in ("gold_paywall_conversion", "conversion_by_age", "paywall_improvement_target", "silent_members", "gold_member_segment"):
        plan = QUERIES[name](lake)._jdf.queryExecution().optimizedPlan().toString()
        assert "p_partkey" not in plan and "part.parquet" not in plan, name
    plan = QUERIES["gold_paywall_conversion"](lake)._jdf.queryExecution().optimizedPlan().toString()
    assert "paywall_hit" in plan.split("Aggregate")[-1]
