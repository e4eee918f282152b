"""Silence as it happens: after each run the changes give the batch answer over the logs so far, across restarts."""

import datetime as dt
import random
import tempfile

import pytest
from conftest import log, member, sub

from subsight import model as M
from subsight.operators import churn, gold, silver
from subsight.sources.catalog import LakeConfig, read_table, use_schema
from subsight.streaming import silence

MEMBERS = [member(i, age=20 + i, plan="paid" if i % 3 else "free") for i in range(1, 13)]
SUBS = [sub(1, 2, "churned", end="2025-01-01"), sub(2, 4, "active")]


def batches(seed):
    """Days of logs, with late ones, a gap that silences many, members that return, times at midnight, bad times."""
    r = random.Random(seed)
    start, out, n = dt.datetime(2025, 1, 1), [], 0
    for day in (0, 20, 95, 111, 200, 301):
        rows = []
        for _ in range(r.randint(1, 6)):
            n += 1
            at = start + dt.timedelta(days=day - r.choice([0, 0, 0, 1, 60, 95, 130]), hours=r.choice([0, 7, 23]))
            rows.append(log(n, r.choice([*range(1, 13), 99, None]), 1, M.READ_START, r.choice([str(at)] * 9 + ["bad"])))
        n += 1
        rows.append(log(n, r.choice([1, 99, None]), 1, M.READ_START, str(start + dt.timedelta(days=day))))
        out.append(rows)
    return out


@pytest.fixture()
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("seed", [1])
def test_each_run_equals_the_batch_answer(spark, frames, few_partitions, seed):
    config = LakeConfig(schema=f"silence_{seed}")
    use_schema(spark, config)
    base = tempfile.mkdtemp(prefix="subsight-silence-")
    members, subs = silver.silver_members(frames("members", MEMBERS)), silver.silver_subscriptions(frames("subs", SUBS))
    so_far = []
    seen = 0
    for k, rows in enumerate(batches(seed)):
        frames("logs", rows).coalesce(1).write.parquet(f"{base}/logs/b{k}")
        so_far += rows
        # every run is a new query on the same checkpoint, as after a restart
        query = silence.watch_silence(spark, config, f"{base}/logs/*", f"{base}/checkpoint")
        query.awaitTermination()
        assert query.exception() is None
        activity = gold.member_activity(silver.log_events(frames("logs", so_far)))
        want = churn.silent_members(members, activity, subs).drop("days_since_last_event")
        changes = read_table(spark, config, silence.CHANGES_TABLE)
        assert sorted(map(str, silence.silent_now(changes, members, subs).collect())) == sorted(map(str, want.collect())), k
        seen += bool(want.count())
    assert seen >= 3 and changes.where("NOT silent").count() >= 1       # members turned silent, and some came back
