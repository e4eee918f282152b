"""Refused values: kept plus set aside is what was read, per reason, from files and from a stream."""

import tempfile

from conftest import log, member, sub

from subsight import model as M
from subsight.sources import sift
from subsight.sources.catalog import LakeConfig, use_schema


def test_reasons(frames):
    rows = [sub(1, 1, end=""), sub(2, 1, "churned", end=""), sub(3, 1, "churned", start="x", end="2024-13-01"), sub(4, 1, start=None, end=None),
            sub(5, 1, None, end=" "), sub(6, 1, "churned", end="2024-05-01")]
    out = {r.subscription_id: [tuple(x) for x in r.refused] for r in sift.sifted(frames("subs", rows), "subscriptions").collect()}
    assert out == {1: [], 2: [("end_date", "", "empty")], 3: [("start_date", "x", "no date"), ("end_date", "2024-13-01", "no date")], 4: [], 5: [], 6: []}
    counts = {(r.column_name, r.reason): (r.refused, r.rows_read, r.rows_kept) for r in sift.refused_values(frames("subs", rows), "subscriptions").collect()}
    assert counts == {("end_date", "empty"): (1, 6, 4), ("start_date", "no date"): (1, 6, 4), ("end_date", "no date"): (1, 6, 4)}
    assert sift.refused_values(frames("subs", []), "subscriptions").count() == 0


def test_files_and_stream_keep_and_set_aside_every_row(spark, frames):
    base = tempfile.mkdtemp(prefix="subsight-sift-")
    first = [log(1, 1, 1, M.READ_START), log(2, 1, 1, M.READ_START, "bad"), log(3, 1, 1, M.READ_START, ""), log(4, None, None, None, None)]
    second = [log(5, 1, 1, M.READ_START, "2025-99-01"), log(6, 1, 1, M.READ_START)]
    frames("logs", first).coalesce(1).write.parquet(f"{base}/logs/d1")
    frames("logs", second).coalesce(1).write.parquet(f"{base}/logs/d2")
    config = LakeConfig(schema="sift_batch")
    use_schema(spark, config)
    assert sift.ingest_sifted(spark, config, "reading_logs", f"{base}/logs/*") == {"read": 6, "kept": 3, "set_aside": 3}
    aside = {r.log_id: (r.refused[0].value, r.refused[0].reason, "/d1/" in r.source_file) for r in sift.set_aside(spark, config, "reading_logs").collect()}
    assert aside == {2: ("bad", "no timestamp", True), 3: ("", "empty", True), 5: ("2025-99-01", "no timestamp", False)}
    assert sift.kept(spark, config, "reading_logs").schema == M.READING_LOGS_SCHEMA

    streamed = LakeConfig(schema="sift_stream")
    use_schema(spark, streamed)
    for part in ("d1", "*"):  # the second run finds one new folder
        sift.stream_sifted(spark, streamed, "reading_logs", f"{base}/logs/{part}", f"{base}/checkpoint").awaitTermination()
    for read in (sift.kept, sift.set_aside):
        assert sorted(map(str, read(spark, streamed, "reading_logs").select("log_id", "event_time").collect())) == \
            sorted(map(str, read(spark, config, "reading_logs").select("log_id", "event_time").collect()))


def test_empty_and_null_inputs(spark, frames):
    config = LakeConfig(schema="sift_empty")
    use_schema(spark, config)
    base = tempfile.mkdtemp(prefix="subsight-sift-")
    frames("members", []).write.parquet(f"{base}/none")
    assert sift.ingest_sifted(spark, config, "members", f"{base}/none") == {"read": 0, "kept": 0, "set_aside": 0}
    frames("members", [(7, *(None,) * 8), member(1)]).write.option("header", True).csv(f"{base}/csv")
    assert sift.ingest_sifted(spark, config, "members", f"{base}/csv", fmt="csv", header=True) == {"read": 2, "kept": 2, "set_aside": 0}
