"""Silent members as it happens: keyed state with event-time timers.

A member turns silent when the logs reach a day ``days`` after its last
event, which no row of its own announces. So each member's last day is kept
as state with a timer for the day it would turn silent; the timer fires when
the newest event of *all* logs, the watermark, has passed it. A change is
written when it happens: a member turned silent, came back, or a late log
moved the last day of a silent one. What holds now is the last change per
member (:func:`silent_now`); after each run that is the batch answer (Q19)
over the logs so far.

Late logs count, however late. Spark drops rows that are older than the
watermark, so a log goes in twice: as a time that only moves the watermark,
and as a row without time that only reaches the state. The first is filtered
out before the shuffle.

Scale: state is one day and one number per member; a batch touches the
members that have new logs or whose day has come.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from subsight import model as M
from subsight.operators import churn, silver
from subsight.sources.catalog import LakeConfig, read_table

CHANGES_TABLE = "silence_changes"
_DAY_MS = 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE_SCHEMA = "member_id long, change long, silent boolean, last_event_date date"
_EPOCH = dt.date(1970, 1, 1)


class Silence(StatefulProcessor):
    """State of one member: last day, number of changes written, whether silent."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.member = handle.getValueState("member", "last int, changes long, silent boolean")

    def _due(self, last: int) -> int:
        """Milliseconds of the day on which the member is silent."""
        return (last + self.days) * _DAY_MS

    def _await(self, last: int, previous: int | None) -> None:
        if previous is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
        self.handle.registerTimer(self._due(last) - 1)

    def _change(self, key: Any, last: int, changes: int, silent: bool) -> Row:
        self.member.update((last, changes, silent))
        return Row(member_id=key[0], change=changes, silent=silent, last_event_date=_EPOCH + dt.timedelta(days=last))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest = max(r.day for r in rows)
        held = self.member.get() if self.member.exists() else None
        last, changes, silent = held if held else (None, 0, False)
        if last is not None and newest <= last:
            return
        if silent and self._due(newest) <= timerValues.getCurrentWatermarkInMs():  # a late log, and still silent
            yield self._change(key, newest, changes + 1, True)
            return
        self._await(newest, last)
        if silent:
            yield self._change(key, newest, changes + 1, False)
        else:
            self.member.update((newest, changes, False))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        last, changes, silent = self.member.get()
        if timerValues.getCurrentWatermarkInMs() < self._due(last):
            self.handle.registerTimer(self._due(last))
        elif not silent:
            yield self._change(key, last, changes + 1, True)

    def close(self) -> None:
        pass


def changes(logs: DataFrame, days: int = M.SILENT_DAYS) -> DataFrame:
    """The stream of changes of a stream of logs with ``member_id, event_time``.

    Logs without a time are no events. Logs without a member move the time
    only. Members that are not known turn silent like others;
    :func:`silent_now` joins the known ones.
    """
    clock = F.struct(F.lit(None).cast("long").alias("member_id"), F.lit(None).cast("int").alias("day"), F.col("event_time").alias("mark"))
    event = F.struct(F.col("member_id"), F.unix_date(F.to_date("event_time")).alias("day"), F.lit(None).cast("timestamp").alias("mark"))
    parts = F.when(F.col("member_id").isNull(), F.array(clock)).otherwise(F.array(clock, event))
    twice = logs.where("event_time IS NOT NULL").select("member_id", "event_time").select(F.inline(parts))
    # The only condition behind the watermark is on its own column: any other would be moved in front of it, and the clock stop.
    state = twice.withWatermark("mark", "0 seconds").where("mark IS NULL").select("member_id", "day")
    return state.groupBy("member_id").transformWithState(
        statefulProcessor=Silence(days), outputStructType=CHANGE_SCHEMA, outputMode="Append", timeMode="EventTime")


def watch_silence(spark: SparkSession, config: LakeConfig, source_path: str, checkpoint: str, *, fmt: str = "parquet",
                  days: int = M.SILENT_DAYS, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Takes all log files of ``source_path`` not yet seen and appends the changes to ``silence_changes``.

    The state is in ``checkpoint``, which belongs to the table, in the
    cluster's shared folder; a lost executor or driver continues from it, and
    the file sink writes each batch once.
    """
    raw = (spark.readStream.schema(M.READING_LOGS_SCHEMA).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger).load(source_path))
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)  # a query takes the setting it starts with
    try:
        return (changes(silver.log_events(raw), days).writeStream.format(config.fmt).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).toTable(config.fqn(CHANGES_TABLE)))
    finally:
        spark.conf.set(_PROVIDER, before)


def silent_now(found: DataFrame, members: DataFrame, subs: DataFrame) -> DataFrame:
    """Q19 from the changes: paid members silent now, without a churned subscription:
    ``member_id, plan_type, age_group, last_event_date``."""
    now = found.groupBy("member_id").agg(F.max_by(F.struct("silent", "last_event_date"), "change").alias("now")).where("now.silent")
    who = members.where(F.col("plan_type").isin(M.PAID_PLANS)).select("member_id", "plan_type", "age_group")
    return who.join(now, "member_id").join(churn.churned(subs).select("member_id").distinct(), "member_id", "left_anti") \
        .select("member_id", "plan_type", "age_group", F.col("now.last_event_date").alias("last_event_date"))


def silent_members_now(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """:func:`silent_now` over the stored changes, members and subscriptions."""
    return silent_now(*(read_table(spark, config, t) for t in (CHANGES_TABLE, "silver_members", "silver_subscriptions")))
