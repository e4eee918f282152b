"""Exploration queries on bronze and gold (Q8-Q14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight import model as M
from subsight.functions import count_where, month_of


def preview(df: DataFrame, n: int = 10, columns: Sequence[str] | None = None,
            order: Sequence[str] | None = None) -> DataFrame:
    """Q8: a few rows (the limit is the feature). Without ``order`` any rows,
    and the scan stops early; with it the first ones by those columns, kept
    as n rows per task."""
    rows = df.orderBy(*order) if order else df
    return (rows.select(*columns) if columns else rows).limit(n)


def _reads_per_member(logs: DataFrame) -> DataFrame:
    return (logs.filter(F.col("event_type") == M.READ_COMPLETE)
            .groupBy("member_id").agg(F.count(F.lit(1)).alias("reads_completed")))


def reads_by_member(logs: DataFrame) -> DataFrame:
    """Q9: completed reads per member, most first (ties by member_id)."""
    return _reads_per_member(logs).orderBy(F.desc("reads_completed"), "member_id")


def reads_by_member_named(logs: DataFrame, members: DataFrame) -> DataFrame:
    """Q10: Q9 with the member's name and plan (inner join: logs of unknown
    members drop out).

    Scale: reads are counted per member before the join, so the join moves
    one row per reader instead of every event; equal to grouping the joined
    rows by (member_id, name, plan_type) because member_id is the members'
    key."""
    return (
        _reads_per_member(logs)
        .join(members.select("member_id", "name", "plan_type"), on="member_id", how="inner")
        .select("member_id", "name", "plan_type", "reads_completed")
        .orderBy(F.desc("reads_completed"), "member_id")
    )


def members_by_plan(members: DataFrame) -> DataFrame:
    """Q11: members per plan, most first."""
    return (members.groupBy("plan_type").agg(F.count(F.lit(1)).alias("members"))
            .orderBy(F.desc("members"), "plan_type"))


def events_by_type(logs: DataFrame) -> DataFrame:
    """Q12: events per type, most first."""
    return (logs.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "event_type"))


def monthly_views_reads(bronze_logs: DataFrame) -> DataFrame:
    """Q13: per month, views and completed reads, straight from the bronze
    text times (``try_to_timestamp``: bad text gives a NULL month, not an
    error)."""
    ym = month_of(F.try_to_timestamp(F.col("event_time"))).alias("ym")
    return (
        bronze_logs.filter(F.col("event_type").isin(M.READ_START, M.READ_COMPLETE))
        .groupBy(ym)
        .agg(
            F.count(F.lit(1)).alias("article_views"),
            count_where(F.col("event_type") == M.READ_COMPLETE).alias("reads_completed"),
        )
        .orderBy("ym")
    )


def category_monthly_completion(engagement: DataFrame, category: str) -> DataFrame:
    """Q14: completion % per month of one category. The category filter is
    pushed below the aggregate (it is a grouping key) and down to the
    article scan."""
    return (
        engagement.filter(F.col("category") == category)
        .select("ym", "category", "article_views", "reads_completed", "completion_rate")
        .orderBy("ym")
    )
