"""Churn and silent-churn questions (Q15-Q21, Q25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight import model as M


def churned(subs: DataFrame) -> DataFrame:
    return subs.filter(F.col("status") == M.STATUS_CHURNED)


def churn_by_month(subs: DataFrame) -> DataFrame:
    """Q15: churned subscriptions per churn month."""
    return (churned(subs).groupBy("churn_ym").agg(F.count(F.lit(1)).alias("churned"))
            .orderBy("churn_ym"))


def _churned_with_age(subs: DataFrame, members: DataFrame) -> DataFrame:
    """Churned subscriptions counted per (member, month) and joined to the
    member's age band (inner join, as the question joins the two tables).

    Scale: the per-member pre-aggregate collapses a member with many
    churned subscriptions map-side, so the join moves at most one row per
    member and month."""
    per_member = (churned(subs).groupBy("member_id", "churn_ym")
                  .agg(F.count(F.lit(1)).alias("churned")))
    return per_member.join(members.select("member_id", "age_group"), on="member_id", how="inner")


def churn_by_age_month(subs: DataFrame, members: DataFrame) -> DataFrame:
    """Q16: churned subscriptions per age band and churn month."""
    return (_churned_with_age(subs, members)
            .groupBy("age_group", "churn_ym").agg(F.sum("churned").alias("churned"))
            .orderBy("churn_ym", "age_group"))


def churn_by_age(subs: DataFrame, members: DataFrame) -> DataFrame:
    """Q17: churned subscriptions per age band, most first."""
    return (_churned_with_age(subs, members)
            .groupBy("age_group").agg(F.sum("churned").alias("churned"))
            .orderBy(F.desc("churned"), "age_group"))


def churn_period_shift(subs: DataFrame, members: DataFrame, split_ym: str) -> DataFrame:
    """Q25: per age band, churned before ``split_ym`` and since it."""
    ym = F.col("churn_ym")
    return (
        _churned_with_age(subs, members)
        .groupBy("age_group")
        .agg(
            F.sum(F.when(ym < split_ym, F.col("churned")).otherwise(0)).alias("churned_before"),
            F.sum(F.when(ym >= split_ym, F.col("churned")).otherwise(0)).alias("churned_since"),
        )
        .withColumn("churned_change", F.col("churned_since") - F.col("churned_before"))
        .orderBy("age_group")
    )


def _last_days(activity: DataFrame) -> DataFrame:
    """The last event day per member id, members that are not known and the
    NULL id included. The key is never NULL, so no join adds a filter to it
    and every use of this aggregate plans the same exchange."""
    return activity.groupBy(F.coalesce("member_id", F.lit(0)).alias("of_id"), F.isnull("member_id").alias("of_none")) \
        .agg(F.max("last_event_date").alias("last_event_date"))


def silent_members(members: DataFrame, activity: DataFrame, subs: DataFrame, *,
                   days: int = M.SILENT_DAYS, inclusive: bool = True,
                   exclude_churned: bool = True, include_never_active: bool = False) -> DataFrame:
    """Q18/Q19: paid or premium members whose last event lies ``days`` (or
    more, if ``inclusive``) before the latest log day.

    The latest day is that of all logs, also of members that are not known.
    ``exclude_churned`` drops members with any churned subscription (the
    glossary's definition). Members without any event have no last day and
    drop out unless ``include_never_active``.

    Scale: the latest day is the maximum of the per-member maxima, a scalar
    subquery over the aggregate that the join uses as well: the exchange is
    reused, the activity is read once. The churned set is reduced to
    distinct member ids before the anti join (a hot member collapses
    map-side, and its partitioning is reused by the join)."""
    last = _last_days(activity)
    latest = last.select(F.max("last_event_date")).scalar()
    who = members.where(F.col("plan_type").isin(M.PAID_PLANS)).select("member_id", "plan_type", "age_group")
    seen = who.join(last, (who.member_id == last.of_id) & (F.isnull(who.member_id) == last.of_none), "left")
    return _silent(seen, latest, subs, days, inclusive, exclude_churned, include_never_active)


def silent_from_segment(segment: DataFrame, months: DataFrame, subs: DataFrame, *, days: int = M.SILENT_DAYS, inclusive: bool = True,
                        exclude_churned: bool = True, include_never_active: bool = False) -> DataFrame:
    """:func:`silent_members` from the stored segment mart (Q6), which holds
    each member's plan, band and last day, and the stored months, which hold
    the latest day of all logs: one row per member and one per month are
    read, no logs and no activity."""
    latest = months.select(F.max("last_event_date")).scalar()
    seen = segment.where(F.col("plan_type").isin(M.PAID_PLANS))
    return _silent(seen, latest, subs, days, inclusive, exclude_churned, include_never_active)


def _silent(seen: DataFrame, latest: Column, subs: DataFrame, days: int, inclusive: bool, exclude_churned: bool,
            include_never_active: bool) -> DataFrame:
    idle = F.datediff(latest, F.col("last_event_date"))
    over = idle >= days if inclusive else idle > days
    if include_never_active:
        over = over | F.col("last_event_date").isNull()
    out = seen.where(over)
    if exclude_churned:
        out = out.join(churned(subs).select("member_id").distinct(), "member_id", "left_anti")
    return out.select("member_id", "plan_type", "age_group", "last_event_date",
                      idle.alias("days_since_last_event"))


def silent_member_count(silent: DataFrame) -> DataFrame:
    """Q20: how many silent members."""
    return silent.agg(F.count(F.lit(1)).alias("silent_members"))


def silent_by_age_plan(silent: DataFrame) -> DataFrame:
    """Q21: silent members per age band and plan, most first."""
    return (silent.groupBy("age_group", "plan_type")
            .agg(F.count(F.lit(1)).alias("silent_members"))
            .orderBy(F.desc("silent_members"), "age_group", "plan_type"))

