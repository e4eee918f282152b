"""Marts that follow their months: a refresh reads the months that changed and what the changed members need.

The activity of the changed months is computed from their logs and staged;
the difference to the stored activity of the same months, per member, is the
delta. With it

* the members' totals change by the difference of their sums; a greatest day
  that fell is looked up in the member's latest other month, which the totals
  name, and nowhere else;
* the engagement and paywall marts replace the rows of those months;
* the segment mart is the members joined to their totals.

Members whose age band changed since the marts were written (told by the
segment mart, which holds the bands of its time) move between the bands of
the paywall mart in all their months, which the totals name as well: those
months are replaced too.

A refresh is a chain of table replacements. Its id is kept with the activity
table until the last one is done, and with the totals from the one that took
the delta in, so a run that was killed anywhere is finished by the next:
every step after the staging may be repeated, and the delta is never taken
in twice.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight.functions import month_of
from subsight.model import ACTIVITY_TABLE, ARTICLE_INDEX, MONTHS_TABLE, READERS_TABLE, SKETCH_TABLE, TOTALS_TABLE
from subsight.operators import gold, sketches
from subsight.plans import articles
from subsight.sources.bronze import replace_partitions, write_table
from subsight.sources.catalog import LakeConfig, read_table, set_table_property, table_exists, table_property

STAGE, DELTA = "work_refresh_activity", "work_refresh_members"
PENDING_KEY, APPLIED_KEY = "subsight.pending_refresh", "subsight.applied_refresh"
SUMS = list(gold.SEGMENT_SUMS.values())


def in_months(months: list[str]) -> Column:
    """Rows of ``months``, and those without a month: any file may bring logs whose time does not parse."""
    return F.col("ym").isin(list(months)) | F.col("ym").isNull()


def member_deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per member whose activity in the refreshed months changed: the
    differences of its sums, its last day and its months there now."""
    before = gold.member_totals(old).select("member_id", *[F.col(c).alias(f"old_{c}") for c in SUMS], F.col("last_event_date").alias("old_last"),
                             F.col("months").alias("old_months"))
    now = gold.member_totals(new).select("member_id", *SUMS, F.col("last_event_date").alias("new_last"), F.col("months").alias("new_months"))
    both = before.join(now, "member_id", "full")
    change = {c: F.coalesce(c, F.lit(0).cast("long")) - F.coalesce(f"old_{c}", F.lit(0).cast("long")) for c in SUMS}
    same = F.col("old_last").eqNullSafe(F.col("new_last")) & F.col("old_months").eqNullSafe(F.col("new_months"))
    changed = both.select("member_id", *[v.alias(f"d_{c}") for c, v in change.items()], "new_last",
                          F.coalesce("new_months", F.array().cast("array<string>")).alias("new_months"), same.alias("same"))
    moved = F.greatest(*[F.abs(F.col(f"d_{c}")) for c in SUMS]) > 0
    return changed.where(~F.col("same") | moved).drop("same")


def changed_totals(totals: DataFrame, delta: DataFrame, activity: DataFrame, months: list[str]) -> DataFrame:
    """``totals`` after ``delta`` of ``months``.

    A member's last day stays if it lies in another month; else it is that
    of the refreshed months, unless the member's latest other month is later:
    then it is read from that month's activity, for those members only.
    Members without events are left out.
    """
    listed = F.array(*[F.lit(m) for m in months]).cast("array<string>")
    both = totals.join(delta, "member_id", "full").withColumn("others", F.array_except(F.coalesce("months", F.array().cast("array<string>")), listed))
    stays = F.col("last_event_date").isNotNull() & ~F.coalesce(month_of("last_event_date").isin(list(months)), F.lit(False))
    touched = F.col("new_months").isNotNull()
    latest = F.array_max("others")
    fallen = touched & ~stays & latest.isNotNull() & (F.col("new_last").isNull() | (month_of("new_last") < latest))
    marked = both.select("*", touched.alias("touched"), stays.alias("stays"), F.when(fallen, latest).alias("look_up"))
    lost = marked.where("look_up IS NOT NULL").select(F.col("member_id").alias("of_id"), F.col("look_up").alias("of_ym"))
    needed = sorted(r[0] for r in lost.select("of_ym").distinct().collect())  # months, at most all there are
    if needed:
        days = activity.where(F.col("ym").isin(needed)).join(lost, (F.col("member_id") == F.col("of_id")) & (F.col("ym") == F.col("of_ym"))) \
            .groupBy(F.col("of_id").alias("member_id")).agg(F.max("last_event_date").alias("looked_up"))
        marked = marked.join(days, "member_id", "left")
    else:
        marked = marked.withColumn("looked_up", F.lit(None).cast("date"))
    last = F.when(~F.col("touched"), F.col("last_event_date")).otherwise(
        F.greatest(F.when(F.col("stays"), F.col("last_event_date")), "new_last", "looked_up"))
    kept = F.when(~F.col("touched"), F.col("months")).otherwise(F.sort_array(F.array_union("others", "new_months")))
    out = marked.select("member_id", *[(F.coalesce(c, F.lit(0).cast("long")) + F.coalesce(f"d_{c}", F.lit(0).cast("long"))).alias(c) for c in SUMS],
                        last.alias("last_event_date"), kept.alias("months"))
    return out.where("events > 0")


def _moved_bands(segment: DataFrame, members: DataFrame, totals: DataFrame) -> list[str]:
    """Months with events of members whose band is another than when the marts were written."""
    was = segment.select("member_id", F.struct("age_group").alias("was"))
    now = members.select("member_id", F.struct("age_group").alias("now"))
    moved = was.join(now, "member_id", "full").where("NOT was <=> now").select("member_id")
    if moved.isEmpty():
        return []
    months = totals.join(moved, "member_id", "left_semi").select(F.explode("months").alias("ym")).distinct()
    return sorted(r[0] for r in months.collect())


def _replaced(mart: DataFrame, new: DataFrame, months: list[str]) -> DataFrame:
    """``mart`` with the rows of ``months`` (and of no month) taken from ``new``; marts are as small as their months."""
    return mart.where(~F.coalesce(in_months(months), F.lit(True))).unionByName(new)


def stage(spark: SparkSession, config: LakeConfig, months: list[str]) -> str:
    """Writes the new activity of ``months`` and the delta of their members, and marks the refresh as pending."""
    logs = articles.current_logs(spark, config).where(in_months(months))
    write_table(gold.member_month_activity(logs), config, STAGE, partition_by=["ym"])
    old = read_table(spark, config, ACTIVITY_TABLE).where(in_months(months))
    write_table(member_deltas(old, read_table(spark, config, STAGE)), config, DELTA)
    run = uuid.uuid4().hex
    set_table_property(spark, config, ACTIVITY_TABLE, PENDING_KEY, json.dumps({"id": run, "months": list(months)}).replace('"', "`"))
    return run


def pending(spark: SparkSession, config: LakeConfig) -> tuple[str, list[str]] | None:
    """Id and months of a staged refresh that is not finished."""
    text = table_property(spark, config, ACTIVITY_TABLE, PENDING_KEY)
    if not text:
        return None
    found = json.loads(text.replace("`", '"'))
    return found["id"], found["months"]


def write_sketches(spark: SparkSession, config: LakeConfig, months: list[str] | None = None) -> dict[str, int]:
    """The sketches of all months, or anew those of ``months`` where the tables exist: other months are not read."""
    counts = {}
    for table, source, make in ((SKETCH_TABLE, "", lambda df: sketches.log_sketches(df, by=["ym"])),
                                (READERS_TABLE, ACTIVITY_TABLE, sketches.reader_sketches)):
        rows = articles.current_logs(spark, config) if table == SKETCH_TABLE else read_table(spark, config, source)
        if months is None:
            counts[table] = write_table(make(rows), config, table, partition_by=["ym"])
        elif table_exists(spark, config, table):
            some = rows.where(in_months(months))
            here = {r[0] for r in (some if table == SKETCH_TABLE else some.where("views > 0")).select("ym").distinct().collect()}
            counts[table] = replace_partitions(make(some), config, table, ["ym"], emptied=[m for m in [None, *months] if m not in here])
    return counts


def apply(spark: SparkSession, config: LakeConfig, run: str, months: list[str]) -> dict[str, int]:
    """Takes a staged refresh in; each step may have been done before."""
    counts = {}
    if table_property(spark, config, TOTALS_TABLE, APPLIED_KEY) != run:
        totals = changed_totals(read_table(spark, config, TOTALS_TABLE), read_table(spark, config, DELTA),
                                read_table(spark, config, ACTIVITY_TABLE), months)
        counts[TOTALS_TABLE] = write_table(totals, config, TOTALS_TABLE, properties={APPLIED_KEY: run})
    staged = read_table(spark, config, STAGE)
    here = {r[0] for r in staged.select("ym").distinct().collect()}
    counts[ACTIVITY_TABLE] = replace_partitions(staged, config, ACTIVITY_TABLE, ["ym"],
                                                emptied=[m for m in [None, *months] if m not in here])
    activity = read_table(spark, config, ACTIVITY_TABLE)
    members = read_table(spark, config, "silver_members")
    some = activity.where(in_months(months))
    of_months = _replaced(read_table(spark, config, MONTHS_TABLE), gold.log_months(some), months)
    write_table(of_months, config, MONTHS_TABLE)
    engagement = _replaced(read_table(spark, config, "gold_monthly_engagement"), gold.monthly_engagement(some), months)
    counts["gold_monthly_engagement"] = write_table(engagement, config, "gold_monthly_engagement")
    totals = read_table(spark, config, TOTALS_TABLE)
    also = sorted({*months, *_moved_bands(read_table(spark, config, "gold_member_segment"), members, totals)})
    paywall = _replaced(read_table(spark, config, "gold_paywall_conversion"),
                        gold.paywall_conversion(activity.where(in_months(also)), members), also)
    counts["gold_paywall_conversion"] = write_table(paywall, config, "gold_paywall_conversion")
    counts["gold_member_segment"] = write_table(gold.member_segment(members, totals), config, "gold_member_segment")
    counts.update(write_sketches(spark, config, months))
    if table_exists(spark, config, ARTICLE_INDEX):  # last: until then the next propagation finds the same months
        articles.write_index(spark, config, articles.current_logs(spark, config).where(in_months(months)), months)
    spark.sql(f"ALTER TABLE {config.fqn(ACTIVITY_TABLE)} UNSET TBLPROPERTIES IF EXISTS ('{PENDING_KEY}')")
    return counts
