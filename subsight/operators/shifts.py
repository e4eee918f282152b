"""When a rate turned, and what drove a change (follow-ups of Q22-Q25).

:func:`turning_month` finds the split that explains most, where Q24 and Q25
take it as given; :func:`drivers` parts the change between two periods into
what came from other shares (mix) and from other rates, cell by cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsight import model as M
from subsight.operators import gold


def turning_month(monthly: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """Per group the month since which the rate differs most from before:
    ``group, turning_ym, rate_before, rate_since, gain``.

    ``monthly`` has a row per group and month (``ym``; NULL months are left
    out) with the sums ``value`` and ``weight``; a rate is their quotient.
    Every month but the first is tried as the split: prefix sums by month
    give the sums of both sides, and the gain is the weighted square of the
    difference, w1 w2 / (w1 + w2) (r2 - r1)^2, by which two rates explain the
    months better than one. Ties go to the earliest month. A side without
    weight is no split; groups with no split have no row.

    Scale: the windows run over one row per group and month.
    """
    by_month = Window.partitionBy(group).orderBy("ym").rowsBetween(Window.unboundedPreceding, -1)
    all_months = Window.partitionBy(group)
    sums = monthly.where("ym IS NOT NULL").select(
        group, "ym", F.sum(value).over(by_month).alias("v1"), F.sum(weight).over(by_month).alias("w1"),
        F.sum(value).over(all_months).alias("v"), F.sum(weight).over(all_months).alias("w"))
    sides = sums.select(group, "ym", F.col("w1").cast("double").alias("w1"), (F.col("w") - F.col("w1")).cast("double").alias("w2"),
                        F.try_divide(F.col("v1"), F.col("w1")).alias("r1"), F.try_divide(F.col("v") - F.col("v1"), F.col("w") - F.col("w1")).alias("r2"))
    change = F.col("r2") - F.col("r1")
    tried = sides.where("r1 IS NOT NULL AND r2 IS NOT NULL").withColumn(
        "gain", F.round(F.col("w1") * F.col("w2") / (F.col("w1") + F.col("w2")) * change * change, 6))
    first = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("gain"), "ym"))
    return tried.withColumn("place", first).where("place = 1").select(
        group, F.col("ym").alias("turning_ym"), F.round("r1", 6).alias("rate_before"), F.round("r2", 6).alias("rate_since"), "gain")


def completion_turning_month(engagement: DataFrame) -> DataFrame:
    """The month per category since which completion differs most, weighted by views."""
    return turning_month(engagement, "category", "reads_completed", "article_views")


def churn_turning_month(subs: DataFrame, members: DataFrame) -> DataFrame:
    """The month per age band since which churned subscriptions a month differ
    most. Months without churn count as such, from the first to the last
    month of any band."""
    per = subs.where((F.col("status") == M.STATUS_CHURNED) & F.col("churn_ym").isNotNull()) \
        .groupBy("member_id", F.col("churn_ym").alias("ym")).agg(F.count(F.lit(1)).alias("n")) \
        .join(members.select("member_id", "age_group"), "member_id").groupBy("age_group", "ym").agg(F.sum("n").alias("churned"))
    everywhere = Window.partitionBy(F.lit(0))  # a row per band and month
    day = lambda c: F.to_date(F.concat(c, F.lit("-01")))
    span = per.select("age_group", F.min("ym").over(everywhere).alias("lo"), F.max("ym").over(everywhere).alias("hi")).distinct()
    months = span.select("age_group", F.explode(F.sequence(day(F.col("lo")), day(F.col("hi")), F.expr("INTERVAL 1 MONTH"))).alias("day")) \
        .select("age_group", F.date_format("day", M.MONTH_FORMAT).alias("ym"))
    dense = months.join(per, ["age_group", "ym"], "left").select(
        "age_group", "ym", F.coalesce("churned", F.lit(0).cast("long")).alias("churned"), F.lit(1).cast("long").alias("months"))
    return turning_month(dense, "age_group", "churned", "months")


def drivers(cells: DataFrame, keys: Sequence[str], value: str, weight: str, split_ym: str) -> DataFrame:
    """What each cell added to the change of the overall rate, in points:
    ``keys, weight_before, weight_since, rate_before, rate_since, mix_effect, rate_effect``.

    ``cells`` has sums ``value`` and ``weight`` per cell and ``ym``. With
    shares s and rates r of a cell before and since the split, its mix effect
    is (s2 - s1) (r1 + r2) / 2 and its rate effect (s1 + s2) / 2 (r2 - r1), so
    all effects add up to the overall change, without rest. A cell without
    weight in a period has the other period's rate there: it came or went,
    which is mix. NULL months are left out.

    Scale: one aggregate of the cube; the totals are windows over its cells.
    """
    before, since = F.col("ym") < split_ym, F.col("ym") >= split_ym
    part = lambda cond, c: F.sum(F.when(cond, F.col(c)).otherwise(0))
    cube = cells.where("ym IS NOT NULL").groupBy(*keys).agg(
        part(before, weight).alias("weight_before"), part(since, weight).alias("weight_since"),
        part(before, value).alias("v1"), part(since, value).alias("v2"))
    total = Window.partitionBy(F.lit(0))  # a row per cell
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.sum(c).over(total)), F.lit(0.0))
    own = lambda v, w: F.try_divide(F.col(v), F.col(w))
    rates = cube.select(*keys, "weight_before", "weight_since", share("weight_before").alias("s1"), share("weight_since").alias("s2"),
                        own("v1", "weight_before").alias("rate_before"), own("v2", "weight_since").alias("rate_since"))
    r1, r2 = F.coalesce("rate_before", "rate_since", F.lit(0.0)), F.coalesce("rate_since", "rate_before", F.lit(0.0))
    # an effect that rounds to zero keeps its sign, as in SQL engines that round in binary
    effect = lambda c: F.when(F.round(c, 9) == 0, c * 0.0).otherwise(F.round(c, 9))
    return rates.where("weight_before > 0 OR weight_since > 0").select(
        *keys, "weight_before", "weight_since", F.round(F.col("rate_before") * 100, 6).alias("rate_before"),
        F.round(F.col("rate_since") * 100, 6).alias("rate_since"),
        effect((F.col("s2") - F.col("s1")) * (r1 + r2) / 2 * 100).alias("mix_effect"),
        effect((F.col("s1") + F.col("s2")) / 2 * (r2 - r1) * 100).alias("rate_effect"))


def _of_members(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` with age band and plan of their member; members that are not known have NULLs."""
    return rows.join(members.select("member_id", "age_group", "plan_type"), "member_id", "left")


def completion_drivers(activity: DataFrame, members: DataFrame, split_ym: str) -> DataFrame:
    """:func:`drivers` of the completion rate over age band x plan x category; members that are not known have NULLs.

    ``activity`` is the activity or the logs themselves.

    Scale: the members are joined first and the rows are summed per cell and
    month, so no task holds a group per member. Members too large for a
    broadcast are joined by a sort-merge join, whose sorts spill and whose
    hot members AQE splits."""
    keys, known = ["age_group", "plan_type", "category"], _of_members(activity, members)
    read = gold.reading_activity(known, [*keys, "ym"]) if "event_type" in activity.columns else known.where("views > 0")
    return drivers(read, keys, "reads", "views", split_ym)


def conversion_drivers(activity: DataFrame, members: DataFrame, split_ym: str) -> DataFrame:
    """:func:`drivers` of the paywall conversion rate over age band x plan; months with conversions only have no hits to weigh.

    ``activity`` and scale as in :func:`completion_drivers`."""
    keys, known = ["age_group", "plan_type"], _of_members(activity, members)
    met = gold.paywall_activity(known, [*keys, "ym"]) if "event_type" in activity.columns else known.where("hits > 0 OR subscribes > 0")
    return drivers(met, keys, "subscribes", "hits", split_ym)
