"""Paywall conversion and completion shifts (Q22-Q24)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.functions import percent


def conversion_by_age(paywall: DataFrame) -> DataFrame:
    """Q22: per age band over all months: hits, conversions and the rate
    from the sums (never a mean of monthly rates)."""
    return (
        paywall.groupBy("age_group")
        .agg(F.sum("paywall_hits").alias("paywall_hits"), F.sum("conversions").alias("conversions"))
        .withColumn("conversion_rate", percent("conversions", "paywall_hits"))
        .orderBy("age_group")
    )


def paywall_improvement_target(paywall: DataFrame) -> DataFrame:
    """Q23: age bands with at least the mean number of hits per band and a
    conversion rate below the overall rate. The thresholds come from one
    scalar subquery over the (band-sized) aggregate."""
    by_age = (paywall.groupBy("age_group")
              .agg(F.sum("paywall_hits").alias("paywall_hits"),
                   F.sum("conversions").alias("conversions")))
    # both thresholds from one scalar subquery over the band aggregate (the
    # bands partition the rows, so their sums are the overall sums)
    thresholds = by_age.select(F.struct(
        F.avg("paywall_hits").alias("mean_hits"),
        (F.try_divide(F.sum("conversions"), F.sum("paywall_hits")) * 100).alias("overall_rate"),
    )).scalar()
    mean_hits = thresholds.getField("mean_hits")
    overall = thresholds.getField("overall_rate")
    rate = F.try_divide(F.col("conversions"), F.col("paywall_hits")) * 100
    return (
        by_age.filter((F.col("paywall_hits") >= mean_hits) & (rate < overall))
        .withColumn("conversion_rate", percent("conversions", "paywall_hits"))
        .orderBy("conversion_rate", "age_group")
    )


def completion_period_shift(engagement: DataFrame, split_ym: str) -> DataFrame:
    """Q24: per category, completion % before ``split_ym`` and since it,
    and the change in points (of the rounded rates)."""
    before = F.col("ym") < split_ym
    since = F.col("ym") >= split_ym

    def part(cond, col):
        return F.sum(F.when(cond, F.col(col)).otherwise(0))

    return (
        engagement.groupBy("category")
        .agg(
            part(before, "article_views").alias("views_before"),
            part(before, "reads_completed").alias("reads_before"),
            part(since, "article_views").alias("views_since"),
            part(since, "reads_completed").alias("reads_since"),
        )
        .withColumn("completion_before", percent("reads_before", "views_before"))
        .withColumn("completion_since", percent("reads_since", "views_since"))
        # change of the shown rates, so the three columns agree on screen
        .withColumn("completion_change",
                    F.round(F.col("completion_since") - F.col("completion_before"), 1))
        .orderBy("category")
    )
