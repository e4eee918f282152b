"""Bronze -> silver cleaning transforms (Q1-Q4).

Pure, narrow transforms except Q3, which adds article attributes with a
left join. Dates arrive as text and are parsed with ``try_cast``: empty or
invalid text becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight import model as M
from subsight.functions import band_below, days_between, month_of, parse_date, parse_timestamp


#: Column order of Q3: the join key, the log's own columns, those derived from its time, the article's.
READING_LOG_COLUMNS = ["article_id", *(c for c in M.READING_LOGS_SCHEMA.fieldNames() if c != "article_id"),
                       "event_date", "ym", "category", "is_premium"]


def age_group(age_col="age"):
    """Age band label; NULL age falls into the last band."""
    col = F.col(age_col) if isinstance(age_col, str) else age_col
    return band_below(col, M.AGE_BOUNDS, M.AGE_LABELS)


def silver_members(bronze_members: DataFrame) -> DataFrame:
    """Q1: registration date parsed, ``age_group`` appended."""
    return (
        bronze_members
        .withColumn("registration_date", parse_date("registration_date"))
        .withColumn("age_group", age_group("age"))
    )


def silver_articles(bronze_articles: DataFrame) -> DataFrame:
    """Q2: publish date parsed."""
    return bronze_articles.withColumn("publish_date", parse_date("publish_date"))


def log_events(bronze_logs: DataFrame) -> DataFrame:
    """Logs with their time parsed, day and month, without article attributes:
    what answers that do not use the article need, with no join."""
    return (
        bronze_logs
        .withColumn("event_time", parse_timestamp("event_time"))
        .withColumn("event_date", F.to_date("event_time"))
        .withColumn("ym", month_of("event_time"))
    )


def silver_reading_logs(bronze_logs: DataFrame, articles: DataFrame) -> DataFrame:
    """Q3: event time parsed, day and month added, article category and
    premium flag attached by a left join (unknown articles keep the row with
    NULL attributes; the join key moves to the front).

    Scale: the article dimension is small next to the log, so the planner
    broadcasts it when its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (or AQE sees it small at run
    time); otherwise it falls back to a sort-merge join, whose hot keys AQE
    splits (``spark.sql.adaptive.skewJoin.enabled``). Articles must be unique
    on ``article_id`` or log rows multiply (checked by the tests).
    """
    logs = log_events(bronze_logs)
    attrs = articles.select("article_id", "category", "is_premium")
    return logs.join(attrs, on="article_id", how="left").select(*READING_LOG_COLUMNS)


def silver_subscriptions(bronze_subs: DataFrame) -> DataFrame:
    """Q4: dates parsed; churn month only for churned rows; tenure only when
    an end date exists."""
    return (
        bronze_subs
        .withColumn("start_date", parse_date("start_date"))
        .withColumn("end_date", parse_date("end_date"))
        .withColumn("churn_ym",
                    F.when(F.col("status") == M.STATUS_CHURNED, month_of("end_date")))
        .withColumn("tenure_days",
                    F.when(F.col("end_date").isNotNull(), days_between("end_date", "start_date")))
    )
