"""Table metadata: comments on the published tables (P2) and the metric
glossary (P3).

Comments are written with ``COMMENT ON TABLE`` and ``ALTER TABLE ... ALTER
COLUMN ... COMMENT``. A full-refresh overwrite drops them, so the pipeline
applies them again after every write.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from subsight import model as M
from subsight.sources.catalog import LakeConfig

_MONTH = "Calendar month, text yyyy-MM in the session time zone, sorts by time; NULL where the event time did not parse."
_BAND = "Age band label from the member's age; the last band also holds ages that are NULL."
_LABELS = {"plan_type": "One of " + ", ".join(M.PAID_PLANS) + "; for members also " + M.PLAN_FREE + "."}

TABLE_COMMENTS: dict[str, str] = {
    "gold_monthly_engagement":
        "Grain: month x article category, over events of type " + " and ".join([M.READ_START, M.READ_COMPLETE])
        + ". Built from work_member_month_activity.",
    "gold_member_segment":
        "Grain: member, every member of silver_members once. Event sums are 0 for members without events.",
    "gold_paywall_conversion":
        "Grain: month x age band, over events of type " + " and ".join([M.PAYWALL_HIT, M.SUBSCRIBE])
        + ". Members missing from silver_members are the NULL band.",
    "silver_subscriptions":
        "Grain: subscription. Dates parsed from text; text that is no date is NULL.",
}

#: Per column: what a value is, from which columns it comes, and what NULL means.
COLUMN_COMMENTS: dict[str, dict[str, str]] = {
    "gold_monthly_engagement": {
        "ym": _MONTH,
        "category": "category of the log's article; NULL for articles missing from silver_articles.",
        "article_views": "bigint >= 1: number of read events.",
        "reads_completed": f"bigint >= 0: those of type {M.READ_COMPLETE}.",
        "unique_readers": "bigint >= 0: different member_id among the read events, NULL ids not counted.",
        "completion_rate": "Percent with one digit, 100 x reads_completed / article_views.",
    },
    "gold_member_segment": {
        "member_id": "Key.",
        "plan_type": _LABELS["plan_type"],
        "age_group": _BAND,
        "prefecture": "As given with the member; NULL if unknown.",
        "total_events": "bigint >= 0: events of any type.",
        "reads_completed": f"bigint >= 0: events of type {M.READ_COMPLETE}.",
        "paywall_hits": f"bigint >= 0: events of type {M.PAYWALL_HIT}.",
        "conversions": f"bigint >= 0: events of type {M.SUBSCRIBE}.",
        "last_event_date": "Greatest event day; NULL without an event whose time parses.",
        "activity_segment": "Label by total_events: at least "
                            + ", ".join(f"{n} {label}" for n, label in zip(M.ACTIVITY_BOUNDS, M.ACTIVITY_LABELS))
                            + f", else {M.ACTIVITY_LABELS[-1]}.",
    },
    "gold_paywall_conversion": {
        "ym": _MONTH,
        "age_group": _BAND + " NULL for members that are not known.",
        "paywall_hits": f"bigint >= 0: events of type {M.PAYWALL_HIT}.",
        "conversions": f"bigint >= 0: events of type {M.SUBSCRIBE}, in the month they happened.",
        "conversion_rate": "Percent with one digit, 100 x conversions / paywall_hits; NULL when there is no hit.",
    },
    "silver_subscriptions": {
        "subscription_id": "Key.",
        "member_id": "Subscriber; may be missing from silver_members.",
        "plan_type": _LABELS["plan_type"],
        "start_date": "Date from text; NULL if it did not parse.",
        "end_date": "Date from text; NULL while the subscription runs or if it did not parse.",
        "status": f"{M.STATUS_ACTIVE} or {M.STATUS_CHURNED}.",
        "churn_ym": f"Month of end_date, text yyyy-MM, only where status is {M.STATUS_CHURNED}.",
        "tenure_days": "int: days from start_date to end_date; NULL without an end.",
    },
}


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def comment_statements(config: LakeConfig, tables: Iterable[str] | None = None) -> list[str]:
    out = []
    for table in (tables or TABLE_COMMENTS):
        fqn = config.fqn(table)
        out.append(f"COMMENT ON TABLE {fqn} IS {_quote(TABLE_COMMENTS[table])}")
        for col, text in COLUMN_COMMENTS[table].items():
            out.append(f"ALTER TABLE {fqn} ALTER COLUMN {col} COMMENT {_quote(text)}")
    return out


def apply_comments(spark: SparkSession, config: LakeConfig, tables: Iterable[str] | None = None) -> int:
    """Write the table and column comments; returns the statement count."""
    stmts = comment_statements(config, tables)
    for stmt in stmts:
        spark.sql(stmt)
    return len(stmts)


# ---------------------------------------------------------------------------
# Metric glossary. The terms are fixed values: the business names of the
# metrics as used by the analysts.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Metric:
    term: str
    meaning: str
    table: str
    column: str | None
    condition: str | None


GLOSSARY: list[Metric] = [
    Metric("読了率", "completion rate", "gold_monthly_engagement", "completion_rate", None),
    Metric("転換率", "paywall conversion rate", "gold_paywall_conversion", "conversion_rate", None),
    Metric("解約", "churn: a subscription with status churned; month in churn_ym",
           "silver_subscriptions", "churn_ym", "status = 'churned'"),
    Metric("ヘビーリーダー", "heavy reader segment", "gold_member_segment", "activity_segment",
           "activity_segment = 'ヘビーリーダー'"),
    Metric("サイレント離脱",
           "silent churn: paid or premium member without a churned subscription whose last "
           "event is 90 days or more before the latest log day",
           "gold_member_segment", "last_event_date",
           "plan_type IN ('paid', 'premium') AND no churned subscription AND "
           "datediff(latest log day, last_event_date) >= 90"),
    Metric("課金導線の改善ターゲット",
           "paywall improvement target: age bands with many paywall hits and a low conversion rate",
           "gold_paywall_conversion", "conversion_rate",
           "paywall_hits >= mean hits per band AND rate < overall rate"),
]

GLOSSARY_SCHEMA = StructType([
    StructField("term", StringType(), False),
    StructField("meaning", StringType(), False),
    StructField("table", StringType(), False),
    StructField("column", StringType(), True),
    StructField("condition", StringType(), True),
])


def glossary_frame(spark: SparkSession) -> DataFrame:
    """The glossary as a (six-row) DataFrame, e.g. to store next to the marts."""
    rows = [(m.term, m.meaning, m.table, m.column, m.condition) for m in GLOSSARY]
    return spark.createDataFrame(rows, GLOSSARY_SCHEMA)
