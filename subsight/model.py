"""Data model: bronze schemas, value domains and labels.

Bronze tables keep dates and times as text; silver parses them. Ids are
``bigint`` (the source notebooks declare ``int``; ``int`` would cap the number of
log rows at scale).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# These must equal the source notebooks' values for equal results.
# ---------------------------------------------------------------------------

# Age bands: upper bounds (exclusive) and labels; the last label catches
# everything else, NULL ages included.
AGE_BOUNDS = [30, 40, 50, 60]
AGE_LABELS = ["20代以下", "30代", "40代", "50代", "60代以上"]

# Activity segments on total events: lower bounds (inclusive), highest first.
ACTIVITY_BOUNDS = [20, 8, 2]
ACTIVITY_LABELS = ["ヘビーリーダー", "通常", "ライト", "休眠"]

# Event types of the reading log.
READ_START = "read_start"
READ_COMPLETE = "read_complete"
PAYWALL_HIT = "paywall_hit"
SUBSCRIBE = "subscribe"
EVENT_TYPES = [READ_START, READ_COMPLETE, PAYWALL_HIT, SUBSCRIBE]

# Plans and subscription states.
PLAN_FREE = "free"
PLAN_PAID = "paid"
PLAN_PREMIUM = "premium"
PAID_PLANS = [PLAN_PAID, PLAN_PREMIUM]
STATUS_ACTIVE = "active"
STATUS_CHURNED = "churned"

# Silent-churn threshold in days.
SILENT_DAYS = 90

# Month text format.
MONTH_FORMAT = "yyyy-MM"

# ---------------------------------------------------------------------------
# Layers and table names.
# ---------------------------------------------------------------------------

BRONZE_TABLES = ["members", "articles", "reading_logs", "subscriptions"]
SILVER_TABLES = ["silver_members", "silver_articles", "silver_reading_logs", "silver_subscriptions"]
GOLD_TABLES = ["gold_monthly_engagement", "gold_member_segment", "gold_paywall_conversion"]
BILLING_TABLES = ["usage", "list_prices"]
# One row per member, month and category: what all three marts derive from.
ACTIVITY_TABLE = "work_member_month_activity"
# One row per month: its events and last event day. One row per member: the sums, last day and months of its events.
MONTHS_TABLE = "work_log_months"
TOTALS_TABLE = "work_member_totals"
# Per month: sketches of the logs' columns, and of the readers of each category.
SKETCH_TABLE = "work_log_sketches"
READERS_TABLE = "work_reader_sketches"
# Articles of each month's logs with their attributes, and attributes that changed after logs were taken.
ARTICLE_INDEX = "work_month_articles"
OVERRIDES_TABLE = "work_article_overrides"
# Month of the usage day, the partition column of stored usage.
USAGE_MONTH = "usage_ym"

# ---------------------------------------------------------------------------
# Bronze schemas: fixed values (names, types and column order are part of
# the contract). Ids of logs from another source may be text.
# ---------------------------------------------------------------------------

MEMBERS_SCHEMA = StructType([
    StructField("member_id", LongType()),
    StructField("name", StringType()),
    StructField("age", IntegerType()),
    StructField("gender", StringType()),
    StructField("prefecture", StringType()),
    StructField("occupation", StringType()),
    StructField("plan_type", StringType()),
    StructField("registration_date", StringType()),
    StructField("email", StringType()),
])

ARTICLES_SCHEMA = StructType([
    StructField("article_id", LongType()),
    StructField("title", StringType()),
    StructField("category", StringType()),
    StructField("publish_date", StringType()),
    StructField("is_premium", IntegerType()),
])

READING_LOGS_SCHEMA = StructType([
    StructField("log_id", LongType()),
    StructField("member_id", LongType()),
    StructField("article_id", LongType()),
    StructField("event_type", StringType()),
    StructField("event_time", StringType()),
    StructField("device", StringType()),
    StructField("reading_seconds", IntegerType()),
    StructField("scroll_depth", IntegerType()),
])

SUBSCRIPTIONS_SCHEMA = StructType([
    StructField("subscription_id", LongType()),
    StructField("member_id", LongType()),
    StructField("plan_type", StringType()),
    StructField("start_date", StringType()),
    StructField("end_date", StringType()),
    StructField("status", StringType()),
])

BRONZE_SCHEMAS = {
    "members": MEMBERS_SCHEMA,
    "articles": ARTICLES_SCHEMA,
    "reading_logs": READING_LOGS_SCHEMA,
    "subscriptions": SUBSCRIPTIONS_SCHEMA,
}

# Billing inputs: only the paths the cost queries read.
MONEY = DecimalType(18, 6)

USAGE_SCHEMA = StructType([
    StructField("usage_date", DateType()),
    StructField("usage_end_time", TimestampType()),
    StructField("sku_name", StringType()),
    StructField("usage_quantity", MONEY),
    StructField("usage_metadata", StructType([
        StructField("job_id", StringType()),
        StructField("warehouse_id", StringType()),
    ])),
    StructField("identity_metadata", StructType([
        StructField("run_as", StringType()),
    ])),
])

LIST_PRICES_SCHEMA = StructType([
    StructField("sku_name", StringType()),
    StructField("currency_code", StringType()),
    StructField("price_start_time", TimestampType()),
    StructField("price_end_time", TimestampType()),
    StructField("pricing", StructType([
        StructField("effective_list", StructType([
            StructField("default", MONEY),
        ])),
    ])),
])
