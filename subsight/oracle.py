"""Independent SQL of every registered query, for DuckDB.

The driver registers the test tables as views; ``MODEL`` rebuilds the model
(bronze, silver, gold, billing) on them as CTEs, written from the rules of
the model rather than from the Spark code, and each query adds its final
SELECT. Types are cast to what Spark produces (bigint counts, double
rates, int day counts).
"""

from __future__ import annotations

from subsight.plans.registry import TEST_PARAMS as P

AGE_BAND = """CASE WHEN age < 30 THEN '20代以下' WHEN age < 40 THEN '30代'
            WHEN age < 50 THEN '40代' WHEN age < 60 THEN '50代' ELSE '60代以上' END"""

ACTIVITY_BAND = """CASE WHEN total_events >= 20 THEN 'ヘビーリーダー' WHEN total_events >= 8 THEN '通常'
            WHEN total_events >= 2 THEN 'ライト' ELSE '休眠' END"""

MODEL = f"""
WITH bronze_members AS (
    SELECT c.c_custkey AS member_id,
           c.c_name AS name,
           CAST(18 + c.c_custkey % 53 AS INTEGER) AS age,
           CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           n.n_name AS prefecture,
           lower(c.c_mktsegment) AS occupation,
           CASE c.c_mktsegment WHEN 'FURNITURE' THEN 'paid' WHEN 'MACHINERY' THEN 'premium'
                ELSE 'free' END AS plan_type,
           CASE WHEN c.c_custkey % 97 = 0 THEN ''
                ELSE strftime(DATE '2015-01-01' + CAST(c.c_custkey % 3000 AS INTEGER), '%Y-%m-%d')
           END AS registration_date,
           'member' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
bronze_articles AS (
    SELECT p_partkey AS article_id, p_name AS title, p_type AS category,
           strftime(DATE '1994-01-01' + CAST(p_partkey % 2500 AS INTEGER), '%Y-%m-%d') AS publish_date,
           CAST(p_size % 2 AS INTEGER) AS is_premium
    FROM part
),
bronze_reading_logs AS (
    SELECT md5(concat_ws('|', CAST(l.l_orderkey AS VARCHAR),
                CAST(l.l_linenumber AS VARCHAR), CAST(l.l_partkey AS VARCHAR),
                CAST(l.l_suppkey AS VARCHAR), strftime(l.l_shipdate, '%Y-%m-%d'))) AS log_id,
           CASE WHEN l.l_orderkey % 37 = 5 THEN -o.o_custkey
                WHEN o.o_custkey % 11 = 3 THEN o.o_custkey + 1
                WHEN o.o_custkey % 11 = 5 AND l.l_orderkey % 16 <> 0 THEN o.o_custkey + 1
                WHEN o.o_custkey % 11 = 7 AND l.l_orderkey % 3 <> 0 THEN o.o_custkey + 1
                ELSE o.o_custkey END AS member_id,
           CASE WHEN l.l_orderkey % 53 = 7 THEN -l.l_partkey ELSE l.l_partkey END AS article_id,
           CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_orderkey % 37 <> 5 THEN 'paywall_hit'
                WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN 'subscribe'
                WHEN l.l_linestatus = 'F' THEN 'read_complete'
                ELSE 'read_start' END AS event_type,
           CASE WHEN l.l_orderkey % 41 = 3 THEN ''
                ELSE strftime(l.l_shipdate + to_minutes(CAST(l.l_linenumber * 137 + l.l_orderkey % 60 AS BIGINT)),
                              '%Y-%m-%d %H:%M:%S') END AS event_time,
           CASE WHEN l.l_linenumber % 2 = 0 THEN 'app' ELSE 'web' END AS device,
           CAST(l.l_quantity AS INTEGER) * 10 AS reading_seconds,
           CAST((l.l_linenumber * 13 + l.l_partkey) % 101 AS INTEGER) AS scroll_depth
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
bronze_subscriptions AS (
    SELECT o_orderkey AS subscription_id,
           o_custkey AS member_id,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'premium' ELSE 'paid' END AS plan_type,
           strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS start_date,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 101 <> 9
                THEN strftime(CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 571 AS INTEGER), '%Y-%m-%d')
                ELSE '' END AS end_date,
           CASE WHEN o_orderstatus = 'F' THEN 'churned' ELSE 'active' END AS status
    FROM orders
),
silver_members AS (
    SELECT member_id, name, age, gender, prefecture, occupation, plan_type,
           TRY_CAST(registration_date AS DATE) AS registration_date, email,
           {AGE_BAND} AS age_group
    FROM bronze_members
),
silver_articles AS (
    SELECT article_id, title, category, TRY_CAST(publish_date AS DATE) AS publish_date, is_premium
    FROM bronze_articles
),
parsed_logs AS (
    SELECT log_id, member_id, article_id, event_type,
           TRY_CAST(event_time AS TIMESTAMP) AS event_time, device, reading_seconds, scroll_depth
    FROM bronze_reading_logs
),
silver_reading_logs AS (
    SELECT l.article_id, l.log_id, l.member_id, l.event_type, l.event_time, l.device,
           l.reading_seconds, l.scroll_depth,
           CAST(l.event_time AS DATE) AS event_date,
           strftime(l.event_time, '%Y-%m') AS ym,
           a.category, a.is_premium
    FROM parsed_logs l LEFT JOIN silver_articles a ON l.article_id = a.article_id
),
parsed_subs AS (
    SELECT subscription_id, member_id, plan_type,
           TRY_CAST(start_date AS DATE) AS start_date, TRY_CAST(end_date AS DATE) AS end_date, status
    FROM bronze_subscriptions
),
silver_subscriptions AS (
    SELECT subscription_id, member_id, plan_type, start_date, end_date, status,
           CASE WHEN status = 'churned' THEN strftime(end_date, '%Y-%m') END AS churn_ym,
           CASE WHEN end_date IS NOT NULL THEN CAST(date_diff('day', start_date, end_date) AS INTEGER) END
               AS tenure_days
    FROM parsed_subs
),
gold_monthly_engagement AS (
    SELECT ym, category,
           COUNT(*) AS article_views,
           CAST(SUM(CASE WHEN event_type = 'read_complete' THEN 1 ELSE 0 END) AS BIGINT) AS reads_completed,
           COUNT(DISTINCT member_id) AS unique_readers,
           ROUND(CAST(SUM(CASE WHEN event_type = 'read_complete' THEN 1 ELSE 0 END) AS DOUBLE)
                 / NULLIF(COUNT(*), 0) * 100, 1) AS completion_rate
    FROM silver_reading_logs
    WHERE event_type IN ('read_start', 'read_complete')
    GROUP BY ym, category
),
per_member AS (
    SELECT member_id,
           COUNT(*) AS total_events,
           CAST(SUM(CASE WHEN event_type = 'read_complete' THEN 1 ELSE 0 END) AS BIGINT) AS reads_completed,
           CAST(SUM(CASE WHEN event_type = 'paywall_hit' THEN 1 ELSE 0 END) AS BIGINT) AS paywall_hits,
           CAST(SUM(CASE WHEN event_type = 'subscribe' THEN 1 ELSE 0 END) AS BIGINT) AS conversions,
           MAX(event_date) AS last_event_date
    FROM silver_reading_logs GROUP BY member_id
),
segment_counts AS (
    SELECT m.member_id, m.plan_type, m.age_group, m.prefecture,
           COALESCE(p.total_events, 0) AS total_events,
           COALESCE(p.reads_completed, 0) AS reads_completed,
           COALESCE(p.paywall_hits, 0) AS paywall_hits,
           COALESCE(p.conversions, 0) AS conversions,
           p.last_event_date
    FROM silver_members m LEFT JOIN per_member p ON m.member_id = p.member_id
),
gold_member_segment AS (
    SELECT member_id, plan_type, age_group, prefecture, total_events, reads_completed,
           paywall_hits, conversions, last_event_date,
           {ACTIVITY_BAND} AS activity_segment
    FROM segment_counts
),
paywall_sums AS (
    SELECT l.ym, m.age_group,
           CAST(SUM(CASE WHEN l.event_type = 'paywall_hit' THEN 1 ELSE 0 END) AS BIGINT) AS paywall_hits,
           CAST(SUM(CASE WHEN l.event_type = 'subscribe' THEN 1 ELSE 0 END) AS BIGINT) AS conversions
    FROM silver_reading_logs l LEFT JOIN silver_members m ON l.member_id = m.member_id
    WHERE l.event_type IN ('paywall_hit', 'subscribe')
    GROUP BY l.ym, m.age_group
),
gold_paywall_conversion AS (
    SELECT ym, age_group, paywall_hits, conversions,
           ROUND(CAST(conversions AS DOUBLE) / NULLIF(paywall_hits, 0) * 100, 1) AS conversion_rate
    FROM paywall_sums
),
latest AS (SELECT MAX(event_date) AS latest_date FROM silver_reading_logs),
silent_glossary AS (
    SELECT s.member_id, s.plan_type, s.age_group, s.last_event_date,
           CAST(date_diff('day', s.last_event_date, (SELECT latest_date FROM latest)) AS INTEGER)
               AS days_since_last_event
    FROM gold_member_segment s
    WHERE s.plan_type IN ('paid', 'premium')
      AND date_diff('day', s.last_event_date, (SELECT latest_date FROM latest)) >= {P['silent_days']}
      AND NOT EXISTS (SELECT 1 FROM silver_subscriptions c
                      WHERE c.member_id = s.member_id AND c.status = 'churned')
),
usage AS (
    SELECT CAST(l_shipdate AS DATE) AS usage_date,
           CAST(l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS TIMESTAMP) AS usage_end_time,
           'SKU_' || l_returnflag || l_linestatus AS sku_name,
           CAST(l_quantity AS DECIMAL(18, 6)) AS usage_quantity,
           struct_pack(job_id := CAST(l_partkey % 20 AS VARCHAR),
                       warehouse_id := CAST(l_linenumber AS VARCHAR)) AS usage_metadata,
           struct_pack(run_as := 'user' || CAST(l_suppkey % 4 AS VARCHAR) || '@example.com') AS identity_metadata
    FROM lineitem
),
sku_span AS (
    SELECT sku_name, MIN(usage_date) AS lo, MAX(usage_date) AS hi,
           CAST(CAST(10 + ascii(substr(sku_name, 5, 1)) % 7 + ascii(substr(sku_name, 6, 1)) % 3
                     AS DECIMAL(18, 6)) / 100 AS DECIMAL(18, 6)) AS first_price
    FROM usage WHERE sku_name <> 'SKU_RO' GROUP BY sku_name
),
list_prices AS (
    SELECT sku_name, 'USD' AS currency_code, CAST(lo AS TIMESTAMP) AS price_start_time,
           CAST(lo + CAST(date_diff('day', lo, hi) // 2 AS INTEGER) AS TIMESTAMP) AS price_end_time,
           struct_pack(effective_list := struct_pack("default" := first_price)) AS pricing
    FROM sku_span
    UNION ALL
    SELECT sku_name, 'USD', CAST(lo + CAST(date_diff('day', lo, hi) // 2 AS INTEGER) AS TIMESTAMP),
           CAST(hi - 10 AS TIMESTAMP),
           struct_pack(effective_list := struct_pack(
               "default" := CAST(first_price * CAST(1.25 AS DECIMAL(18, 6)) AS DECIMAL(18, 6))))
    FROM sku_span
    UNION ALL
    SELECT sku_name, 'USD', CAST(hi - 10 AS TIMESTAMP), CAST(NULL AS TIMESTAMP),
           struct_pack(effective_list := struct_pack(
               "default" := CAST(first_price * CAST(1.5 AS DECIMAL(18, 6)) AS DECIMAL(18, 6))))
    FROM sku_span
),
usage_30 AS (
    SELECT * FROM usage
    WHERE usage_date >= (SELECT MAX(usage_date) FROM usage) - INTERVAL {P['usage_days']} DAY
),
priced_30 AS (
    SELECT u.usage_date, u.sku_name, u.usage_quantity, u.usage_metadata.job_id AS job_id,
           lp.currency_code, lp.pricing.effective_list."default" AS unit_price
    FROM usage_30 u JOIN list_prices lp
      ON u.sku_name = lp.sku_name
     AND u.usage_end_time >= lp.price_start_time
     AND (u.usage_end_time < lp.price_end_time OR lp.price_end_time IS NULL)
)
"""

SPLIT = P["split_ym"]

FINAL: dict[str, str] = {
    "silver_members": "SELECT * FROM silver_members",
    "silver_articles": "SELECT * FROM silver_articles",
    "silver_reading_logs": "SELECT * FROM silver_reading_logs",
    "silver_subscriptions": "SELECT * FROM silver_subscriptions",
    "gold_monthly_engagement": "SELECT * FROM gold_monthly_engagement",
    "gold_member_segment": "SELECT * FROM gold_member_segment",
    "gold_paywall_conversion": "SELECT * FROM gold_paywall_conversion",
    "preview_rows": f"""
        SELECT member_id, article_id, event_type, log_id FROM bronze_reading_logs
        ORDER BY member_id, log_id LIMIT {P['preview_rows']}""",
    "reads_by_member": """
        SELECT member_id, COUNT(*) AS reads_completed
        FROM bronze_reading_logs WHERE event_type = 'read_complete'
        GROUP BY member_id ORDER BY reads_completed DESC, member_id""",
    "reads_by_member_named": """
        SELECT m.member_id, m.name, m.plan_type, COUNT(*) AS reads_completed
        FROM bronze_reading_logs r JOIN bronze_members m ON r.member_id = m.member_id
        WHERE r.event_type = 'read_complete'
        GROUP BY m.member_id, m.name, m.plan_type
        ORDER BY reads_completed DESC, m.member_id""",
    "members_by_plan": """
        SELECT plan_type, COUNT(*) AS members FROM bronze_members
        GROUP BY plan_type ORDER BY members DESC, plan_type""",
    "events_by_type": """
        SELECT event_type, COUNT(*) AS cnt FROM bronze_reading_logs
        GROUP BY event_type ORDER BY cnt DESC, event_type""",
    "monthly_views_reads": """
        SELECT strftime(TRY_CAST(event_time AS TIMESTAMP), '%Y-%m') AS ym,
               COUNT(*) AS article_views,
               CAST(SUM(CASE WHEN event_type = 'read_complete' THEN 1 ELSE 0 END) AS BIGINT) AS reads_completed
        FROM bronze_reading_logs
        WHERE event_type IN ('read_start', 'read_complete')
        GROUP BY 1 ORDER BY 1""",
    "category_monthly_completion": f"""
        SELECT ym, category, article_views, reads_completed, completion_rate
        FROM gold_monthly_engagement WHERE category = '{P['category']}' ORDER BY ym""",
    "churn_by_month": """
        SELECT churn_ym, COUNT(*) AS churned FROM silver_subscriptions
        WHERE status = 'churned' GROUP BY churn_ym ORDER BY churn_ym""",
    "churn_by_age_month": """
        SELECT m.age_group, s.churn_ym, COUNT(*) AS churned
        FROM silver_subscriptions s JOIN silver_members m ON s.member_id = m.member_id
        WHERE s.status = 'churned'
        GROUP BY m.age_group, s.churn_ym ORDER BY s.churn_ym, m.age_group""",
    "churn_by_age": """
        SELECT m.age_group, COUNT(*) AS churned
        FROM silver_subscriptions s JOIN silver_members m ON s.member_id = m.member_id
        WHERE s.status = 'churned'
        GROUP BY m.age_group ORDER BY churned DESC, m.age_group""",
    "silent_members_strict": f"""
        SELECT s.member_id, s.plan_type, s.age_group, s.last_event_date,
               CAST(date_diff('day', s.last_event_date, (SELECT latest_date FROM latest)) AS INTEGER)
                   AS days_since_last_event
        FROM gold_member_segment s
        WHERE s.plan_type IN ('paid', 'premium')
          AND date_diff('day', s.last_event_date, (SELECT latest_date FROM latest)) > {P['silent_days']}""",
    "silent_members": "SELECT * FROM silent_glossary",
    "silent_member_count": "SELECT COUNT(*) AS silent_members FROM silent_glossary",
    "silent_by_age_plan": """
        SELECT age_group, plan_type, COUNT(*) AS silent_members FROM silent_glossary
        GROUP BY age_group, plan_type ORDER BY silent_members DESC, age_group, plan_type""",
    "conversion_by_age": """
        SELECT age_group, CAST(SUM(paywall_hits) AS BIGINT) AS paywall_hits,
               CAST(SUM(conversions) AS BIGINT) AS conversions,
               ROUND(CAST(SUM(conversions) AS DOUBLE) / NULLIF(SUM(paywall_hits), 0) * 100, 1)
                   AS conversion_rate
        FROM gold_paywall_conversion GROUP BY age_group ORDER BY age_group""",
    "paywall_improvement_target": """
        , by_age AS (
            SELECT age_group, CAST(SUM(paywall_hits) AS BIGINT) AS paywall_hits,
                   CAST(SUM(conversions) AS BIGINT) AS conversions
            FROM gold_paywall_conversion GROUP BY age_group)
        SELECT age_group, paywall_hits, conversions,
               ROUND(CAST(conversions AS DOUBLE) / NULLIF(paywall_hits, 0) * 100, 1) AS conversion_rate
        FROM by_age
        WHERE paywall_hits >= (SELECT AVG(paywall_hits) FROM by_age)
          AND CAST(conversions AS DOUBLE) / NULLIF(paywall_hits, 0) * 100
              < (SELECT CAST(SUM(conversions) AS DOUBLE) / NULLIF(SUM(paywall_hits), 0) * 100
                 FROM gold_paywall_conversion)
        ORDER BY conversion_rate, age_group""",
    "completion_period_shift": f"""
        , halves AS (
            SELECT category,
                   CAST(SUM(CASE WHEN ym < '{SPLIT}' THEN article_views ELSE 0 END) AS BIGINT) AS views_before,
                   CAST(SUM(CASE WHEN ym < '{SPLIT}' THEN reads_completed ELSE 0 END) AS BIGINT) AS reads_before,
                   CAST(SUM(CASE WHEN ym >= '{SPLIT}' THEN article_views ELSE 0 END) AS BIGINT) AS views_since,
                   CAST(SUM(CASE WHEN ym >= '{SPLIT}' THEN reads_completed ELSE 0 END) AS BIGINT) AS reads_since
            FROM gold_monthly_engagement GROUP BY category)
        , rates AS (
            SELECT *,
                   ROUND(CAST(reads_before AS DOUBLE) / NULLIF(views_before, 0) * 100, 1) AS completion_before,
                   ROUND(CAST(reads_since AS DOUBLE) / NULLIF(views_since, 0) * 100, 1) AS completion_since
            FROM halves)
        SELECT category, views_before, reads_before, views_since, reads_since,
               completion_before, completion_since,
               ROUND(completion_since - completion_before, 1) AS completion_change
        FROM rates ORDER BY category""",
    "churn_period_shift": f"""
        , by_age AS (
            SELECT m.age_group,
                   CAST(SUM(CASE WHEN s.churn_ym < '{SPLIT}' THEN 1 ELSE 0 END) AS BIGINT) AS churned_before,
                   CAST(SUM(CASE WHEN s.churn_ym >= '{SPLIT}' THEN 1 ELSE 0 END) AS BIGINT) AS churned_since
            FROM silver_subscriptions s JOIN silver_members m ON s.member_id = m.member_id
            WHERE s.status = 'churned' GROUP BY m.age_group)
        SELECT age_group, churned_before, churned_since, churned_since - churned_before AS churned_change
        FROM by_age ORDER BY age_group""",
    "daily_usage": """
        SELECT usage_date, CAST(ROUND(SUM(usage_quantity), 2) AS DOUBLE) AS dbus
        FROM usage_30 GROUP BY usage_date ORDER BY usage_date""",
    "usage_by_sku": """
        SELECT sku_name, CAST(ROUND(SUM(usage_quantity), 2) AS DOUBLE) AS dbus
        FROM usage_30 GROUP BY sku_name ORDER BY dbus DESC, sku_name""",
    "estimated_cost_by_sku": """
        SELECT sku_name,
               CAST(ROUND(SUM(usage_quantity), 2) AS DOUBLE) AS dbus,
               CAST(ROUND(SUM(usage_quantity * unit_price), 2) AS DOUBLE) AS estimated_cost,
               MAX(currency_code) AS currency
        FROM priced_30 GROUP BY sku_name ORDER BY estimated_cost DESC, sku_name""",
    "my_usage_by_job": f"""
        SELECT usage_date, usage_metadata.job_id AS job_id, usage_metadata.warehouse_id AS warehouse_id,
               CAST(ROUND(SUM(usage_quantity), 2) AS DOUBLE) AS dbus
        FROM usage_30
        WHERE identity_metadata.run_as = '{P['user']}'
        GROUP BY ALL
        ORDER BY usage_date DESC, dbus DESC, job_id, warehouse_id
        LIMIT {P['top_k']}""",
    "top_sku_recent": f"""
        SELECT sku_name, CAST(ROUND(SUM(usage_quantity), 2) AS DOUBLE) AS dbus
        FROM usage
        WHERE usage_date >= (SELECT MAX(usage_date) FROM usage) - INTERVAL {P['recent_days']} DAY
        GROUP BY sku_name ORDER BY dbus DESC, sku_name LIMIT 1""",
    "estimated_cost_by_job": """
        SELECT job_id,
               CAST(ROUND(SUM(usage_quantity), 2) AS DOUBLE) AS dbus,
               CAST(ROUND(SUM(usage_quantity * unit_price), 2) AS DOUBLE) AS estimated_cost,
               MAX(currency_code) AS currency
        FROM priced_30 GROUP BY job_id ORDER BY estimated_cost DESC, job_id""",
}

# Column lists with Spark's type names, for the profiles.
_PROFILE_COLUMNS = {
    "silver_reading_logs": [
        ("article_id", "bigint"), ("log_id", "string"), ("member_id", "bigint"),
        ("event_type", "string"), ("event_time", "timestamp"), ("device", "string"),
        ("reading_seconds", "int"), ("scroll_depth", "int"), ("event_date", "date"),
        ("ym", "string"), ("category", "string"), ("is_premium", "int"),
    ],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
                  ("source", "string"), ("n_chars", "bigint")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "region": [("r_regionkey", "int"), ("r_name", "string")],
}


def _profile_sql(table: str) -> str:
    parts = []
    for pos, (col, dtype) in enumerate(_PROFILE_COLUMNS[table], start=1):
        parts.append(f"""
        SELECT '{col}' AS column_name, {pos} AS position, '{dtype}' AS data_type,
               COUNT(*) AS row_count,
               COUNT(*) - COUNT("{col}") AS null_count,
               ROUND(CAST(COUNT(*) - COUNT("{col}") AS DOUBLE) / NULLIF(COUNT(*), 0) * 100, 1) AS null_pct,
               COUNT(DISTINCT "{col}") AS distinct_count,
               CAST(MIN("{col}") AS VARCHAR) AS min_value,
               CAST(MAX("{col}") AS VARCHAR) AS max_value
        FROM {table}""")
    return "\nUNION ALL".join(parts)


FINAL["table_profile"] = _profile_sql("silver_reading_logs")
FINAL["events_by_type_events"] = """
        SELECT event_type, COUNT(*) AS cnt FROM events
        GROUP BY event_type ORDER BY cnt DESC, event_type"""
for _t in ["documents", "conversations", "pages", "benchmark", "labels", "region"]:
    FINAL[f"table_profile_{_t}"] = _profile_sql(_t)


def _nth(col: str, share: float) -> str:
    """The least value with at least ``share`` of the values up to it."""
    return (f"(SELECT CAST(v AS VARCHAR) FROM (SELECT \"{col}\" AS v, ROW_NUMBER() OVER (ORDER BY \"{col}\") AS i, COUNT(*) OVER () AS n "
            f"FROM silver_reading_logs WHERE \"{col}\" IS NOT NULL) WHERE i = CAST(CEIL({share} * n) AS BIGINT))")


def _distribution_sql() -> str:
    """Exact quartiles and top values, which the sketches give as long as they hold every value."""
    numbers = {"int", "bigint", "date", "timestamp"}
    top = ["event_type", "device", "category", "is_premium", "ym", "member_id", "article_id"]
    parts = []
    for pos, (col, dtype) in enumerate(_PROFILE_COLUMNS["silver_reading_logs"], start=1):
        quartiles = [_nth(col, q) if dtype in numbers else "CAST(NULL AS VARCHAR)" for q in (0.25, 0.5, 0.75)]
        values = (f"(SELECT string_agg(v || ': ' || n, ', ' ORDER BY n DESC, v) FROM (SELECT CAST(\"{col}\" AS VARCHAR) AS v, COUNT(*) AS n "
                  f"FROM silver_reading_logs WHERE \"{col}\" IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5))"
                  if col in top else "CAST(NULL AS VARCHAR)")
        parts.append(f"""
        SELECT p.*, {quartiles[0]} AS p25, {quartiles[1]} AS median, {quartiles[2]} AS p75, {values} AS top_values
        FROM profile p WHERE p.position = {pos}""")
    return f", profile AS ({_profile_sql('silver_reading_logs')})" + "\nUNION ALL".join(parts)


FINAL["log_distribution"] = _distribution_sql()
FINAL["readers_in_period"] = """
        , read AS (SELECT DISTINCT category, member_id FROM silver_reading_logs
                      WHERE event_type IN ('read_start', 'read_complete') AND ym BETWEEN '1996-03' AND '1997-08')
        SELECT 'category' AS scope, category, COUNT(member_id) AS unique_readers FROM read GROUP BY category
        UNION ALL
        SELECT 'all' AS scope, CAST(NULL AS VARCHAR) AS category, COUNT(DISTINCT member_id) AS unique_readers FROM read"""


FINAL["estimated_cost_by_sku_over_time"] = """
        SELECT u.sku_name, CAST(ROUND(SUM(usage_quantity), 2) AS DOUBLE) AS dbus,
               CAST(ROUND(SUM(usage_quantity * lp.pricing.effective_list."default"), 2) AS DOUBLE) AS estimated_cost,
               MAX(currency_code) AS currency
        FROM usage u JOIN list_prices lp ON u.sku_name = lp.sku_name AND u.usage_end_time >= lp.price_start_time
         AND (u.usage_end_time < lp.price_end_time OR lp.price_end_time IS NULL)
        GROUP BY u.sku_name ORDER BY estimated_cost DESC, u.sku_name"""


def _turning_sql(monthly: str, group: str, value: str, weight: str) -> str:
    """Every month of a group tried as the split, both sides summed anew each time."""
    return f"""
        , monthly AS ({monthly})
        , tried AS (
            SELECT s.{group}, s.ym,
                   CAST(SUM(CASE WHEN m.ym < s.ym THEN m.{value} ELSE 0 END) AS DOUBLE) AS v1,
                   CAST(SUM(CASE WHEN m.ym < s.ym THEN m.{weight} ELSE 0 END) AS DOUBLE) AS w1,
                   CAST(SUM(CASE WHEN m.ym >= s.ym THEN m.{value} ELSE 0 END) AS DOUBLE) AS v2,
                   CAST(SUM(CASE WHEN m.ym >= s.ym THEN m.{weight} ELSE 0 END) AS DOUBLE) AS w2
            FROM monthly s JOIN monthly m ON s.{group} IS NOT DISTINCT FROM m.{group}
            WHERE s.ym IS NOT NULL AND m.ym IS NOT NULL GROUP BY s.{group}, s.ym)
        , gains AS (
            SELECT {group}, ym, v1 / w1 AS r1, v2 / w2 AS r2,
                   ROUND(w1 * w2 / (w1 + w2) * (v2 / w2 - v1 / w1) * (v2 / w2 - v1 / w1), 6) AS gain
            FROM tried WHERE w1 > 0 AND w2 > 0)
        , placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {group} ORDER BY gain DESC, ym) AS place FROM gains)
        SELECT {group}, ym AS turning_ym, ROUND(r1, 6) AS rate_before, ROUND(r2, 6) AS rate_since, gain FROM placed WHERE place = 1"""


FINAL["completion_turning_month"] = _turning_sql(
    "SELECT category, ym, article_views, reads_completed FROM gold_monthly_engagement", "category", "reads_completed", "article_views")
FINAL["churn_turning_month"] = _turning_sql("""
            WITH churned AS (SELECT m.age_group, s.churn_ym AS ym FROM silver_subscriptions s JOIN silver_members m USING (member_id)
                             WHERE s.status = 'churned' AND s.churn_ym IS NOT NULL),
            span AS (SELECT MIN(ym) AS lo, MAX(ym) AS hi FROM churned),
            months AS (SELECT strftime(d, '%Y-%m') AS ym FROM (
                SELECT unnest(generate_series(CAST(lo || '-01' AS TIMESTAMP), CAST(hi || '-01' AS TIMESTAMP), INTERVAL 1 MONTH)) AS d FROM span))
            SELECT a.age_group, t.ym, (SELECT COUNT(*) FROM churned c WHERE c.age_group = a.age_group AND c.ym = t.ym) AS churned, 1 AS months
            FROM (SELECT DISTINCT age_group FROM churned) a, months t""", "age_group", "churned", "months")


def _drivers_sql(rows: str, keys: list[str]) -> str:
    names = ", ".join(keys)
    return f"""
        , cells AS (
            SELECT {names},
                   CAST(SUM(CASE WHEN ym < '{SPLIT}' THEN w ELSE 0 END) AS BIGINT) AS weight_before,
                   CAST(SUM(CASE WHEN ym >= '{SPLIT}' THEN w ELSE 0 END) AS BIGINT) AS weight_since,
                   SUM(CASE WHEN ym < '{SPLIT}' THEN v ELSE 0 END) AS v1, SUM(CASE WHEN ym >= '{SPLIT}' THEN v ELSE 0 END) AS v2
            FROM ({rows}) WHERE ym IS NOT NULL GROUP BY {names})
        , rates AS (
            SELECT *, COALESCE(CAST(weight_before AS DOUBLE) / NULLIF((SELECT SUM(weight_before) FROM cells), 0), 0) AS s1,
                   COALESCE(CAST(weight_since AS DOUBLE) / NULLIF((SELECT SUM(weight_since) FROM cells), 0), 0) AS s2,
                   CAST(v1 AS DOUBLE) / NULLIF(weight_before, 0) AS q1, CAST(v2 AS DOUBLE) / NULLIF(weight_since, 0) AS q2 FROM cells)
        SELECT {names}, weight_before, weight_since, ROUND(q1 * 100, 6) AS rate_before, ROUND(q2 * 100, 6) AS rate_since,
               ROUND((s2 - s1) * (COALESCE(q1, q2, 0) + COALESCE(q2, q1, 0)) / 2 * 100, 9) AS mix_effect,
               ROUND((s1 + s2) / 2 * (COALESCE(q2, q1, 0) - COALESCE(q1, q2, 0)) * 100, 9) AS rate_effect
        FROM rates WHERE weight_before > 0 OR weight_since > 0"""


FINAL["completion_drivers"] = _drivers_sql("""
            SELECT m.age_group, m.plan_type, l.category, l.ym, 1 AS w, CASE WHEN l.event_type = 'read_complete' THEN 1 ELSE 0 END AS v
            FROM silver_reading_logs l LEFT JOIN silver_members m USING (member_id)
            WHERE l.event_type IN ('read_start', 'read_complete')""", ["age_group", "plan_type", "category"])
FINAL["conversion_drivers"] = _drivers_sql("""
            SELECT m.age_group, m.plan_type, l.ym, CASE WHEN l.event_type = 'paywall_hit' THEN 1 ELSE 0 END AS w,
                   CASE WHEN l.event_type = 'subscribe' THEN 1 ELSE 0 END AS v
            FROM silver_reading_logs l LEFT JOIN silver_members m USING (member_id)
            WHERE l.event_type IN ('paywall_hit', 'subscribe')""", ["age_group", "plan_type"])
_REFUSED = {"members": [("registration_date", "DATE", "")], "articles": [("publish_date", "DATE", "")],
            "reading_logs": [("event_time", "TIMESTAMP", "")],
            "subscriptions": [("start_date", "DATE", ""), ("end_date", "DATE", " AND NOT (trim(end_date) = '' AND status IS DISTINCT FROM 'churned')")]}


def _refused_sql() -> str:
    parts = []
    for name, columns in _REFUSED.items():
        bad = {c: f"({c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL{but})" for c, kind, but in columns}
        good = " AND ".join(f"NOT {b}" for b in bad.values())
        parts += [f"""
        SELECT '{name}' AS table_name, '{c}' AS column_name, CASE WHEN trim({c}) = '' THEN 'empty' ELSE 'no {kind.lower()}' END AS reason,
               COUNT(*) AS refused, (SELECT COUNT(*) FROM bronze_{name}) AS rows_read,
               (SELECT COUNT(*) FROM bronze_{name} WHERE COALESCE({good}, TRUE)) AS rows_kept
        FROM bronze_{name} WHERE {bad[c]} GROUP BY 3""" for c, kind, _ in columns]
    return "\nUNION ALL".join(parts)


FINAL["refused_values"] = _refused_sql()


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, final in FINAL.items():
        final = final.strip()
        if final.startswith(","):
            out[name] = MODEL.rstrip() + "\n" + final  # extra CTEs continue the WITH list
        else:
            out[name] = MODEL + final
    return out
