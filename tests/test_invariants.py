"""Invariants of the model on the test tables."""

import pytest
from pyspark.sql import functions as F

from subsight.lake import Lake


@pytest.fixture(scope="module", params=["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def lake(request, spark):
    return Lake.from_testdata(spark, request.param)


def test_silver_keeps_rows(lake):
    for b, s in [("bronze_members", "silver_members"), ("bronze_articles", "silver_articles"),
                 ("bronze_reading_logs", "silver_reading_logs"),
                 ("bronze_subscriptions", "silver_subscriptions")]:
        assert lake[b].count() == lake[s].count()


def test_keys_unique(lake):
    for t, k in [("bronze_members", "member_id"), ("bronze_articles", "article_id"),
                 ("bronze_reading_logs", "log_id"), ("bronze_subscriptions", "subscription_id")]:
        assert lake[t].groupBy(k).count().filter("count > 1").count() == 0


def test_segment_one_row_per_member_and_sums(lake):
    seg = lake["gold_member_segment"]
    assert seg.count() == lake["silver_members"].count()
    known = lake["silver_reading_logs"].join(lake["silver_members"].select("member_id"), "member_id", "left_semi")
    assert seg.agg(F.sum("total_events")).first()[0] == known.count()


def test_engagement_bounds(lake):
    eng = lake["gold_monthly_engagement"]
    assert eng.filter("reads_completed > article_views OR unique_readers > article_views").count() == 0


def test_exceptional_rows_occur():
    """The test mapping has rows for every branch of the rules; counted at sf0.01 in the checking SQL."""
    import duckdb

    from subsight.oracle import MODEL
    from subsight.sources.testdata import TEST_TABLES

    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    one = lambda final: con.execute(MODEL + final).fetchall()[0][0]
    assert one("SELECT count(*) FROM silver_reading_logs") == one("SELECT count(*) FROM lineitem")
    for what in (
        "SELECT count(*) FROM silver_reading_logs WHERE category IS NULL",
        "SELECT count(*) FROM silver_reading_logs WHERE event_time IS NULL",
        "SELECT count(*) FROM gold_paywall_conversion WHERE age_group IS NULL",
        "SELECT count(*) FROM gold_paywall_conversion WHERE paywall_hits = 0 AND conversion_rate IS NULL",
        "SELECT count(*) FROM gold_member_segment WHERE total_events = 0 AND last_event_date IS NULL",
        "SELECT count(*) FROM silver_subscriptions WHERE status = 'churned' AND end_date IS NULL",
        "SELECT count(*) FROM silver_members WHERE registration_date IS NULL",
        "SELECT (SELECT count(*) FROM usage_30) - (SELECT count(*) FROM priced_30)",
        "SELECT count(*) FROM usage_30 u JOIN list_prices p ON u.sku_name = p.sku_name "
        "AND u.usage_end_time >= p.price_start_time AND u.usage_end_time < p.price_end_time",
    ):
        assert one(what) > 0, what
    assert one("SELECT count(DISTINCT activity_segment) FROM gold_member_segment") == 4
    assert one("SELECT count(*) FROM (SELECT DISTINCT usage_date, usage_metadata FROM usage_30 "
               "WHERE identity_metadata.run_as = 'user1@example.com')") > 50
