import datetime as dt

from conftest import article, log, member, sub

from subsight import model as M
from subsight.operators import silver


def test_age_bands_and_null(spark, frames):
    ages = [29, 30, 39, 40, 49, 50, 59, 60, None]
    df = frames("members", [member(i, a) for i, a in enumerate(ages)])
    out = {r.member_id: r.age_group for r in silver.silver_members(df).collect()}
    assert [out[i] for i in range(len(ages))] == [
        M.AGE_LABELS[0], M.AGE_LABELS[1], M.AGE_LABELS[1], M.AGE_LABELS[2], M.AGE_LABELS[2],
        M.AGE_LABELS[3], M.AGE_LABELS[3], M.AGE_LABELS[4], M.AGE_LABELS[4]]


def test_bad_text_dates_become_null(spark, frames):
    rows = [member(1), member(2), member(3), member(4)]
    rows = [r[:7] + (d,) + r[8:] for r, d in zip(rows, ["", "2025-02-30", "x", "2025-02-28"])]
    out = {r.member_id: r.registration_date for r in silver.silver_members(frames("members", rows)).collect()}
    assert out == {1: None, 2: None, 3: None, 4: dt.date(2025, 2, 28)}


def test_subscription_rules(spark, frames):
    rows = [
        sub(1, 1, "active", "2024-01-01", ""),            # active, no end
        sub(2, 1, "churned", "2024-01-01", ""),           # churned without end date
        sub(3, 1, "active", "2024-01-01", "2024-03-01"),  # active with an end date
        sub(4, 1, "churned", "2024-01-01", "2024-02-15"),
    ]
    out = {r.subscription_id: r for r in silver.silver_subscriptions(frames("subs", rows)).collect()}
    assert (out[1].end_date, out[1].churn_ym, out[1].tenure_days) == (None, None, None)
    assert (out[2].churn_ym, out[2].tenure_days) == (None, None)
    assert (out[3].churn_ym, out[3].tenure_days) == (None, 60)
    assert (out[4].churn_ym, out[4].tenure_days) == ("2024-02", 45)


def test_reading_logs_keep_unknown_articles(spark, frames):
    arts = silver.silver_articles(frames("articles", [article(1, "tech", 1)]))
    logs = frames("logs", [log(1, 1, 1, M.READ_START, "2025-01-31 23:59:59"), log(2, 1, 99, M.READ_START),
                           log(3, 1, 1, M.READ_START, "bad")])
    out = silver.silver_reading_logs(logs, arts)
    assert out.columns[0] == "article_id"
    rows = {r.log_id: r for r in out.collect()}
    assert len(rows) == 3
    assert (rows[1].category, rows[1].is_premium, rows[1].ym, rows[1].event_date) == (
        "tech", 1, "2025-01", dt.date(2025, 1, 31))
    assert (rows[2].category, rows[2].is_premium) == (None, None)
    assert (rows[3].event_time, rows[3].ym) == (None, None)
