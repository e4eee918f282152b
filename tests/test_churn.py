import datetime as dt

from conftest import article, log, member, sub

from subsight import model as M
from subsight.operators import churn, gold, silver


def _setup(frames, members, logs, subs):
    arts = silver.silver_articles(frames("articles", [article(1)]))
    m = silver.silver_members(frames("members", members))
    lg = silver.silver_reading_logs(frames("logs", logs), arts)
    s = silver.silver_subscriptions(frames("subs", subs))
    return m, gold.member_month_activity(lg), s


def _day(d):
    return (dt.date(2025, 12, 31) - dt.timedelta(days=d)).isoformat() + " 10:00:00"


def _silent_case(frames):
    members = [member(1, plan="paid"), member(2, plan="paid"), member(3, plan="premium"),
               member(4, plan="paid"), member(5, plan="free"), member(6, plan="paid"),
               member(7, plan="paid")]
    logs = [log(1, 1, 1, M.READ_START, _day(89)), log(2, 2, 1, M.READ_START, _day(90)),
            log(3, 3, 1, M.READ_START, _day(91)), log(4, 4, 1, M.READ_START, _day(200)),
            log(5, 5, 1, M.READ_START, _day(200)), log(6, 6, 1, M.READ_START, _day(0))]
    subs = [sub(1, 4, "churned", "2024-01-01", "2025-06-01")]   # member 4 churned
    return _setup(frames, members, logs, subs)  # member 7 never active


def test_silent_strict_and_inclusive(spark, frames):
    m, act, s = _silent_case(frames)
    strict = churn.silent_members(m, act, s, days=90, inclusive=False, exclude_churned=False)
    assert sorted(r.member_id for r in strict.collect()) == [3, 4]
    glossary = churn.silent_members(m, act, s, days=90, inclusive=True, exclude_churned=True)
    rows = {r.member_id: r.days_since_last_event for r in glossary.collect()}
    assert rows == {2: 90, 3: 91}
    assert churn.silent_member_count(glossary).collect()[0].silent_members == 2


def test_silent_never_active_option(spark, frames):
    m, act, s = _silent_case(frames)
    out = churn.silent_members(m, act, s, include_never_active=True)
    assert sorted(r.member_id for r in out.collect()) == [2, 3, 7]


def test_churn_by_age_and_period_shift(spark, frames):
    members = [member(1, age=25), member(2, age=45), member(3, age=25)]
    subs = [sub(1, 1, "churned", "2024-01-01", "2025-08-03"),
            sub(2, 1, "churned", "2024-01-01", "2025-09-03"),
            sub(3, 3, "churned", "2024-01-01", "2025-08-20"),
            sub(4, 2, "churned", "2024-01-01", "2025-01-03"),
            sub(5, 2, "active", "2024-01-01", ""),
            sub(6, 99, "churned", "2024-01-01", "2025-01-03")]   # unknown member: inner join drops it
    m, _, s = _setup(frames, members, [log(1, 1, 1, M.READ_START)], subs)
    by_month = {r.churn_ym: r.churned for r in churn.churn_by_month(s).collect()}
    assert by_month == {"2025-01": 2, "2025-08": 2, "2025-09": 1}
    by_age_month = {(r.age_group, r.churn_ym): r.churned for r in churn.churn_by_age_month(s, m).collect()}
    assert by_age_month == {(M.AGE_LABELS[0], "2025-08"): 2, (M.AGE_LABELS[0], "2025-09"): 1,
                            (M.AGE_LABELS[2], "2025-01"): 1}
    ranked = churn.churn_by_age(s, m).collect()
    assert [(r.age_group, r.churned) for r in ranked] == [(M.AGE_LABELS[0], 3), (M.AGE_LABELS[2], 1)]
    shift = {r.age_group: (r.churned_before, r.churned_since, r.churned_change)
             for r in churn.churn_period_shift(s, m, "2025-07").collect()}
    assert shift == {M.AGE_LABELS[0]: (0, 3, 3), M.AGE_LABELS[2]: (1, 0, -1)}


def test_latest_day_is_that_of_all_logs(spark, frames):
    """Logs of members that are not known, or of no member, set the latest day as well."""
    members = [member(1, plan="paid"), member(0, plan="paid")]
    base = [log(1, 1, 1, M.READ_START, "2025-01-01 10:00:00"), log(2, 0, 1, M.READ_START, "2025-01-01 10:00:00")]
    for who in (99, None):
        m, act, s = _setup(frames, members, base + [log(3, who, 1, M.READ_START, "2025-05-01 10:00:00")], [])
        got = {r.member_id: r.days_since_last_event for r in churn.silent_members(m, act, s).collect()}
        assert got == {1: 120, 0: 120}, who
