"""Property tests: Spark results equal a brute-force computation in plain
Python over random small inputs."""

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from subsight import model as M
from subsight.operators import churn, conversion, gold, silver

TYPES = M.EVENT_TYPES


def _age_group(age):
    if age is None:
        return M.AGE_LABELS[-1]
    for bound, label in zip(M.AGE_BOUNDS, M.AGE_LABELS):
        if age < bound:
            return label
    return M.AGE_LABELS[-1]


def _segment(n):
    for bound, label in zip(M.ACTIVITY_BOUNDS, M.ACTIVITY_LABELS):
        if n >= bound:
            return label
    return M.ACTIVITY_LABELS[-1]


def _pct(a, b):
    if not b:
        return None
    # half-up at one digit on the decimal value, as Spark's round does
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(a / b * 100)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


day = st.dates(min_value=dt.date(2024, 11, 25), max_value=dt.date(2025, 3, 5))
log_row = st.tuples(
    st.integers(1, 8),                 # member (7, 8 unknown)
    st.integers(1, 5),                 # article (5 unknown)
    st.sampled_from(TYPES),
    day,
    st.integers(0, 23),
    st.booleans(),                     # bad time text
)
member_row = st.tuples(st.one_of(st.none(), st.integers(18, 70)), st.sampled_from(["free", "paid", "premium"]))
sub_row = st.tuples(st.integers(1, 8), st.sampled_from(["active", "churned"]), day)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(members=st.lists(member_row, min_size=6, max_size=6),
       logs=st.lists(log_row, min_size=0, max_size=40),
       subs=st.lists(sub_row, min_size=0, max_size=10))
def test_marts_equal_brute_force(spark, members, logs, subs):
    m_rows = [(i + 1, f"m{i + 1}", age, "F", "P", "O", plan, "2020-01-01", "e")
              for i, (age, plan) in enumerate(members)]
    a_rows = [(a, f"a{a}", f"c{a % 2}", "2024-01-01", a % 2) for a in range(1, 5)]
    l_rows = []
    for i, (mid, aid, et, d, h, bad) in enumerate(logs):
        text = "not a time" if bad else f"{d.isoformat()} {h:02d}:00:00"
        l_rows.append((i, mid, aid, et, text, "web", 1, 1))
    s_rows = [(i, mid, "paid", "2024-01-01", end.isoformat() if st_ == "churned" else "", st_)
              for i, (mid, st_, end) in enumerate(subs)]

    mem = silver.silver_members(spark.createDataFrame(m_rows, M.MEMBERS_SCHEMA))
    arts = silver.silver_articles(spark.createDataFrame(a_rows, M.ARTICLES_SCHEMA))
    lg = silver.silver_reading_logs(spark.createDataFrame(l_rows, M.READING_LOGS_SCHEMA), arts)
    sb = silver.silver_subscriptions(spark.createDataFrame(s_rows, M.SUBSCRIPTIONS_SCHEMA))

    act = gold.member_month_activity(lg)

    # brute force over the parsed rows
    age_of = {r[0]: _age_group(r[2]) for r in m_rows}
    plan_of = {r[0]: r[6] for r in m_rows}
    cat_of = {r[0]: r[2] for r in a_rows}
    parsed = []
    for (i, mid, aid, et, d, h, bad) in [(i, *x) for i, x in enumerate(logs)]:
        ym = None if bad else d.strftime("%Y-%m")
        parsed.append((mid, cat_of.get(aid), et, ym, None if bad else d))

    eng = collections.defaultdict(lambda: [0, 0, set()])
    for mid, cat, et, ym, _ in parsed:
        if et in (M.READ_START, M.READ_COMPLETE):
            g = eng[(ym, cat)]
            g[0] += 1
            g[1] += et == M.READ_COMPLETE
            g[2].add(mid)
    want = {k: (v[0], v[1], len(v[2]), _pct(v[1], v[0])) for k, v in eng.items()}
    got = {(r.ym, r.category): (r.article_views, r.reads_completed, r.unique_readers, r.completion_rate)
           for r in gold.monthly_engagement(act).collect()}
    assert got == want

    per = collections.defaultdict(lambda: [0, 0, 0, 0, None])
    for mid, _, et, _, d in parsed:
        p = per[mid]
        p[0] += 1
        p[1] += et == M.READ_COMPLETE
        p[2] += et == M.PAYWALL_HIT
        p[3] += et == M.SUBSCRIBE
        if d is not None and (p[4] is None or d > p[4]):
            p[4] = d
    want = {mid: (*(per[mid][:4] if mid in per else [0, 0, 0, 0]), per[mid][4] if mid in per else None,
                  _segment(per[mid][0] if mid in per else 0)) for mid in age_of}
    got = {r.member_id: (r.total_events, r.reads_completed, r.paywall_hits, r.conversions,
                         r.last_event_date, r.activity_segment) for r in gold.member_segment(mem, act).collect()}
    assert got == want

    pw = collections.defaultdict(lambda: [0, 0])
    for mid, _, et, ym, _ in parsed:
        if et in (M.PAYWALL_HIT, M.SUBSCRIBE):
            g = pw[(ym, age_of.get(mid))]
            g[0] += et == M.PAYWALL_HIT
            g[1] += et == M.SUBSCRIBE
    want = {k: (v[0], v[1], _pct(v[1], v[0])) for k, v in pw.items()}
    paywall = gold.paywall_conversion(act, mem)
    got = {(r.ym, r.age_group): (r.paywall_hits, r.conversions, r.conversion_rate) for r in paywall.collect()}
    assert got == want

    by_age = collections.defaultdict(lambda: [0, 0])
    for (ym, ag), (h, c) in pw.items():
        by_age[ag][0] += h
        by_age[ag][1] += c
    want = {ag: (h, c, _pct(c, h)) for ag, (h, c) in by_age.items()}
    got = {r.age_group: (r.paywall_hits, r.conversions, r.conversion_rate)
           for r in conversion.conversion_by_age(paywall).collect()}
    assert got == want

    # silent members (glossary form) against the brute force
    days = [d for *_, d in parsed if d is not None]
    churned_members = {mid for (mid, s, _) in subs if s == "churned"}
    want = set()
    if days:
        latest = max(days)
        for mid in age_of:
            last = per[mid][4] if mid in per else None
            if plan_of[mid] in M.PAID_PLANS and last is not None and (latest - last).days >= 30 \
                    and mid not in churned_members:
                want.add(mid)
    got = {r.member_id for r in churn.silent_members(mem, act, sb, days=30).collect()}
    assert got == want
