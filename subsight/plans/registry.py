"""The named queries as functions of a :class:`Lake`.

Each entry reads whole tables of the lake; parameters that the questions
leave to the user (a category, a split month, a user) have defaults chosen
for the test tables in :data:`TEST_PARAMS`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame

from subsight.lake import Lake
from subsight.model import ACTIVITY_TABLE, MONTHS_TABLE, READERS_TABLE, SKETCH_TABLE
from subsight.operators import churn, conversion, cost, explore, gold, profile, shifts, sketches
from subsight.sources import sift

# Parameters of the registered queries on the driver's test tables (which
# span 1995-2001 and have part types as article categories).
TEST_PARAMS = {
    "category": "STANDARD",
    "split_ym": "1998-07",
    "user": "user1@example.com",
    "silent_days": 90,
    "usage_days": 30,
    "recent_days": 7,
    "top_k": 50,
    "preview_rows": 10,
    "period": ("1996-03", "1997-08"),
}


# Given tables profiled as they are (whole rows, whole texts).
PROFILED_TABLES = ["documents", "conversations", "pages", "benchmark", "labels", "region"]


def _silent(lk: Lake, **rule) -> DataFrame:
    rule = {"days": TEST_PARAMS["silent_days"], **rule}
    if lk.stored("gold_member_segment") and lk.stored(MONTHS_TABLE):
        return churn.silent_from_segment(lk["gold_member_segment"], lk[MONTHS_TABLE], lk["silver_subscriptions"], **rule)
    seen = lk[ACTIVITY_TABLE] if lk.stored(ACTIVITY_TABLE) else gold.member_activity(lk.log_events())
    return churn.silent_members(lk["silver_members"], seen, lk["silver_subscriptions"], **rule)


#: Queries beyond the 32 named ones and their checks; the benchmark lists them apart from its sums.
ADDED = ["log_distribution", "readers_in_period", "estimated_cost_by_sku_over_time", "completion_turning_month", "churn_turning_month",
         "completion_drivers", "conversion_drivers", "refused_values"]


def _reading(lk: Lake) -> DataFrame:
    return lk[ACTIVITY_TABLE] if lk.stored(ACTIVITY_TABLE) else lk["silver_reading_logs"]


def _paywall(lk: Lake) -> DataFrame:
    return lk[ACTIVITY_TABLE] if lk.stored(ACTIVITY_TABLE) else lk.log_events()


def _refused(lk: Lake) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [sift.refused_values(lk[f"bronze_{name}"], name) for name in sift.PARSED])


def _log_distribution(lk: Lake) -> DataFrame:
    stored = lk.stored(SKETCH_TABLE)
    return sketches.distribution(sketches.merged(lk[SKETCH_TABLE]) if stored else sketches.log_sketches(lk["silver_reading_logs"]))


# The hint's steps: more than 90 days, churn not tested. The default rule is the glossary's.
STRICT = {"inclusive": False, "exclude_churned": False}

P = TEST_PARAMS

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {
    # silver (Q1-Q4)
    "silver_members": lambda lk: lk["silver_members"],
    "silver_articles": lambda lk: lk["silver_articles"],
    "silver_reading_logs": lambda lk: lk["silver_reading_logs"],
    "silver_subscriptions": lambda lk: lk["silver_subscriptions"],
    # gold (Q5-Q7)
    "gold_monthly_engagement": lambda lk: lk["gold_monthly_engagement"],
    "gold_member_segment": lambda lk: lk["gold_member_segment"],
    "gold_paywall_conversion": lambda lk: lk["gold_paywall_conversion"],
    # exploration (Q8-Q14)
    "preview_rows": lambda lk: explore.preview(
        lk["bronze_reading_logs"], P["preview_rows"], ["member_id", "article_id", "event_type", "log_id"],
        order=["member_id", "log_id"]),
    "reads_by_member": lambda lk: explore.reads_by_member(lk["bronze_reading_logs"]),
    "reads_by_member_named": lambda lk: explore.reads_by_member_named(
        lk["bronze_reading_logs"], lk["bronze_members"]),
    "members_by_plan": lambda lk: explore.members_by_plan(lk["bronze_members"]),
    "events_by_type": lambda lk: explore.events_by_type(lk["bronze_reading_logs"]),
    "monthly_views_reads": lambda lk: explore.monthly_views_reads(lk["bronze_reading_logs"]),
    "category_monthly_completion": lambda lk: explore.category_monthly_completion(
        lk["gold_monthly_engagement"], P["category"]),
    # churn (Q15-Q21, Q25)
    "churn_by_month": lambda lk: churn.churn_by_month(lk["silver_subscriptions"]),
    "churn_by_age_month": lambda lk: churn.churn_by_age_month(
        lk["silver_subscriptions"], lk["silver_members"]),
    "churn_by_age": lambda lk: churn.churn_by_age(lk["silver_subscriptions"], lk["silver_members"]),
    "silent_members_strict": lambda lk: _silent(lk, **STRICT),
    "silent_members": lambda lk: _silent(lk),
    "silent_member_count": lambda lk: churn.silent_member_count(_silent(lk)),
    "silent_by_age_plan": lambda lk: churn.silent_by_age_plan(_silent(lk)),
    # conversion and completion shifts (Q22-Q24)
    "conversion_by_age": lambda lk: conversion.conversion_by_age(lk["gold_paywall_conversion"]),
    "paywall_improvement_target": lambda lk: conversion.paywall_improvement_target(
        lk["gold_paywall_conversion"]),
    "completion_period_shift": lambda lk: conversion.completion_period_shift(
        lk["gold_monthly_engagement"], P["split_ym"]),
    "churn_period_shift": lambda lk: churn.churn_period_shift(
        lk["silver_subscriptions"], lk["silver_members"], P["split_ym"]),
    # cost (Q26-Q31)
    "daily_usage": lambda lk: cost.daily_usage(lk["usage"], P["usage_days"], lk.usage_day()),
    "usage_by_sku": lambda lk: cost.usage_by_sku(lk["usage"], P["usage_days"], lk.usage_day()),
    "estimated_cost_by_sku": lambda lk: cost.estimated_cost_by_sku(
        lk["usage"], lk["list_prices"], P["usage_days"], lk.usage_day()),
    "my_usage_by_job": lambda lk: cost.my_usage_by_job(
        lk["usage"], P["user"], P["usage_days"], lk.usage_day(), k=P["top_k"]),
    "top_sku_recent": lambda lk: cost.top_sku_recent(lk["usage"], P["recent_days"], lk.usage_day()),
    "estimated_cost_by_job": lambda lk: cost.estimated_cost_by_job(
        lk["usage"], lk["list_prices"], P["usage_days"], lk.usage_day()),
    # profile (Q32)
    "table_profile": lambda lk: profile.table_profile(lk["silver_reading_logs"], distinct="exact"),
    # distribution per column and readers of a period, from sketches (stored per month where they were written)
    "log_distribution": _log_distribution,
    "readers_in_period": lambda lk: sketches.readers(lk[READERS_TABLE], *P["period"]),
    # usage x price with the price intervals cut by day, all days: no broadcast, no hot SKU
    "estimated_cost_by_sku_over_time": lambda lk: cost.estimated_cost_by_sku(lk["usage"], lk["list_prices"], None, bucket_days=1),
    # when a rate turned and what drove the change; values that silver would blank
    "completion_turning_month": lambda lk: shifts.completion_turning_month(lk["gold_monthly_engagement"]),
    "churn_turning_month": lambda lk: shifts.churn_turning_month(lk["silver_subscriptions"], lk["silver_members"]),
    "completion_drivers": lambda lk: shifts.completion_drivers(_reading(lk), lk["silver_members"], P["split_ym"]),
    "conversion_drivers": lambda lk: shifts.conversion_drivers(_paywall(lk), lk["silver_members"], P["split_ym"]),
    "refused_values": _refused,
    # second check of Q12 on the given event log; profiles of the other given tables
    "events_by_type_events": lambda lk: explore.events_by_type(lk["events"]),
    **{f"table_profile_{t}": (lambda lk, t=t: profile.table_profile(lk[t], distinct="exact"))
       for t in PROFILED_TABLES},
}
