"""Physical-plan checks: what the plans must and must not contain."""

import pytest
from conftest import SF_SMALL

from __spark_entry__ import queries
from subsight.lake import Lake
from subsight.operators import churn, explore, gold
from subsight.plans import pipeline
from subsight.plans.registry import QUERIES
from subsight.sources.catalog import LakeConfig


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_python_no_cartesian(spark, name):
    plan = plan_of(queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.fixture(scope="module")
def stored(spark):
    config = LakeConfig(schema="plan_checks")
    pipeline.ingest_bronze(spark, config, Lake.from_testdata(spark, SF_SMALL))
    pipeline.run_silver(spark, config)
    return Lake.from_catalog(spark, config)


def test_filters_reach_the_scan(spark, stored):
    plan = plan_of(explore.reads_by_member(stored["silver_reading_logs"]))
    assert "EqualTo(event_type,read_complete)" in plan
    plan = plan_of(explore.category_monthly_completion(
        gold.monthly_engagement(gold.member_month_activity(stored["silver_reading_logs"])), "PROMO"))
    assert "EqualTo(category,PROMO)" in plan


def test_columns_are_pruned(spark, stored):
    plan = plan_of(explore.members_by_plan(stored["bronze_members"]))
    assert "ReadSchema: struct<plan_type:string>" in plan


def test_partial_aggregation_before_join(spark, stored):
    plan = plan_of(gold.paywall_conversion(gold.member_month_activity(stored["silver_reading_logs"]),
                                           stored["silver_members"]))
    # the per (member, month) partial aggregate sits under the first exchange
    assert "partial_sum" in plan
    joins = plan.index("Join")
    assert plan.index("HashAggregate(keys=[member_id", joins) > joins


def test_scalar_subquery_not_cross_join(spark, stored):
    plan = plan_of(QUERIES["silent_members"](stored))
    assert "Subquery" in plan and "BroadcastNestedLoopJoin" not in plan


def _final_plan(spark, df):
    df.collect()
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["silent_members", "silent_members_strict", "silent_member_count", "silent_by_age_plan"])
def test_silent_members_do_not_scan_stored_logs(spark, name):
    """From stored tables the last days come from the segment mart, the latest day from the months: no logs, no activity."""
    config = LakeConfig(schema="plan_silent")
    if not spark.catalog.databaseExists("plan_silent"):
        pipeline.ingest_bronze(spark, config, Lake.from_testdata(spark, SF_SMALL))
        pipeline.run_pipeline(spark, config)
    plan = _final_plan(spark, QUERIES[name](Lake.from_catalog(spark, config)))
    assert "reading_logs" not in plan and "work_member_month_activity" not in plan
    planned = plan_of(QUERIES[name](Lake.from_catalog(spark, config)))   # the final plan of an empty result holds no scan
    assert "gold_member_segment" in planned and "work_log_months" in planned


def test_stored_usage_windows_are_literals(spark):
    """The newest day is kept with stored usage: months are pruned while planning, no subquery runs before the scan."""
    config = LakeConfig(schema="plan_usage_day")
    pipeline.ingest_billing(spark, config, Lake.from_testdata(spark, SF_SMALL))
    lake = Lake.from_catalog(spark, config)
    newest = lake["usage"].agg({"usage_date": "max"}).first()[0]
    assert lake.usage_day() == newest
    for name in ("daily_usage", "usage_by_sku", "estimated_cost_by_sku", "my_usage_by_job", "top_sku_recent", "estimated_cost_by_job"):
        plan = plan_of(QUERIES[name](lake))
        assert "ubquery" not in plan and f"usage_ym#" in plan and f"{newest:%Y-%m}" in plan, name


def test_silent_members_reuse_the_aggregate(spark):
    """From raw tables, the latest day and the join use the same exchange of the per-member maxima."""
    plan = _final_plan(spark, QUERIES["silent_members"](Lake.from_testdata(spark, SF_SMALL)))
    assert "ReusedExchange" in plan


def test_cost_window_reaches_the_scan(spark):
    from subsight.operators import cost

    config = LakeConfig(schema="plan_cost")
    raw = Lake.from_testdata(spark, SF_SMALL)
    pipeline.ingest_billing(spark, config, raw)
    stored = Lake.from_catalog(spark, config)
    plan = plan_of(cost.estimated_cost_by_sku(stored["usage"], stored["list_prices"], days=30))
    assert "PartitionFilters: [isnotnull(usage_ym" in plan          # months, bound by a subquery
    assert "BroadcastHashJoin" in plan
    plan = plan_of(cost.daily_usage(stored["usage"], days=30, as_of="1999-03-10"))
    assert "PartitionFilters: [isnotnull(usage_ym" in plan and "usage_ym#" in plan
    assert "GreaterThanOrEqual(usage_date,1999-02-08), LessThanOrEqual(usage_date,199" in plan
    assert cost.daily_usage(stored["usage"], days=30, as_of="1999-03-10").count() <= 31


def test_month_refresh_reads_only_its_months(spark, stored):
    from pyspark.sql import functions as F

    logs = stored["silver_reading_logs"].filter(F.col("ym").isin(["1998-07", "1998-08"]))
    plan = plan_of(gold.member_month_activity(logs))
    assert "PartitionFilters: [ym#" in plan and "IN (1998-07,1998-08)" in plan


def test_profile_shuffles_no_text(spark):
    """Whatever a value's length, its distinct count shuffles 16 bytes."""
    df = QUERIES["table_profile_documents"](Lake.from_testdata(spark, SF_SMALL))
    plan = plan_of(df)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text#" in line for line in exchanges)
    assert any("digest#" in line for line in exchanges)
