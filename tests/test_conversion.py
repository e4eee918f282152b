from pyspark.sql.types import LongType, StringType, StructField, StructType

from subsight.operators import conversion, explore

PAYWALL = StructType([StructField("ym", StringType()), StructField("age_group", StringType()),
                      StructField("paywall_hits", LongType()), StructField("conversions", LongType())])


def test_rate_from_sums_not_mean(spark):
    rows = [("2025-01", "a", 10, 1), ("2025-02", "a", 10, 9),     # 10/20 -> 50.0
            ("2025-01", "b", 1, 1), ("2025-02", "b", 9, 0)]        # 1/10 -> 10.0, not 50.0
    out = {r.age_group: r.conversion_rate
           for r in conversion.conversion_by_age(spark.createDataFrame(rows, PAYWALL)).collect()}
    assert out == {"a": 50.0, "b": 10.0}


def test_improvement_target(spark):
    rows = [("2025-01", "20s", 100, 10), ("2025-01", "30s", 100, 2),
            ("2025-01", "40s", 5, 0), ("2025-01", "50s", 100, 9)]
    # mean hits = 76.25; overall rate = 21/305 = 6.9 %: only 30s qualifies (40s has few hits)
    out = conversion.paywall_improvement_target(spark.createDataFrame(rows, PAYWALL)).collect()
    assert [(r.age_group, r.conversion_rate) for r in out] == [("30s", 2.0)]


def test_completion_period_shift(spark):
    schema = "ym string, category string, article_views bigint, reads_completed bigint"
    rows = [("2025-01", "tech", 30, 20), ("2025-06", "tech", 30, 20),
            ("2025-07", "tech", 50, 12), ("2025-12", "tech", 50, 12),
            ("2025-03", "econ", 10, 5)]
    out = {r.category: r for r in conversion.completion_period_shift(
        spark.createDataFrame(rows, schema), "2025-07").collect()}
    t = out["tech"]
    assert (t.completion_before, t.completion_since, t.completion_change) == (66.7, 24.0, -42.7)
    e = out["econ"]
    assert (e.completion_before, e.completion_since, e.completion_change) == (50.0, None, None)


def test_category_completion_filter(spark):
    schema = ("ym string, category string, article_views bigint, reads_completed bigint, "
              "unique_readers bigint, completion_rate double")
    rows = [("2025-02", "tech", 2, 1, 1, 50.0), ("2025-01", "tech", 4, 1, 1, 25.0),
            ("2025-01", "econ", 1, 1, 1, 100.0)]
    out = explore.category_monthly_completion(spark.createDataFrame(rows, schema), "tech").collect()
    assert [r.ym for r in out] == ["2025-01", "2025-02"]
