from subsight.operators.profile import table_profile


def test_profile_counts(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.5, None), (2, "a", -0.0, None), (2, None, 0.0, None), (None, "b", None, None)],
        "x int, s string, d double, n string")
    out = {r.column_name: r for r in table_profile(df).collect()}
    assert (out["x"].row_count, out["x"].null_count, out["x"].null_pct, out["x"].distinct_count) == (4, 1, 25.0, 2)
    assert (out["x"].min_value, out["x"].max_value, out["x"].data_type) == ("1", "2", "int")
    assert (out["s"].distinct_count, out["s"].min_value, out["s"].max_value) == (2, "a", "b")
    assert out["d"].distinct_count == 2          # -0.0 and 0.0 are one value
    assert (out["n"].null_count, out["n"].distinct_count, out["n"].min_value) == (4, 0, None)
    approx = {r.column_name: r.distinct_count for r in table_profile(df, distinct="approx").collect()}
    assert approx["x"] == 2 and approx["s"] == 2


def test_profile_empty(spark):
    df = spark.createDataFrame([], "x int")
    r = table_profile(df).collect()[0]
    assert (r.row_count, r.null_count, r.null_pct, r.distinct_count) == (0, 0, None, 0)


def test_profile_quartiles(spark):
    df = spark.createDataFrame([(v, f"s{v}", None) for v in range(1, 101)], "x int, s string, n double")
    out = {r.column_name: r for r in table_profile(df, quartiles=True).collect()}
    assert (out["x"].p25, out["x"].median, out["x"].p75) == ("25", "50", "75")
    assert (out["s"].p25, out["s"].median, out["s"].p75) == (None, None, None)
    assert out["n"].median is None
    assert "median" not in table_profile(df).columns   # default output unchanged


def test_profile_of_times_without_a_zone(spark):
    """Two wall-clock times that one zone maps to the same instant are two values."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2025-03-30 02:30:00'), (TIMESTAMP_NTZ'2025-03-30 03:30:00'), "
                       "(TIMESTAMP_NTZ'2025-03-30 03:30:00.000001'), (NULL) AS t(at)")
        assert table_profile(df).collect()[0].distinct_count == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_profile_of_nested_columns(spark):
    df = spark.createDataFrame([([1], {"a": 1}), (None, {"a": 2})], "l array<int>, m map<string,int>")
    out = {r.column_name: r for r in table_profile(df).collect()}
    assert (out["l"].null_count, out["l"].distinct_count, out["l"].min_value) == (1, None, None)
    assert (out["m"].null_count, out["m"].distinct_count) == (0, None)
    mixed = spark.createDataFrame([([1], 5), (None, 5)], "l array<int>, x int")
    out = {r.column_name: r.distinct_count for r in table_profile(mixed).collect()}
    assert out == {"l": None, "x": 1}
