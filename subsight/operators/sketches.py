"""Profiles and readers from sketches that are stored per month and merged on reading.

* :func:`sketched` takes one scan: per column a quantile sketch (numbers,
  dates, times), a distinct sketch and a frequent-item sketch, beside counts
  and text bounds; by month, or for the whole table.
* :func:`merged` adds up sketches of any months, :func:`distribution` reads
  quartiles, distinct count, bounds and top values from them.
* :func:`reader_sketches` holds the readers of each month and category;
  :func:`readers` is the number of different ones in any period, which sums
  of monthly counts are not. :func:`readers_exact` counts them.

Stated errors, with 99 % confidence. Quantiles: no error while a sketch has
seen up to ``ACCURACY`` values, then a rank error of about 0.02 % of the
values. Distinct values: exact up to 15/16 of 2^``DISTINCT_BITS``, then a
relative standard error of 1 / sqrt(2^``DISTINCT_BITS``) (0.3 %). Top
values: exact while a column has up to ``TRACKED`` different ones. All
three are Spark's own aggregates with bounded state; with them in it, the
aggregate is hash-based also where it keeps the least and greatest text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampType,
)

from subsight.functions import percent
from subsight.operators.silver import READING_LOG_COLUMNS

ACCURACY = 65_535
DISTINCT_BITS = 17
TRACKED = 10_000
TOP = 5
QUARTILES = (("p25", 0.25), ("median", 0.5), ("p75", 0.75))
#: log2 of the readers a month's sketch holds before it estimates.
READER_BITS = 16


def _number(field) -> tuple[str, Column] | None:
    """Kind of the quantile sketch and the value as its number; None for other types."""
    c, t = F.col(f"`{field.name}`"), field.dataType
    if isinstance(t, (IntegralType, BooleanType)):
        return "bigint", c.cast("bigint")
    if isinstance(t, DateType):
        return "bigint", F.unix_date(c).cast("bigint")
    if isinstance(t, TimestampType):
        return "bigint", F.unix_micros(c)
    if isinstance(t, (DoubleType, FloatType, DecimalType)):
        return "double", c.cast("double") + F.lit(0.0)  # -0.0 is 0.0
    return None


def _as_text(number: Column, data_type: Column) -> Column:
    """A bigint of :func:`_number` as the text of its column's value."""
    return F.when(data_type == "date", F.date_from_unix_date(number.cast("int")).cast("string")) \
        .when(data_type == "timestamp", F.timestamp_micros(number).cast("string")) \
        .when(data_type == "boolean", (number == 1).cast("string")).otherwise(number.cast("string"))


def sketched(df: DataFrame, by: Sequence[str] = (), top: Sequence[str] = (), accuracy: int = ACCURACY,
             distinct_bits: int = DISTINCT_BITS, tracked: int = TRACKED) -> DataFrame:
    """One row per group of ``by`` and column: counts, text bounds and sketches; ``top`` names the columns whose values are tracked.

    Atomic columns of other types than numbers, dates, times and text are
    counted only; nested ones too. Texts are hashed by the distinct sketch
    and tracked whole, so ``top`` is for columns of short values.
    """
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        c, number, is_text = F.col(f"`{f.name}`"), _number(f), isinstance(f.dataType, StringType)
        none = F.lit(None).cast("binary")
        aggs.append(F.count(c).alias(f"n{i}"))
        for kind, agg in (("bigint", F.kll_sketch_agg_bigint), ("double", F.kll_sketch_agg_double)):
            mine = number and number[0] == kind
            aggs += [agg(number[1], F.lit(accuracy)).alias(f"{kind}{i}")] if mine else []
        value = number[1] if number else c
        if number or is_text:
            aggs.append(F.theta_sketch_agg(value, F.lit(distinct_bits)).alias(f"d{i}"))
        if is_text:
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        if f.name in top:
            aggs.append(F.call_function("approx_top_k_accumulate", c.cast("string"), F.lit(tracked)).alias(f"t{i}"))
        tracked_type = "struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("position"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("row_count"), F.col(f"n{i}").alias("non_null"),
            (F.col(f"bigint{i}") if number and number[0] == "bigint" else none).alias("q_bigint"),
            (F.col(f"double{i}") if number and number[0] == "double" else none).alias("q_double"),
            (F.col(f"d{i}") if number or is_text else none).alias("distinct"),
            (F.col(f"lo{i}") if is_text else F.lit(None).cast("string")).alias("lo"),
            (F.col(f"hi{i}") if is_text else F.lit(None).cast("string")).alias("hi"),
            (F.col(f"t{i}") if f.name in top else F.lit(None).cast(tracked_type)).alias("tracked")))
    # Group keys under other names: a key may be a profiled column as well.
    keyed = df.groupBy(*[F.col(k).alias(f"by_{k}") for k in by]).agg(*aggs)
    return keyed.select(*[F.col(f"by_{k}").alias(k) for k in by], F.inline(F.array(*rows)))


def merged(sketches: DataFrame, accuracy: int = ACCURACY, distinct_bits: int = DISTINCT_BITS, tracked: int = TRACKED) -> DataFrame:
    """One row per column from the rows of :func:`sketched` of any groups; no value is read again."""
    keys = ["column_name", "position", "data_type"]
    sums = sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.sum("non_null").alias("non_null"),
        F.kll_merge_agg_bigint("q_bigint", F.lit(accuracy)).alias("q_bigint"), F.kll_merge_agg_double("q_double", F.lit(accuracy)).alias("q_double"),
        F.theta_union_agg("distinct", F.lit(distinct_bits)).alias("distinct"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.count("distinct").alias("with_distinct"))
    tops = sketches.where("tracked IS NOT NULL").groupBy(F.col("column_name").alias("of")).agg(
        F.call_function("approx_top_k_combine", F.col("tracked"), F.lit(tracked)).alias("tracked"))
    return sums.withColumn("distinct", F.when(F.col("with_distinct") > 0, F.col("distinct"))).drop("with_distinct") \
        .join(tops, F.col("column_name") == F.col("of"), "left").drop("of")


def _quantile(at: float) -> Column:
    def of(kind: str, n, get) -> Column:
        sketch = F.col(f"q_{kind}")
        return F.when(F.coalesce(n(sketch), F.lit(0)) > 0, get(sketch, F.lit(float(at))))

    whole = of("bigint", F.kll_sketch_get_n_bigint, F.kll_sketch_get_quantile_bigint)
    broken = of("double", F.kll_sketch_get_n_double, F.kll_sketch_get_quantile_double)
    return F.coalesce(_as_text(whole, F.col("data_type")), broken.cast("string"))


def distribution(rows: DataFrame, top: int = TOP, tracked: int = TRACKED) -> DataFrame:
    """Per column: counts, distinct values, bounds, quartiles, and its ``top`` values as ``value: count``, most first, ties by text.

    Quartiles are values of the column: the least one with at least that
    share of the values up to it. Columns without a type for it have NULLs.
    """
    items = F.filter(F.call_function("approx_top_k_estimate", F.col("tracked"), F.lit(tracked)), lambda x: x.item.isNotNull())
    ordered = F.slice(F.array_sort(F.transform(items, lambda x: F.struct((-x["count"]).alias("n"), x.item.alias("item")))), 1, top)
    shown = F.array_join(F.transform(ordered, lambda x: F.concat(x.item, F.lit(": "), (-x.n).cast("string"))), ", ")
    return rows.select(
        "column_name", "position", "data_type", "row_count", (F.col("row_count") - F.col("non_null")).alias("null_count"),
        percent(F.col("row_count") - F.col("non_null"), F.col("row_count")).alias("null_pct"),
        F.theta_sketch_estimate("distinct").alias("distinct_count"),
        F.coalesce("lo", _quantile(0.0)).alias("min_value"), F.coalesce("hi", _quantile(1.0)).alias("max_value"),
        *[_quantile(q).alias(name) for name, q in QUARTILES],
        F.when(F.col("tracked").isNotNull(), shown).alias("top_values"))


# ---------------------------------------------------------------------------
# Readers over any period
# ---------------------------------------------------------------------------


def reader_sketches(activity: DataFrame, bits: int = READER_BITS) -> DataFrame:
    """Per (month, category) the readers as a distinct sketch; a NULL member is not a reader."""
    return activity.where("views > 0").groupBy("ym", "category").agg(F.theta_sketch_agg("member_id", F.lit(bits)).alias("readers"))


def _in_period(df: DataFrame, first: str | None, last: str | None, categories: Sequence[str] | None) -> DataFrame:
    if first is not None:
        df = df.where(F.col("ym") >= first)
    if last is not None:
        df = df.where(F.col("ym") <= last)
    return df if categories is None else df.where(F.col("category").isin(list(categories)))


def readers(sketches: DataFrame, first: str | None = None, last: str | None = None, categories: Sequence[str] | None = None,
            bits: int = READER_BITS) -> DataFrame:
    """Different readers of the months ``first`` to ``last`` (open ends: all) and ``categories``.

    A row per category (scope ``category``) and one for all of them (scope
    ``all``, category NULL): a union of unions, a reader of several
    categories counts once there. Reads a sketch per month and category.
    """
    per = _in_period(sketches, first, last, categories).groupBy("category").agg(F.theta_union_agg("readers", F.lit(bits)).alias("readers"))
    every = per.agg(F.theta_union_agg("readers", F.lit(bits)).alias("readers")) \
        .select(F.lit("all").alias("scope"), F.lit(None).cast("string").alias("category"), "readers")
    return per.select(F.lit("category").alias("scope"), "category", "readers").unionByName(every) \
        .select("scope", "category", F.theta_sketch_estimate("readers").alias("unique_readers"))


def readers_exact(activity: DataFrame, first: str | None = None, last: str | None = None,
                  categories: Sequence[str] | None = None) -> DataFrame:
    """:func:`readers`, counted: members collapse per category first, then over all."""
    read = _in_period(activity.where("views > 0"), first, last, categories).select("category", "member_id").distinct()
    per = read.groupBy(F.lit("category").alias("scope"), "category").agg(F.count("member_id").alias("unique_readers"))
    every = read.select("member_id").distinct().agg(F.count("member_id").alias("unique_readers")) \
        .select(F.lit("all").alias("scope"), F.lit(None).cast("string").alias("category"), "unique_readers")
    return per.unionByName(every)


#: Columns of the silver logs whose top values are tracked: short values, no keys of single rows.
LOG_TOP = ["event_type", "device", "category", "is_premium", "ym", "member_id", "article_id"]


def log_sketches(logs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of the silver logs; a month's are those of its partition alone."""
    return sketched(logs.select(*READING_LOG_COLUMNS), by, LOG_TOP)
