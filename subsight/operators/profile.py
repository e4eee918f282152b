"""Column profile of a table (Q32): rows, NULLs, NULL %, distinct values,
min and max per column, and optionally the quartiles of numeric and time
columns.

Two aggregates, each one pass over the input:

* a global aggregate (no grouping key) of row count, non-NULL count, min
  and max of every column: one row out, unpivoted into one row per column;
* distinct counts. ``"exact"`` unpivots every row into (column, key)
  pairs, de-duplicates them (map-side first, so a value held by a third of
  the rows collapses before the shuffle) and counts pairs per column: one
  hash shuffle of the distinct keys, 16 bytes each at most whatever the
  values' length, instead of Catalyst's per-column
  expansion of ``count(DISTINCT a), count(DISTINCT b), ...`` into a sort
  aggregate. ``"approx"`` uses HyperLogLog++ (``approx_count_distinct``)
  inside the first aggregate: bounded memory, no shuffle of values; the
  choice for very wide or very large tables.

Integral, date and time values have a 64-bit number as their key (no text
formatting in the hot path; times without a zone are not moved through the
session's zone, where two of them can fall together); other atomic values
the full 128-bit MD5 of their text form, which is one-to-one (floating -0.0
is folded into 0.0 first, as Spark's grouping does). Nested columns have no
distinct count, minimum or maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NumericType,
    ShortType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from subsight.functions import percent


def _atomic(field) -> bool:
    return not isinstance(field.dataType, (StructType, ArrayType, MapType))


def _wall_micros(c: Column) -> Column:
    """Microseconds of a time without a zone, from its own fields."""
    seconds = F.unix_date(c.cast("date")).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECONDS"), c) * 1000000).cast("bigint")


def _as_key(field) -> tuple[Column, Column]:
    """(number, digest) key of a value; exactly one is set for non-NULLs."""
    c = F.col(f"`{field.name}`")
    t = field.dataType
    none_num, none_bin = F.lit(None).cast("bigint"), F.lit(None).cast("binary")
    if isinstance(t, (LongType, IntegerType, ShortType, ByteType, BooleanType)):
        return c.cast("bigint"), none_bin
    if isinstance(t, DateType):
        return F.unix_date(c).cast("bigint"), none_bin
    if isinstance(t, TimestampType):
        return F.unix_micros(c), none_bin
    if isinstance(t, TimestampNTZType):
        return _wall_micros(c), none_bin
    if isinstance(t, (DoubleType, FloatType)):
        c = c + F.lit(0.0)
    return none_num, F.unhex(F.md5(c.cast("string")))


QUARTILES = [0.25, 0.5, 0.75]


def _orderable_number(field) -> bool:
    return isinstance(field.dataType, (NumericType, DateType, TimestampType, TimestampNTZType))


def table_profile(df: DataFrame, distinct: str = "exact", rsd: float = 0.05,
                  quartiles: bool = False, accuracy: int = 10000) -> DataFrame:
    """One row per column. ``quartiles=True`` adds the distribution of
    numeric and time columns (``p25``, ``median``, ``p75``) from
    ``percentile_approx``: a bounded-memory sketch inside the same global
    aggregate (rank error about 1/``accuracy``), where an exact percentile
    would gather a whole column into one buffer."""
    if distinct not in ("exact", "approx", "none"):
        raise ValueError("distinct must be exact, approx or none")
    fields = list(df.schema.fields)

    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"nn{i}"))
        lo = F.min(c).cast("string") if _atomic(f) else F.lit(None).cast("string")
        hi = F.max(c).cast("string") if _atomic(f) else F.lit(None).cast("string")
        aggs += [lo.alias(f"lo{i}"), hi.alias(f"hi{i}")]
        if distinct == "approx" and _atomic(f):
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"nd{i}"))
        else:
            aggs.append(F.lit(None).cast("bigint").alias(f"nd{i}"))
        if quartiles and _orderable_number(f):
            q = F.percentile_approx(c, QUARTILES, accuracy)
            aggs.append(F.transform(q, lambda x: x.cast("string")).alias(f"q{i}"))
        elif quartiles:
            aggs.append(F.lit(None).cast("array<string>").alias(f"q{i}"))
    extra = (lambda i: [F.col(f"q{i}")[0].alias("p25"), F.col(f"q{i}")[1].alias("median"),
                        F.col(f"q{i}")[2].alias("p75")]) if quartiles else (lambda i: [])
    per_column = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i + 1).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"nn{i}").alias("non_null"),
            F.col(f"nd{i}").alias("distinct_count"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
            *extra(i),
        )
        for i, f in enumerate(fields)
    ])
    stats = df.agg(*aggs).select("rows", F.inline(per_column))

    if distinct == "exact" and any(map(_atomic, fields)):
        pairs = F.array(*[
            F.struct(F.lit(i + 1).alias("position"), num.alias("num"), digest.alias("digest"))
            for i, f in enumerate(fields) if _atomic(f)
            for num, digest in [_as_key(f)]
        ])
        counts = (
            df.select(F.inline(pairs))
            .filter(F.col("num").isNotNull() | F.col("digest").isNotNull())
            .distinct()
            .groupBy("position").agg(F.count(F.lit(1)).alias("exact_distinct"))
        )
        nested = [i + 1 for i, f in enumerate(fields) if not _atomic(f)]
        stats = (stats.join(counts, on="position", how="left")
                 .withColumn("distinct_count",
                             F.when(~F.col("position").isin(nested), F.coalesce("exact_distinct", F.lit(0)))))

    return stats.select(
        "column_name", "position", "data_type",
        F.col("rows").alias("row_count"),
        (F.col("rows") - F.col("non_null")).alias("null_count"),
        percent(F.col("rows") - F.col("non_null"), F.col("rows")).alias("null_pct"),
        "distinct_count", "min_value", "max_value",
        *(["p25", "median", "p75"] if quartiles else []),
    )
