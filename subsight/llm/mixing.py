"""Mixing sources to target weights along a curriculum, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsight.llm.tables import stored

#: (weight at the start, weight at the end) of the sources in code point order, repeating; the integrals are 5, 2 and 1.
SCHEDULES = ((6.0, 4.0), (2.0, 2.0), (0.5, 1.5))
MAX_REPEATS = 3
#: Hexadecimal digits of the order key that split a source for its prefix sums: 16^3 buckets.
BUCKET_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def _key(source: Column) -> Column:
    """A key without nulls; the null source sorts by its own rule, not by this key."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def _order(id_col: str, text_col: str) -> Column:
    """A fixed pseudo-random order: the same documents are taken on every run, on any partitioning."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.md5(F.col(text_col)), F.lit(""))))


def sized(docs: DataFrame, keep: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """Rows of ``docs`` as ``kept`` (a struct of ``keep``) with size, source key, order key and bucket."""
    ordered = docs.select(
        F.struct(*keep).alias("kept"),
        F.col(source_col).alias("source"), _key(F.col(source_col)).alias("skey"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _order(id_col, text_col).alias("okey"))
    return ordered.withColumn("bucket", F.substring("okey", 1, BUCKET_DIGITS))


def targets(buckets: DataFrame, schedules: Sequence[tuple[float, float]], max_repeats: int) -> DataFrame:
    """Per source: ``skey, source_size, slope, target``, from its bucket sizes.

    Sources in code point order (null last) take the schedules in turn; a
    schedule's integral is the source's weight. Targets share the sum of all
    sizes by weight and stop at ``max_repeats`` times the source's size, the
    excess going to the others by weight. In the order of cap / weight the
    level (what remains / weights that remain) rises while sources are
    capped and falls after, so its maximum is the common level, and a
    target is the lesser of cap and weight times level. The windows run
    over one row per source.
    """
    per = buckets.groupBy("source", "skey").agg(F.sum("bytes").alias("source_size"))
    at = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(schedules) + 1
    pair = F.element_at(F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in schedules]), at)
    per = per.select("skey", "source_size", pair.alias("s")).select(
        "skey", "source_size", ((F.col("s.a") + F.col("s.b")) / 2).alias("weight"),
        ((F.col("s.b") - F.col("s.a")) / (F.col("s.a") + F.col("s.b"))).alias("slope"),
        (F.col("source_size") * max_repeats).alias("cap"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    per = per.select(
        "*", F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)).alias("rest"))
    level = F.max((F.col("total") - F.col("before")) / F.col("rest")).over(everything)
    return per.select("skey", "source_size", "slope", "cap", "weight", level.alias("level")).select(
        "skey", "source_size", "slope",
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def assigned(rows: DataFrame, schedules: Sequence[tuple[float, float]] = SCHEDULES,
             max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``rows`` of ``sized`` with source_size, target, slope, copies and the words before each in its source.

    Prefix sums in two steps: over the bucket totals of a source, then within
    a bucket, so a source with a third of all rows is summed by thousands of
    groups. A row has floor(target / source_size) copies, and one more if its
    middle lies in the words that the last, partial pass takes.
    """
    buckets = rows.groupBy("source", "skey", "bucket").agg(F.sum("size").alias("bytes"))
    mine = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("skey", "bucket", F.coalesce(F.sum("bytes").over(mine), F.lit(0)).alias("offset")) \
        .join(targets(buckets, schedules, max_repeats), "skey")
    within = Window.partitionBy("skey", "bucket").orderBy("okey", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.drop("source").withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))) \
        .join(offsets, ["skey", "bucket"]).withColumn("before", F.col("offset") + F.col("inside"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    out = out.withColumn("passes", passes.cast("long"))
    partial = F.col("target") - F.col("passes") * F.col("source_size")
    return out.withColumn("copies", F.col("passes") + F.when(F.col("before") * 2 + F.col("size") < partial * 2, 1).otherwise(0))


def position(repeat: Column) -> Column:
    """Training position in [0, 1] of a row's copy number ``repeat``: its source's cumulative demand, inverted.

    A source's demand up to time t is target * ((1 - slope) t + slope t^2);
    the middle word of a copy is taken when demand reaches it.
    """
    words = F.col("before") + repeat * F.col("source_size") + F.col("size") / 2
    u = F.when(F.col("target") > 0, F.least(F.lit(1.0), words / F.col("target"))).otherwise(F.lit(0.0))
    flat = F.lit(1.0) - F.col("slope")
    root = flat + F.sqrt(flat * flat + F.col("slope") * 4 * u)
    return F.when(root > 0, u * 2 / root).otherwise(F.lit(0.0))


def mix_documents(docs: DataFrame, schedules: Sequence[tuple[float, float]] = SCHEDULES,
                  max_repeats: int = MAX_REPEATS, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, source_size, target, taken, copies, first_position``.

    Size is the number of words, 0 for null or empty text (such rows take 0
    words). Null is a source of its own, the last one. Rows that repeat an id
    are rows of their own; rows equal in id and text are interchangeable. An
    empty table gives an empty result. Very long texts count whole, so one may
    be more than a source's whole target: it is taken if its middle is. Other columns are not read.
    ``first_position`` is null for rows not taken.
    """
    rows = stored(sized(docs, [id_col], id_col, text_col, source_col), "sizes")
    return assigned(rows, schedules, max_repeats).select(
        f"kept.{id_col}", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies",
        F.when(F.col("copies") > 0, position(F.lit(0))).alias("first_position"))


def training_order(docs: DataFrame, schedules: Sequence[tuple[float, float]] = SCHEDULES,
                   max_repeats: int = MAX_REPEATS, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """The mix itself: the columns of ``docs`` and ``size, source_size, target, taken, repeat, position``.

    A row of ``docs`` occurs once for each copy taken, range-partitioned and
    sorted by training position, so the written files in order are the
    training order. An input column with the name of an added one is
    replaced. Nulls and empty texts as in ``mix_documents``; rows without
    words are not part of the order.
    """
    added = ["size", "source_size", "target", "taken", "repeat", "position"]
    keep = [c for c in docs.columns if c not in added]
    rows = assigned(sized(docs, keep, id_col, text_col, source_col), schedules, max_repeats)
    copies = rows.where("copies > 0 and size > 0") \
        .withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))) \
        .withColumn("taken", F.col("size") * F.col("copies")).withColumn("position", position(F.col("repeat")))
    return copies.select(*[F.col("kept").getField(c).alias(c) for c in keep], *added) \
        .repartitionByRange("position", id_col).sortWithinPartitions("position", id_col)
