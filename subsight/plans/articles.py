"""Late article attributes: a changed article reaches the logs that were taken before.

A silver log carries the category and premium flag its article had when the
log was taken; logs appended by the stream are never joined again. An index
holds, per month, the articles of its logs with the attributes in force
there (exact, a row per month and article). Comparing it with the articles
tells which changed and which months have logs of them. The new attributes
are kept as overrides, applied where logs are read (:func:`current_logs`),
so no log file is rewritten and the stream's table stays its own; the
months found are refreshed, and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight.model import ARTICLE_INDEX, OVERRIDES_TABLE
from subsight.sources.bronze import replace_partitions, write_table
from subsight.sources.catalog import LakeConfig, read_table, table_exists

ATTRIBUTES = ["category", "is_premium"]


def current_logs(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """The stored silver logs with the attributes their articles have now.

    Scale: the overrides hold changed articles only, a row each, so the join
    is a size-checked broadcast unless they are very many; without overrides
    there is no join."""
    logs = read_table(spark, config, "silver_reading_logs")
    if not table_exists(spark, config, OVERRIDES_TABLE):
        return logs
    new = read_table(spark, config, OVERRIDES_TABLE).select(F.col("article_id").alias("of_article"), F.struct(*ATTRIBUTES).alias("new"))
    return logs.join(new, logs.article_id == new.of_article, "left").select(*[
        F.when(F.col("of_article").isNotNull(), F.col(f"new.{c}")).otherwise(logs[c]).alias(c) if c in ATTRIBUTES else logs[c]
        for c in logs.columns])


def article_index(logs: DataFrame) -> DataFrame:
    """The articles of each month's logs with their attributes. NULL ids have none."""
    return logs.where("article_id IS NOT NULL").groupBy("ym", "article_id").agg(*[F.first(c).alias(c) for c in ATTRIBUTES])


def write_index(spark: SparkSession, config: LakeConfig, logs: DataFrame, months: list[str] | None = None) -> None:
    """The index of all months, or anew that of ``months`` (``logs`` are theirs and those without a month)."""
    made = article_index(logs)
    if months is None or not table_exists(spark, config, ARTICLE_INDEX):
        write_table(made, config, ARTICLE_INDEX, partition_by=["ym"])
        return
    here = {r[0] for r in logs.where("article_id IS NOT NULL").select("ym").distinct().collect()}
    replace_partitions(made, config, ARTICLE_INDEX, ["ym"], emptied=[m for m in [None, *months] if m not in here])


def changed_articles(index: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles with logs whose attributes are others now: ``article_id, category, is_premium``; gone ones have NULLs."""
    was = index.select("article_id", F.struct(*ATTRIBUTES).alias("was")).distinct()
    now = articles.select("article_id", F.struct(*ATTRIBUTES).alias("now"))
    nothing = F.struct(*[F.lit(None).cast(articles.schema[c].dataType).alias(c) for c in ATTRIBUTES])
    both = was.join(now, "article_id", "left").withColumn("now", F.coalesce("now", nothing))
    return both.where("NOT was <=> now").select("article_id", *[F.col(f"now.{c}").alias(c) for c in ATTRIBUTES]).distinct()


def propagate(spark: SparkSession, config: LakeConfig) -> list[str] | None:
    """Puts changed attributes into force and returns the months to refresh, or None if no article with logs changed.

    The index is made anew by the refresh, so repeating this before it gives the same months."""
    if not table_exists(spark, config, ARTICLE_INDEX):
        return None
    index = read_table(spark, config, ARTICLE_INDEX)
    articles = read_table(spark, config, "silver_articles").dropDuplicates(["article_id"])
    changed = changed_articles(index, articles)
    months = [r[0] for r in index.join(changed.select("article_id"), "article_id", "left_semi").select("ym").distinct().collect()]
    if not months:
        return None
    if table_exists(spark, config, OVERRIDES_TABLE):
        kept = read_table(spark, config, OVERRIDES_TABLE).join(changed.select("article_id"), "article_id", "left_anti")
        changed = changed.unionByName(kept)
    write_table(changed, config, OVERRIDES_TABLE)
    return sorted(m for m in months if m is not None)  # logs without a month belong to every refresh
