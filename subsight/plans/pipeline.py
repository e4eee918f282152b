"""The batch pipeline (P1): bronze -> silver -> gold as managed tables.

``run_silver`` writes the four silver tables, ``run_gold`` the activity
table and the three marts from the *stored* silver tables; ``run_pipeline``
runs both in order and stops before gold when silver raises. Each stored
table is the hand-over between steps, which also cuts the lineage: a lost
executor in the gold step recomputes from silver files, never from raw
input.

Full refreshes replace a table only once its new version is written. Logs,
activity and usage are partitioned by month. Row counts are observed during
the write, not recomputed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from subsight.functions import month_of
from subsight.lake import Lake
from subsight.model import ACTIVITY_TABLE, ARTICLE_INDEX, GOLD_TABLES, MONTHS_TABLE, OVERRIDES_TABLE, TOTALS_TABLE, USAGE_MONTH
from subsight.operators import cost, gold, silver
from subsight.plans import articles, refresh
from subsight.plans.metadata import apply_comments
from subsight.sources.bronze import register_bronze, write_table
from subsight.sources.catalog import USAGE_DAY_KEY, LakeConfig, read_table, set_table_property, table_exists, use_schema

ACTIVITY = ACTIVITY_TABLE
MARTS = GOLD_TABLES


def ingest_bronze(spark: SparkSession, config: LakeConfig, inputs: Lake,
                  max_records_per_file: int | None = None) -> dict[str, int]:
    """Store the four raw inputs of ``inputs`` as ``bronze_*`` tables."""
    use_schema(spark, config)
    return {
        f"bronze_{name}": register_bronze(inputs[f"bronze_{name}"], config, name, max_records_per_file)
        for name in ("members", "articles", "reading_logs", "subscriptions")
    }


def ingest_billing(spark: SparkSession, config: LakeConfig, inputs: Lake,
                   max_records_per_file: int | None = None) -> dict[str, int]:
    """Store the billing inputs of ``inputs``: ``usage``, partitioned by the
    month of its day and clustered by day, and ``list_prices``. A window of
    days opens the files of its months only and skips pages within them.
    The newest day is kept as a table property, so that such windows are
    literals."""
    use_schema(spark, config)
    usage = inputs["usage"].withColumn(USAGE_MONTH, month_of("usage_date"))
    counts = {
        "usage": write_table(usage, config, "usage", max_records_per_file,
                             cluster_by=["usage_date"], partition_by=[USAGE_MONTH]),
        "list_prices": write_table(inputs["list_prices"], config, "list_prices"),
    }
    newest = cost.latest_usage_day(read_table(spark, config, "usage"))
    if newest is not None:  # set by whoever writes the table; a table written without it is asked for its newest day
        set_table_property(spark, config, "usage", USAGE_DAY_KEY, newest.isoformat())
    return counts


def run_silver(spark: SparkSession, config: LakeConfig, inputs: Lake | None = None,
               log_files: str | None = None) -> dict[str, int]:
    """Bronze -> silver. ``inputs`` defaults to the stored bronze tables.

    With ``log_files`` (a path or glob of raw reading-log files), the
    reading logs are maintained incrementally by the stream of
    :mod:`subsight.streaming.incremental` instead of a full refresh; a
    table owned by that stream is never overwritten by the full refresh.
    The reported count of such a table is the sum of its files' row counts
    (file footers are read, no rows).
    """
    from subsight.streaming.incremental import run_incremental, stream_owned

    use_schema(spark, config)
    if log_files is None and stream_owned(spark, config, "silver_reading_logs"):
        raise ValueError(f"{config.fqn('silver_reading_logs')} is maintained by the incremental "
                         "stream; pass log_files, or use another schema for a full refresh")
    src = inputs if inputs is not None else Lake.from_catalog(spark, config)
    counts = {
        "silver_members": write_table(silver.silver_members(src["bronze_members"]),
                                      config, "silver_members"),
        "silver_articles": write_table(silver.silver_articles(src["bronze_articles"]),
                                       config, "silver_articles"),
    }
    # the logs take their article attributes from the stored articles
    if log_files is not None:
        run_incremental(spark, config, log_files)
        counts["silver_reading_logs"] = read_table(spark, config, "silver_reading_logs").count()
    else:
        stored_articles = read_table(spark, config, "silver_articles")
        counts["silver_reading_logs"] = write_table(
            silver.silver_reading_logs(src["bronze_reading_logs"], stored_articles), config,
            "silver_reading_logs", partition_by=["ym"])
        for table in (OVERRIDES_TABLE, ARTICLE_INDEX):  # the logs are of today's articles
            spark.sql(f"DROP TABLE IF EXISTS {config.fqn(table)}")
    counts["silver_subscriptions"] = write_table(
        silver.silver_subscriptions(src["bronze_subscriptions"]), config, "silver_subscriptions")
    apply_comments(spark, config, ["silver_subscriptions"])
    return counts


def run_gold(spark: SparkSession, config: LakeConfig) -> dict[str, int]:
    """Silver -> gold, from the stored silver tables: the logs are read once,
    into the activity table (partitioned by month), everything else from it:
    a row per month, the members' totals, the marts."""
    use_schema(spark, config)
    logs = articles.current_logs(spark, config)
    counts = {ACTIVITY: write_table(gold.member_month_activity(logs), config, ACTIVITY, partition_by=["ym"])}
    activity = read_table(spark, config, ACTIVITY)
    members = read_table(spark, config, "silver_members")
    write_table(gold.log_months(activity), config, MONTHS_TABLE)
    counts[TOTALS_TABLE] = write_table(gold.member_totals(activity), config, TOTALS_TABLE)
    marts = {
        "gold_monthly_engagement": gold.monthly_engagement(activity),
        "gold_member_segment": gold.member_segment(members, read_table(spark, config, TOTALS_TABLE)),
        "gold_paywall_conversion": gold.paywall_conversion(activity, members),
    }
    counts.update({name: write_table(mart, config, name) for name, mart in marts.items()})
    apply_comments(spark, config, MARTS)
    return counts


def run_sketches(spark: SparkSession, config: LakeConfig) -> dict[str, int]:
    """Stores the sketches of the logs' columns and of the readers, a partition
    per month. From then on a refresh makes those of its months anew; after a
    full refresh (``run_gold``) they are made anew by this step."""
    use_schema(spark, config)
    return refresh.write_sketches(spark, config)


def index_articles(spark: SparkSession, config: LakeConfig) -> None:
    """Stores which articles each month's logs have, so that later changes of
    their attributes reach the marts (:func:`refresh_articles`)."""
    use_schema(spark, config)
    articles.write_index(spark, config, articles.current_logs(spark, config))


def refresh_articles(spark: SparkSession, config: LakeConfig, months: list[str] = ()) -> dict[str, int]:
    """Puts changed article attributes into force in the months that have
    logs of those articles, beside ``months``; see
    :mod:`subsight.plans.articles`."""
    use_schema(spark, config)
    found = articles.propagate(spark, config)
    return refresh_months(spark, config, sorted({*months, *(found or ())})) if found is not None or months else {}


def run_pipeline(spark: SparkSession, config: LakeConfig, inputs: Lake | None = None,
                 log_files: str | None = None) -> dict[str, int]:
    """silver, then gold; gold does not start when silver raises.

    With ``log_files``, logs are appended by the stream, and where the
    activity table exists only the months whose logs have grown are
    recomputed (:func:`grown_months`).
    """
    counts = run_silver(spark, config, inputs, log_files)
    if log_files is not None and table_exists(spark, config, ACTIVITY):
        months = grown_months(spark, config)
        if table_exists(spark, config, ARTICLE_INDEX):
            months = sorted({*months, *(articles.propagate(spark, config) or ())})
        counts.update(refresh_months(spark, config, months))
        return counts
    counts.update(run_gold(spark, config))
    return counts


def grown_months(spark: SparkSession, config: LakeConfig) -> list[str]:
    """Months of which the logs hold another number of events than the
    activity, months that only one of them has included.

    Found from the stored tables themselves, so a run that stopped between
    silver and gold is made up for by the next. Logs are counted from file
    footers (the month is their partition), the activity's events are kept a
    row per month. The result has at most one text per month.
    """
    logs = read_table(spark, config, "silver_reading_logs").groupBy("ym").agg(F.count(F.lit(1)).alias("n"))
    done = read_table(spark, config, MONTHS_TABLE).select("ym", F.col("events").alias("m"))
    both = logs.join(done, "ym", "full").where("NOT n <=> m AND ym IS NOT NULL")
    return sorted(r["ym"] for r in both.select("ym").collect())


def refresh_months(spark: SparkSession, config: LakeConfig, months: list[str]) -> dict[str, int]:
    """Bring the marts up to date after the logs of ``months`` changed.

    Of logs and activity only those months are read (and always the logs
    whose time does not parse: they have no month, and any file may bring
    some), plus, for members whose last day fell, their latest other month;
    see :mod:`subsight.plans.refresh`. Months that lost all their logs and
    members whose age band changed are followed as well. Running it twice
    changes nothing, and the result equals ``run_gold`` over all logs (both
    checked by the tests). A run that was killed is finished first. Without
    the tables it needs (a lake written before them) it is ``run_gold``.
    """
    use_schema(spark, config)
    if not all(table_exists(spark, config, t) for t in (ACTIVITY, MONTHS_TABLE, TOTALS_TABLE, *MARTS)):
        return run_gold(spark, config)
    counts: dict[str, int] = {}
    left = refresh.pending(spark, config)
    if left:
        counts = refresh.apply(spark, config, *left)
    months = sorted({m for m in months if m is not None})
    counts.update(refresh.apply(spark, config, refresh.stage(spark, config, months), months))
    apply_comments(spark, config, MARTS)
    return counts
