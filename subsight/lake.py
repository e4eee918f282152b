"""Name resolution of the model's tables.

A :class:`Lake` hands out DataFrames by table name. Inputs come from
loaders (stored tables, raw files, or the test-table mapping); silver and
gold tables come from storage when they were written by the pipeline, and
are otherwise derived lazily from their inputs, so a query over a gold mart
is one Catalyst plan from the scan up (pruning and pushdown cross the
layers).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subsight.model import ACTIVITY_TABLE, READERS_TABLE
from subsight.operators import gold, silver, sketches

Loader = Callable[[], DataFrame]

DERIVED: dict[str, Callable[["Lake"], DataFrame]] = {
    "silver_members": lambda lk: silver.silver_members(lk["bronze_members"]),
    "silver_articles": lambda lk: silver.silver_articles(lk["bronze_articles"]),
    "silver_reading_logs": lambda lk: silver.silver_reading_logs(
        lk["bronze_reading_logs"], lk["silver_articles"]),
    "silver_subscriptions": lambda lk: silver.silver_subscriptions(lk["bronze_subscriptions"]),
    ACTIVITY_TABLE: lambda lk: gold.member_month_activity(lk["silver_reading_logs"]),
    READERS_TABLE: lambda lk: sketches.reader_sketches(
        lk[ACTIVITY_TABLE] if lk.stored(ACTIVITY_TABLE) else gold.reading_activity(lk["silver_reading_logs"])),
    "gold_monthly_engagement": lambda lk: gold.monthly_engagement(
        lk[ACTIVITY_TABLE] if lk.stored(ACTIVITY_TABLE) else gold.reading_activity(lk["silver_reading_logs"])),
    "gold_member_segment": lambda lk: gold.member_segment(
        lk["silver_members"], lk[ACTIVITY_TABLE] if lk.stored(ACTIVITY_TABLE) else gold.member_activity(lk.log_events())),
    "gold_paywall_conversion": lambda lk: gold.paywall_conversion(
        lk[ACTIVITY_TABLE] if lk.stored(ACTIVITY_TABLE) else lk.log_events(), lk["silver_members"]),
}


class Lake:
    def __init__(self, spark: SparkSession, loaders: dict[str, Loader]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._cache: dict[str, DataFrame] = {}
        self._usage_day: Callable[[], datetime.date | None] = lambda: None

    def stored(self, name: str) -> bool:
        """Whether the table is an input or was written, not derived here."""
        return name in self._loaders

    def log_events(self) -> DataFrame:
        """Typed logs for answers that use no article attribute: the stored logs, else the raw ones without the join."""
        if self.stored("silver_reading_logs"):
            return self["silver_reading_logs"]
        return silver.log_events(self["bronze_reading_logs"])

    def usage_day(self) -> datetime.date | None:
        """The newest usage day kept with the stored usage, so date windows are literals; None if none is kept."""
        return self._usage_day()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in self._loaders:
                df = self._loaders[name]()
            elif name in DERIVED:
                df = DERIVED[name](self)
            else:
                raise KeyError(f"unknown table {name!r}")
            self._cache[name] = df
        return self._cache[name]

    def names(self) -> list[str]:
        return sorted(set(self._loaders) | set(DERIVED))

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Lake":
        """Inputs mapped from the driver's test tables."""
        from subsight.sources import testdata

        return cls(spark, testdata.sources(spark, sf_dir))

    @classmethod
    def from_catalog(cls, spark: SparkSession, config, extra: dict[str, Loader] | None = None) -> "Lake":
        """Every table that exists in ``config``'s namespace is read from
        storage; missing silver/gold tables are derived."""
        from subsight.model import BILLING_TABLES, BRONZE_TABLES, GOLD_TABLES, MONTHS_TABLE, SILVER_TABLES, SKETCH_TABLE, TOTALS_TABLE
        from subsight.plans import articles
        from subsight.sources.catalog import USAGE_DAY_KEY, read_table, table_exists, table_property

        names = [*(f"bronze_{t}" for t in BRONZE_TABLES), *SILVER_TABLES, ACTIVITY_TABLE, MONTHS_TABLE, TOTALS_TABLE, SKETCH_TABLE, READERS_TABLE,
                 *GOLD_TABLES, *BILLING_TABLES]
        loaders: dict[str, Loader] = {}
        for name in names:
            if table_exists(spark, config, name):
                loaders[name] = (lambda n=name: read_table(spark, config, n))
        if "silver_reading_logs" in loaders:  # stored with the partition column last
            loaders["silver_reading_logs"] = lambda: articles.current_logs(spark, config).select(*silver.READING_LOG_COLUMNS)
        loaders.update(extra or {})
        lake = cls(spark, loaders)
        if "usage" in loaders and "usage" not in (extra or {}):
            day = table_property(spark, config, "usage", USAGE_DAY_KEY)
            lake._usage_day = lambda: datetime.date.fromisoformat(day) if day else None
        return lake

    @classmethod
    def from_files(cls, spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", **options) -> "Lake":
        """Raw inputs read from files: ``paths`` maps members, articles,
        reading_logs and subscriptions to a path or glob each, read with the
        declared schemas. Options are those of the file format."""
        from subsight.sources.bronze import read_raw

        return cls(spark, {f"bronze_{name}": (lambda n=name, p=path: read_raw(spark, n, p, fmt, **options))
                           for name, path in paths.items()})

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> "Lake":
        """Inputs given as DataFrames (unit tests)."""
        return cls(spark, {k: (lambda v=v: v) for k, v in frames.items()})
