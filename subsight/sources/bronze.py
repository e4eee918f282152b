"""Bronze ingest (A1-A3, A7, A8): raw files read on the executors with a
declared schema and stored unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subsight.model import BRONZE_SCHEMAS
from subsight.sources.catalog import LakeConfig, set_table_property


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read one raw input with the declared bronze schema (no inference, no
    conversion). ``fmt`` is any batch format Spark reads (parquet, csv,
    json, orc)."""
    schema = BRONZE_SCHEMAS[name]
    reader = spark.read.schema(schema).options(**options)
    df = reader.format(fmt).load(path)
    return df.select(*schema.fieldNames())


#: Formats without transactions: a new version is written beside the table and then takes its name.
FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro"}


def write_table(df: DataFrame, config: LakeConfig, table: str,
                max_records_per_file: int | None = None,
                cluster_by: list[str] | None = None,
                partition_by: list[str] | None = None,
                properties: dict[str, str] | None = None) -> int:
    """Full-refresh write of a managed table; returns the row count.

    The new version is written in full as ``<table>__next``; then the old one
    is dropped and the new one takes its name. A write that fails or is
    killed leaves the old version readable, and ``df`` may read the table it
    replaces. Between drop and rename the name is missing for a moment, and
    readers fail then (a transactional format has no such moment); a driver
    killed right there leaves the new version whole under ``<table>__next``,
    and ``recover_tables``, which every run starts with, gives it its name.
    Table ``properties`` come with the new version.

    The count is an observed metric of the write job itself, so the plan is
    not run a second time to report it. ``max_records_per_file`` splits the
    output of a large task into several files (no shuffle).
    ``partition_by`` stores a folder per value, so filters on it leave out
    whole files; a rebalancing shuffle brings the rows of a value together
    first (adaptive execution splits large values over several tasks and
    merges small ones), so the number of files follows the data, not tasks
    times values. ``cluster_by`` sorts each task's rows, so filters on those
    columns skip row groups and pages within the files.
    """
    obs = Observation(f"rows_{table}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    order = [*(partition_by or []), *(cluster_by or [])]
    if order:
        df = df.sortWithinPartitions(*order)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = (observed.write.format(config.fmt).mode("overwrite")
              .option("overwriteSchema", "true"))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    if config.fmt in FILE_FORMATS:
        writer.saveAsTable(config.fqn(f"{table}__next"))
        _set_properties(df, config, f"{table}__next", properties)
        spark.sql(f"DROP TABLE IF EXISTS {config.fqn(table)}")
        spark.sql(f"ALTER TABLE {config.fqn(f'{table}__next')} RENAME TO {config.schema}.{table}")
        if partition_by:  # catalogs that keep partition folders by path learn the new ones
            spark.sql(f"MSCK REPAIR TABLE {config.fqn(table)} SYNC PARTITIONS")
    else:
        writer.saveAsTable(config.fqn(table))
        _set_properties(df, config, table, properties)
    return int(obs.get["rows"])


def _set_properties(df: DataFrame, config: LakeConfig, table: str, properties: dict[str, str] | None) -> None:
    for key, value in (properties or {}).items():
        set_table_property(df.sparkSession, config, table, key, value)


def replace_partitions(df: DataFrame, config: LakeConfig, table: str, partition_by: list[str],
                       emptied: list[str | None] = ()) -> int:
    """Write ``df`` over the partitions of ``table`` that it has rows for; the
    others are not touched or read. Returns the row count. Files move into
    place when the job commits, so a failed write changes nothing. Partitions
    ``emptied`` (values of the one partition column) have no rows any more
    and are dropped."""
    spark = df.sparkSession
    columns = spark.table(config.fqn(table)).columns
    for value in emptied:
        text = "null" if value is None else "'" + value.replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {config.fqn(table)} DROP IF EXISTS PARTITION ({partition_by[0]} = {text})")
    obs = Observation(f"rows_{table}")
    rows = (df.select(*columns).hint("rebalance", *partition_by).sortWithinPartitions(*partition_by)
            .observe(obs, F.count(F.lit(1)).alias("rows")))
    mode = "spark.sql.sources.partitionOverwriteMode"  # insertInto takes it from the session only
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(config.fqn(table))
    finally:
        spark.conf.set(mode, before)
    return int(obs.get["rows"])


def register_bronze(df: DataFrame, config: LakeConfig, name: str,
                    max_records_per_file: int | None = None) -> int:
    """Store a bronze input as ``bronze_<name>``; returns its row count."""
    schema = BRONZE_SCHEMAS[name]
    return write_table(df.select(*schema.fieldNames()), config, f"bronze_{name}",
                       max_records_per_file)
