"""Incremental silver reading logs.

Reading logs only grow. Instead of re-running the full-refresh transform
over all history, ``ingest_reading_logs`` reads the bronze log *files* as a
stream, applies the same silver transform (a stream-static left join to
the stored ``silver_articles``) and appends to a silver table. With
``availableNow`` the stream processes every file not yet seen, in bounded
micro-batches, then stops: a batch job that does only the new work. The
checkpoint in the cluster's checkpoint folder records which files were
done, so a rerun after a lost executor or driver repeats no file and skips
none (exactly-once file sink).

A log is joined once, with the articles of the day it arrives; attributes
that change later are put into force by :mod:`subsight.plans.articles`,
after which the result equals the full refresh.

The stream owns its target table. The file sink lists the files it
committed in ``_spark_metadata`` inside the table folder, and readers then
read only those files: rows written into the same table by a batch job
would no longer be read. So the stream creates its target itself, with the
properties ``subsight.maintained_by = stream`` and
``subsight.stream_checkpoint``, before the first file is written, and
refuses a target it did not create; the batch full refresh refuses a
stream-owned table in turn (``subsight.plans.pipeline``).

Checkpoint and target belong together: the sink skips a batch number that
its log already has. The checkpoint's path is kept with the table, so every
later driver continues with the same one, and a start with an empty
checkpoint on a target that has committed files, or with the checkpoint of
another table, is refused instead of losing files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from subsight.model import READING_LOGS_SCHEMA
from subsight.operators import silver
from subsight.plans.session import checkpoint_base
from subsight.sources.catalog import LakeConfig, read_table, table_exists, table_property

OWNER_KEY = "subsight.maintained_by"
OWNER_STREAM = "stream"
CHECKPOINT_KEY = "subsight.stream_checkpoint"
PARTITION = "ym"


def stream_owned(spark: SparkSession, config: LakeConfig, table: str) -> bool:
    return (table_exists(spark, config, table)
            and table_property(spark, config, table, OWNER_KEY) == OWNER_STREAM)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _create(spark: SparkSession, config: LakeConfig, target: str, logs: DataFrame, checkpoint: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in logs.schema.fields)
    kept = checkpoint.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {config.fqn(target)} ({columns}) USING {config.fmt} PARTITIONED BY ({PARTITION}) "
              f"TBLPROPERTIES ('{OWNER_KEY}' = '{OWNER_STREAM}', '{CHECKPOINT_KEY}' = '{kept}')")


def _checkpoint_of(spark: SparkSession, config: LakeConfig, target: str, given: str | None) -> str:
    """The checkpoint that the target's files were committed with."""
    location = given or table_property(spark, config, target, CHECKPOINT_KEY)
    folder = (spark.sql(f"DESCRIBE TABLE EXTENDED {config.fqn(target)}").where("col_name = 'Location'")
              .select("data_type").first()[0])
    committed, begun = _exists(spark, f"{folder}/_spark_metadata"), _exists(spark, f"{location}/commits/0")
    if committed and not _exists(spark, f"{location}/offsets"):
        raise ValueError(f"{config.fqn(target)} has files committed by a stream whose checkpoint is not {location}; "
                         "with an empty checkpoint new files would be skipped")
    if begun and not committed:
        raise ValueError(f"{location} is the checkpoint of another table than {config.fqn(target)}; "
                         "files it has taken would be missing")
    return location


def ingest_reading_logs(spark: SparkSession, config: LakeConfig, source_path: str, *,
                        target: str = "silver_reading_logs", fmt: str = "parquet",
                        max_files_per_trigger: int = 1000,
                        checkpoint: str | None = None) -> StreamingQuery:
    """Start the stream over all files of ``source_path`` not yet taken.

    ``checkpoint`` is by default the one kept with the table; a new table
    gets a folder of its own directly below the configured checkpoint folder.
    """
    if table_exists(spark, config, target) and not stream_owned(spark, config, target):
        raise ValueError(f"{config.fqn(target)} was not created by the stream; "
                         "give the stream its own target table")
    raw = (spark.readStream.schema(READING_LOGS_SCHEMA).format(fmt)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .load(source_path))
    articles = read_table(spark, config, "silver_articles")
    logs = silver.silver_reading_logs(raw, articles)
    logs = logs.select(*[c for c in logs.columns if c != PARTITION], PARTITION)
    if not table_exists(spark, config, target):
        _create(spark, config, target, logs,
                checkpoint or f"{checkpoint_base(spark)}/stream-{config.schema}-{target}-{uuid.uuid4().hex}")
    return (logs.writeStream.format(config.fmt)
            .outputMode("append")
            .option("checkpointLocation", _checkpoint_of(spark, config, target, checkpoint))
            .partitionBy(PARTITION)
            .trigger(availableNow=True)
            .toTable(config.fqn(target)))


def run_incremental(spark: SparkSession, config: LakeConfig, source_path: str, **kwargs) -> None:
    """Process all new files and wait until the stream stops."""
    query = ingest_reading_logs(spark, config, source_path, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
