"""Rows that silver would blank without a trace: kept and set aside in one pass.

Silver parses dates and times with ``try_cast``: text that does not parse
becomes NULL. :func:`sifted` names such values, with the reason and the file
they came from; :func:`ingest_sifted` and :func:`stream_sifted` write a raw
input once, partitioned by whether a row has any, so what is kept and what is
set aside add up to what was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subsight import model as M
from subsight.sources.bronze import write_table
from subsight.sources.catalog import LakeConfig, read_table

#: Text columns of the raw inputs that silver parses, and into what.
PARSED = {
    "members": {"registration_date": "date"},
    "articles": {"publish_date": "date"},
    "reading_logs": {"event_time": "timestamp"},
    "subscriptions": {"start_date": "date", "end_date": "date"},
}
REFUSED = "array<struct<column_name:string,value:string,reason:string>>"


def refusals(name: str) -> Column:
    """The values of a row that do not parse, as ``(column_name, value, reason)``; NULL text is no refusal.

    Reasons: ``empty`` or ``no date`` / ``no timestamp``. The empty end of a
    subscription that runs is its meaning, not a fault.
    """
    found = []
    for column, kind in PARSED[name].items():
        c = F.col(column)
        empty = F.trim(c) == ""
        bad = c.isNotNull() & c.try_cast(kind).isNull()
        if (name, column) == ("subscriptions", "end_date"):
            bad = bad & ~(empty & ~F.col("status").eqNullSafe(M.STATUS_CHURNED))
        found.append(F.when(bad, F.struct(F.lit(column).alias("column_name"), c.alias("value"),
                                          F.when(empty, "empty").otherwise(f"no {kind}").alias("reason"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull()).cast(REFUSED)


def sifted(df: DataFrame, name: str, source_file: Column | None = None) -> DataFrame:
    """``df`` with ``refused``, ``source_file`` and ``set_aside``: narrow, so one pass over the input."""
    source = F.lit(None).cast("string") if source_file is None else source_file
    return df.withColumn("refused", refusals(name)).withColumn("source_file", source).withColumn("set_aside", F.size("refused") > 0)


def refused_values(df: DataFrame, name: str) -> DataFrame:
    """Per column and reason: refused values, beside the rows read and those with none: ``table_name, column_name, reason, refused, rows_read, rows_kept``.

    One aggregate of the input: every pair of a parsed column and a reason is
    a conditional count, pairs that do not occur are left out.
    """
    marked = df.select(refusals(name).alias("refused"))
    pairs = [(c, r) for c, kind in PARSED[name].items() for r in ("empty", f"no {kind}")]
    has = lambda c, r: F.exists("refused", lambda x: (x.column_name == c) & (x.reason == r))
    one = marked.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(F.size("refused") == 0).alias("rows_kept"),
                     *[F.count_if(has(c, r)).alias(f"n{i}") for i, (c, r) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(r).alias("reason"), F.col(f"n{i}").alias("refused"))
                     for i, (c, r) in enumerate(pairs)])
    return one.select(F.inline(rows), "rows_read", "rows_kept").where("refused > 0")


def _read(spark: SparkSession, name: str, path: str, fmt: str, stream: bool, options: dict) -> DataFrame:
    schema = M.BRONZE_SCHEMAS[name]
    reader = (spark.readStream if stream else spark.read).schema(schema).options(**options).format(fmt)
    return sifted(reader.load(path).select(*schema.fieldNames(), F.col("_metadata.file_path").alias("_file")), name, F.col("_file")).drop("_file")


def ingest_sifted(spark: SparkSession, config: LakeConfig, name: str, path: str, fmt: str = "parquet", **options) -> dict[str, int]:
    """Writes the raw files of ``path`` as ``sifted_<name>``, a folder for what is kept and one for what is set aside.

    Returns ``read``, observed while writing, ``kept`` and ``set_aside``,
    from the footers of the folder. Empty inputs give an empty table.
    """
    rows = write_table(_read(spark, name, path, fmt, False, options), config, f"sifted_{name}", partition_by=["set_aside"])
    aside = read_table(spark, config, f"sifted_{name}").where("set_aside").count()
    return {"read": rows, "kept": rows - aside, "set_aside": aside}


def stream_sifted(spark: SparkSession, config: LakeConfig, name: str, path: str, checkpoint: str, fmt: str = "parquet",
                  **options) -> StreamingQuery:
    """:func:`ingest_sifted` for files that keep arriving: each is sifted once (``availableNow``, exactly-once file sink)."""
    df = _read(spark, name, path, fmt, True, options)
    return (df.writeStream.format(config.fmt).outputMode("append").option("checkpointLocation", checkpoint)
            .partitionBy("set_aside").trigger(availableNow=True).toTable(config.fqn(f"sifted_{name}")))


def kept(spark: SparkSession, config: LakeConfig, name: str) -> DataFrame:
    """The rows without refused values, as the raw input has them."""
    return read_table(spark, config, f"sifted_{name}").where("NOT set_aside").select(*M.BRONZE_SCHEMAS[name].fieldNames())


def set_aside(spark: SparkSession, config: LakeConfig, name: str) -> DataFrame:
    """The other rows, with ``refused`` and ``source_file``."""
    return read_table(spark, config, f"sifted_{name}").where("set_aside").drop("set_aside")
