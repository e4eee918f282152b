"""Namespace configuration and catalog access (A4, A5, A9, A10, A11)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Table property of stored usage: its newest day, set by the ingest that writes the table.
USAGE_DAY_KEY = "subsight.latest_usage_day"
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


@dataclass(frozen=True)
class LakeConfig:
    """Where the layers live: ``catalog.schema.table``.

    ``fmt`` is the table format of every write (parquet by default; a
    transactional format needs its jar on the cluster).
    """

    schema: str
    catalog: str = "spark_catalog"
    fmt: str = "parquet"

    def __post_init__(self) -> None:
        for label, value in (("catalog", self.catalog), ("schema", self.schema)):
            if not value:
                raise ValueError(f"{label} must be set")
            if not _IDENT.match(value):
                raise ValueError(f"{label} {value!r} is not a plain identifier")

    @property
    def namespace(self) -> str:
        return f"{self.catalog}.{self.schema}"

    def fqn(self, table: str) -> str:
        if not _IDENT.match(table):
            raise ValueError(f"table {table!r} is not a plain identifier")
        return f"{self.namespace}.{table}"


def use_schema(spark: SparkSession, config: LakeConfig) -> None:
    """Select the catalog, create the schema if missing, select it."""
    spark.catalog.setCurrentCatalog(config.catalog)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {config.namespace}")
    spark.catalog.setCurrentDatabase(config.schema)
    recover_tables(spark, config)


def recover_tables(spark: SparkSession, config: LakeConfig) -> list[str]:
    """Finishes replacements that a killed driver left between drop and rename.

    A new version is listed as ``<table>__next`` only when it is whole. Where
    the table itself is missing, the version takes its name; a version beside
    an existing table is left for the next write to overwrite.
    """
    names = {r.tableName for r in show_tables(spark, config).collect()}
    done = []
    for name in sorted(n[:-len("__next")] for n in names if n.endswith("__next")):
        if name not in names:
            spark.sql(f"ALTER TABLE {config.fqn(f'{name}__next')} RENAME TO {config.schema}.{name}")
            if any(c.isPartition for c in spark.catalog.listColumns(config.fqn(name))):
                spark.sql(f"MSCK REPAIR TABLE {config.fqn(name)} SYNC PARTITIONS")
            done.append(name)
    return done


def show_tables(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """``SHOW TABLES IN catalog.schema``."""
    return spark.sql(f"SHOW TABLES IN {config.namespace}")


def table_exists(spark: SparkSession, config: LakeConfig, table: str) -> bool:
    return spark.catalog.tableExists(config.fqn(table))


def read_table(spark: SparkSession, config: LakeConfig, table: str) -> DataFrame:
    """Scan of a stored table by name."""
    return spark.table(config.fqn(table))


def table_property(spark: SparkSession, config: LakeConfig, table: str, key: str) -> str | None:
    """A table property, or None (metadata lookup, no data read)."""
    rows = (spark.sql(f"SHOW TBLPROPERTIES {config.fqn(table)}")
            .filter(f"key = '{key}'").select("value").collect())
    return rows[0][0] if rows else None


def set_table_property(spark: SparkSession, config: LakeConfig, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {config.fqn(table)} SET TBLPROPERTIES ('{key}' = '{value}')")
