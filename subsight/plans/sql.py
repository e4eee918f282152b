"""A user's SQL text over the stored tables of a lake (A5).

Table names are passed as ``IDENTIFIER(:name)`` arguments, never spliced
into the text, and values as named parameters, so a text runs unchanged
over any namespace.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from subsight.sources.catalog import LakeConfig

#: Devices per article category, with ``GROUP BY ALL`` (D13).
SECONDS_BY_DEVICE = """
    SELECT category, device, SUM(reading_seconds) AS seconds, AVG(scroll_depth) >= :deep AS deep
    FROM IDENTIFIER(:logs)
    WHERE is_premium = :premium
    GROUP BY ALL
    ORDER BY seconds DESC, category, device
"""


def run(spark: SparkSession, config: LakeConfig, text: str, tables: Mapping[str, str],
        values: Mapping[str, object] | None = None) -> DataFrame:
    """``text`` with ``IDENTIFIER(:key)`` naming the stored table
    ``tables[key]`` and ``:key`` the value ``values[key]``."""
    names = {key: config.fqn(table) for key, table in tables.items()}
    clash = names.keys() & (values or {}).keys()
    if clash:
        raise ValueError(f"names of both a table and a value: {sorted(clash)}")
    return spark.sql(text, args={**names, **(values or {})})
