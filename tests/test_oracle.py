"""Every registered query against its DuckDB SQL on the smallest tables
(the driver's check runs the same comparison at sf0.01)."""

import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_SMALL

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from oracle_check import digest  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from subsight.plans.registry import ADDED, QUERIES  # noqa: E402
from subsight.sources.testdata import TEST_TABLES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert len(QUERIES) == 39 + len(ADDED)
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["ym", "category", "article_views", "reads_completed", "unique_readers",
                          "completion_rate"]
