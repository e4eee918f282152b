"""The registered queries: contract columns, a row per input row, and the SQL where there is one."""

import duckdb
import pytest
from oracle_check import digest

from __spark_entry__ import oracle_sql, queries
from subsight.llm.queries import QUERIES, SQL
from subsight.sources.testdata import TEST_TABLES

from .conftest import SMALL

COLUMNS = {
    "op1_language": (["doc_id", "held_out", "lang_pred", "score"], "documents"),
    "op2_pii": (["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], "documents"),
    "op3_simhash": (["doc_id", "fingerprint", "component_id"], "documents"),
    "op4_mixing": (["doc_id", "size", "source_size", "target", "taken"], "documents"),
    "op5_embeddings": (["vec_id", "n_links", "component_id", "kept"], "embeddings"),
    "op6_toxicity": (["doc_id", "held_out", "score", "predicted"], "documents"),
    "op7_tokens": (["doc_id", "n_bytes", "n_tokens", "over_limit"], "documents"),
    "op8_urls": (["page_id", "host", "path", "rule", "verdict"], "pages"),
    "op9_chat": (["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"], "conversations"),
    "op12_collocations": (["lang", "rank", "phrase", "a", "l", "r", "n", "score"], "documents"),
    "op13_sharding": (["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], "documents"),
    "op11_repair": (["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"], "conversations"),
    "op10_winnowing": (["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], "documents"),
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_contract(spark, name):
    columns, table = COLUMNS[name]
    got = queries()[name](spark, SMALL)
    assert [c for c in got.columns if c in columns] == columns
    given = spark.read.parquet(f"{SMALL}/{table}.parquet")
    if name == "op12_collocations":
        assert got.groupBy("lang").max("rank").where("`max(rank)` > 2000").isEmpty()
    elif name == "op11_repair":
        assert got.count() == given.select("conv_id").distinct().count()
    elif name == "op9_chat":
        assert got.count() == given.select("conv_id").distinct().count() + 1
    else:
        key = columns[0]
        assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries()[name](spark, SMALL)
    res = con.execute(SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, res.fetchall())
