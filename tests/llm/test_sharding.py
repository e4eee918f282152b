"""Balanced shards: even numbers, gapless slots, groups kept together, hot groups split over as few shards as they fill."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from subsight.llm.queries import op13_sharding
from subsight.llm.sharding import admitted, balanced_shards, quotas

from .conftest import EDGE_ROWS, SMALL


def lay(df, shards=40, **options):
    got = balanced_shards(df, shards, **options)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return got.collect()


def holds(rows, shards=40):
    """The law and the slots."""
    per = Counter(r.shard for r in rows)
    assert sorted(per[s] for s in range(shards)) == sorted(quotas(len(rows), shards).tolist()) and set(per) <= set(range(shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def shards_of(rows, texts):
    out = defaultdict(set)
    for r in rows:
        out[texts[r.doc_id]].add(r.shard)
    return out


def test_query(spark):
    rows = op13_sharding(spark, SMALL).collect()
    holds(rows)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    sizes = Counter(texts.values())
    for text, shards in shards_of(rows, texts).items():
        assert len(shards) == 1 or sizes[text] > len(rows) // 40
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op13_sharding(spark, SMALL).collect()))


@pytest.mark.parametrize("hot,rest", [(0, 2), (700, 2), (700, 1)])
def test_groups_come_together(spark, hot, rest):
    """All documents linked in pairs (no room but by exchange), and with a group of a third of the rows."""
    n, shards = 2100, 20
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < hot, "hot").otherwise((F.col("id") / rest).cast("long").cast("string")).alias("text"))
    texts = {i: "hot" if i < hot else str(i // rest) for i in range(n)}
    rows = lay(df, shards)
    holds(rows, shards)
    found = shards_of(rows, texts)
    if hot:
        assert len(found.pop("hot")) <= -(-hot // (n // shards)) + 1
    assert sum(len(s) > 1 for s in found.values()) <= shards


def test_edge_rows(spark, documents):
    rows = lay(documents(EDGE_ROWS), 3)
    holds(rows, 3)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in EDGE_ROWS)
    assert lay(documents([]), 3) == []
    holds(lay(documents(EDGE_ROWS[:2]), 40), 40)


def test_admitted_moves_keep_every_shard_within_its_room():
    g = np.random.default_rng(1)
    for _ in range(200):
        s = g.integers(2, 9)
        wishes = g.integers(0, 30, (s, s)) * g.integers(0, 2, (s, s))
        np.fill_diagonal(wishes, 0)
        free = g.integers(-5, 10, s)
        moves = admitted(wishes, free)
        assert (moves <= wishes).all() and (moves >= 0).all()
        assert (moves.sum(axis=0) <= np.maximum(0, free + moves.sum(axis=1))).all()
    swap = np.array([[0, 7], [7, 0]])
    assert (admitted(swap, np.zeros(2, np.int64)) == swap).all()  # full shards exchange


def test_no_prefix_sum_or_join_holds_a_group(spark):
    """Windows of the ranks are by group and bucket, joins by group and bucket or block of ranks; no Python runs on rows."""
    plan = balanced_shards(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan
