"""Even shards with few cut links, by balanced label propagation over counts, in DataFrame operations only.

Linked documents (equal texts) start at shards by hash. What moves is never a
document but a count: ``(group, unit, shard, n)``. In each round a unit's
members want to join the shard where most of it can come together; a matrix
of at most shards x shards wishes is cut down until no shard takes in more
than it has room for or gives away, and the admitted counts move. Documents
learn their shard once, at the end.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsight.llm.tables import stored

SHARDS = 40
#: Bytes added to the size of each document.
OVERHEAD = 16
#: Buckets of the order key, so that no prefix sum holds a group or a shard in one task.
BUCKETS = 4096
#: Ranks of a group that meet their intervals under one key.
RANKS = 1 << 10
#: Rounds of propagation at most; they end when no more than one document in ``STANDSTILL`` moves.
ROUNDS = 20
STANDSTILL = 10_000
#: Room beyond its quota that a shard has while documents move, in percent; what is over at the end moves on, unit by unit.
SLACK = 25


def _before(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before, within ``keys``, by ``bucket`` and then ``order``.

    In two steps, over the bucket totals and within a bucket, so a key with
    a third of all rows is summed by thousands of groups.
    """
    valued = df.withColumn("_value", value)
    totals = valued.groupBy(*keys, "bucket").agg(F.sum("_value").alias("_total"))
    prior = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "bucket", F.coalesce(F.sum("_total").over(prior), F.lit(0).cast("long")).alias("_offset"))
    inside = Window.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return valued.join(offsets, [*keys, "bucket"]) \
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0).cast("long"))).drop("_value", "_offset")


def _small(spark, rows: Sequence[dict], ddl: str) -> DataFrame:
    """A table of at most shards x shards rows, as one literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")))


def admitted(wishes: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The moves from each shard (row) to each other that keep every shard within its room.

    A shard may take in what is free and what it gives away; columns that
    want more are scaled down to that, which lessens what others give away,
    until all hold. The result is the same on every run.
    """
    moves = wishes.copy()
    while True:
        room = np.maximum(0, free + moves.sum(axis=1))
        inflow = moves.sum(axis=0)
        over = np.flatnonzero(inflow > room)
        if not len(over):
            return moves
        for t in over:
            scaled, rest = np.divmod(moves[:, t] * int(room[t]), int(inflow[t]))
            more = np.argsort(-rest, kind="stable")[:int(room[t] - scaled.sum())]
            scaled[more] += 1
            moves[:, t] = scaled


def quotas(rows: int, shards: int) -> np.ndarray:
    """Documents of each shard, at most one apart."""
    return rows // shards + (np.arange(shards) < rows % shards).astype(np.int64)


def _loads(labels: DataFrame, shards: int) -> np.ndarray:
    out = np.zeros(shards, np.int64)
    for shard, n in labels.groupBy("shard").agg(F.sum("n")).collect():  # a row a shard
        out[shard] = n
    return out


def _round(labels: DataFrame, quota: np.ndarray) -> tuple[DataFrame, int]:
    """One round of propagation over ``labels(g, u, bucket, shard, n)``, and how many documents moved."""
    shards = len(quota)
    spark = labels.sparkSession
    free = quota - _loads(labels, shards)
    rooms = _small(spark, [{"shard": s, "room": max(0, int(f))} for s, f in enumerate(free)], "shard int, room long")
    unit = Window.partitionBy("g", "u", "bucket")
    sized = labels.join(F.broadcast(rooms), "shard").withColumn("size", F.sum("n").over(unit)) \
        .withColumn("fit", F.col("n") + F.least(F.col("size") - F.col("n"), F.col("room")))
    best = F.max(F.struct("fit", "n", F.xxhash64("g", "u", "shard").alias("draw"), "shard")).over(unit)
    wish = stored(sized.withColumn("to", best.getField("shard")).drop("fit", "size", "room"), "wishes")
    matrix = np.zeros((shards, shards), np.int64)
    leaving = wish.where("`to` != shard")
    for a, b, n in leaving.groupBy("shard", "to").agg(F.sum("n")).collect():  # at most shards x shards rows
        matrix[a, b] = n
    moves = admitted(matrix, free)
    if not moves.any():
        return labels, 0
    allowed = _small(spark, [{"shard": int(a), "to": int(b), "allowed": int(moves[a, b])} for a, b in np.argwhere(matrix)],
                     "shard int, `to` int, allowed long")
    queued = _before(leaving.join(F.broadcast(allowed), ["shard", "to"]), ["shard", "to"], ["g", "u"], F.col("n"), "ahead")
    moved = queued.withColumn("moved", F.greatest(F.lit(0).cast("long"), F.least("n", F.col("allowed") - F.col("ahead"))))
    after = moved.select("g", "u", "bucket", F.explode(F.array(
        F.struct(F.col("shard").alias("shard"), (F.col("n") - F.col("moved")).alias("n")),
        F.struct(F.col("to").alias("shard"), F.col("moved").alias("n")))).alias("p")).select("g", "u", "bucket", "p.*").where("n > 0")
    stay = wish.where("`to` = shard").select("g", "u", "bucket", "shard", "n")
    return stored(stay.unionByName(after).groupBy("g", "u", "bucket", "shard").agg(F.sum("n").alias("n")), "labels"), int(moves.sum())


def _full_units(large: DataFrame, largest: int, shards: int) -> DataFrame:
    """``g, u, filled``: a shard of its own to start in for each unit as large as a shard, by the rows of its group."""
    rows = sorted((bytes(g).hex(), m) for g, m in large.collect())  # groups of a shard's size: fewer than twice the shards
    units = [(g, u) for g, m in rows for u in range(m // largest)][:shards]
    table = _small(large.sparkSession, [{"g": g, "u": u, "filled": s} for s, (g, u) in enumerate(units)], "g string, u long, filled int")
    return table.withColumn("g", F.unhex("g"))


def _intervals(demand: np.ndarray) -> tuple[Column, list[tuple[int, int, int]]]:
    """Places 0, 1, ... dealt to the shards by demand, as a literal array of ``(shard, lo, hi)``."""
    ends = np.cumsum(demand)
    rows = [(s, int(e - d), int(e)) for s, (d, e) in enumerate(zip(demand, ends)) if d]
    return F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"))
                     for s, lo, hi in rows]), rows


def _settled(labels: DataFrame, quota: np.ndarray) -> tuple[DataFrame, np.ndarray, int]:
    """Labels within the quotas, the places that are left for unlinked documents by shard, and the first of those places.

    What is over a shard's quota, pieces of divided units first and small
    ones before large ones, is dealt to the shards with room.
    """
    loads = _loads(labels, len(quota))
    demand = quota - np.minimum(loads, quota)
    surplus = loads - np.minimum(loads, quota)
    if not surplus.any():
        return labels, demand, 0
    whole = (F.sum("n").over(Window.partitionBy("g", "u", "bucket")) == F.col("n")).cast("int")
    weight = whole * 64 + F.least(F.ceil(F.log2("n")), F.lit(63)).cast("int")
    ordered = labels.withColumn("bucket", weight * 64 + F.col("bucket") % 64)
    over = _small(labels.sparkSession, [{"shard": s, "over": int(n)} for s, n in enumerate(surplus)], "shard int, over long")
    queued = _before(ordered.join(F.broadcast(over), "shard"), ["shard"], ["g", "u"], F.col("n"), "ahead")
    out = F.greatest(F.lit(0).cast("long"), F.least("n", F.col("over") - F.col("ahead")))
    parted = stored(queued.withColumn("out", out), "parted")
    gone = _before(parted.where("out > 0"), [], ["shard", "g", "u"], F.col("out"), "at")
    spans, _ = _intervals(demand)
    end = F.col("at") + F.col("out")
    dealt = gone.select("g", "u", "bucket", "at", "out", F.explode(F.filter(spans, lambda s: (s.lo < end) & (s.hi > F.col("at")))).alias("s")) \
        .select("g", "u", "bucket", "s.shard", (F.least("s.hi", end) - F.greatest("s.lo", "at")).alias("n"))
    kept = parted.select("g", "u", "bucket", "shard", (F.col("n") - F.col("out")).alias("n")).where("n > 0")
    labels = kept.unionByName(dealt).groupBy("g", "u", "shard").agg(F.sum("n").alias("n"))
    return stored(labels, "settled"), demand, int(surplus.sum())


def balanced_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard``, one row per row of ``docs``.

    The law is ``rows``: numbers of documents in shards are at most one
    apart. Size is the text's UTF-8 bytes plus 16. Documents of equal text
    are linked; null and empty text are one text. A group larger than a
    shard is cut into units of a shard's number of documents first, each
    with a shard to start in; others start by hash and come together as far
    as the quotas allow. Unlinked documents fill what
    is left. ``slot`` counts from 0 within a shard.

    Null ids and repeated rows are rows like others, equal rows are
    interchangeable. Fewer documents than shards leave shards empty; an
    empty table gives an empty result. Texts of any length are read once,
    for size, checksum and digest; other columns are not read. The driver
    holds numbers by shard and pair of shards; a group, however large, is
    counted, ranked and joined in buckets. The result is the same on every
    run, but for equal rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(text))
    narrow = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                         F.crc32(text).alias("text_crc32"), digest.alias("g")) \
        .withColumn("okey", F.xxhash64(F.col("id").cast("string"), "g")) \
        .withColumn("bucket", F.pmod(F.shiftright("okey", 20), F.lit(BUCKETS)).cast("int"))
    narrow = stored(narrow, "documents")
    total = narrow.count()
    quota = quotas(total, shards)
    largest = max(1, total // shards)
    everyone = Window.partitionBy("g")
    per = narrow.groupBy("g", "bucket").agg(F.count(F.lit(1)).alias("here"))
    offsets = per.select("g", "bucket", F.sum("here").over(everyone).alias("members"), F.coalesce(
        F.sum("here").over(everyone.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("offset"))
    ranked = narrow.join(offsets, ["g", "bucket"]).withColumn(
        "rank", F.col("offset") + F.row_number().over(Window.partitionBy("g", "bucket").orderBy("okey", "id")) - 1).drop("offset")
    ranked = stored(ranked, "ranked")

    unit = F.floor(F.col("rank") / largest).cast("long")
    drawn = F.pmod("okey", F.lit(shards)).cast("int")
    full = _full_units(offsets.where(F.col("members") >= max(2, largest)).select("g", "members").distinct(), largest, shards)
    linked = ranked.where("members > 1").select("g", unit.alias("u"), drawn.alias("drawn")).join(F.broadcast(full), ["g", "u"], "left") \
        .groupBy("g", "u", F.coalesce("filled", "drawn").alias("shard")) \
        .agg(F.count(F.lit(1)).alias("n"))
    labels = stored(linked.withColumn("bucket", F.pmod(F.xxhash64("g", "u"), F.lit(BUCKETS)).cast("int")), "labels")
    for _ in range(rounds):
        labels, moved = _round(labels, quota + -(-quota * SLACK // 100))
        if moved <= total // STANDSTILL:
            break
    labels, demand, taken = _settled(labels, quota)

    # Intervals of ranks of each shard's part of a unit, by blocks of ranks, so no key has more than a block's documents.
    ends = F.sum("n").over(Window.partitionBy("g", "u").orderBy("shard"))
    spans = labels.select("g", "shard", (F.col("u") * largest + ends - F.col("n")).alias("lo"), (F.col("u") * largest + ends).alias("hi"))
    spans = stored(spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / RANKS), F.floor((F.col("hi") - 1) / RANKS)))), "spans")
    mine = ranked.where("members > 1").withColumn("block", F.floor(F.col("rank") / RANKS))
    columns = ["id", "size", "text_crc32", "okey", "bucket", "shard"]
    placed = mine.join(spans, ["g", "block"]).where("rank >= lo and rank < hi").select(*columns)
    alone = _before(ranked.where("members = 1"), [], ["okey", "id"], F.lit(1).cast("long"), "place")
    rows = _intervals(demand)[1]
    shard = F.lit(None).cast("int")
    for s, _, hi in reversed(rows):
        shard = F.when(F.col("place") + taken < hi, F.lit(s)).otherwise(shard)
    out = stored(placed.unionByName(alone.withColumn("shard", shard).select(*columns)), "placed")
    slotted = _before(out, ["shard"], ["okey", "id"], F.lit(1).cast("long"), "slot")
    return slotted.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
