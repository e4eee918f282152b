"""SimHash near-duplicates found by multi-index hashing of 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.llm.graph import components
from subsight.llm.tables import stored

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: A segment bucket of more distinct fingerprints is linked through radius-1 balls instead of pairs.
BUCKET = 256


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of ``text`` as a signed long: a bit is set if more than half of the shingle hashes set it.

    Only A-Z are lower-cased; words are runs without ASCII white space. A
    text of fewer words is one shingle; null or no word gives zero.
    """
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    n = max(1, len(ws) - words + 1)
    shingles = map(b" ".join, zip(*(islice(ws, k, None) for k in range(words)))) if len(ws) >= words else [b" ".join(ws)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):  # bounded scratch for very long texts
        bits = np.unpackbits(h[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS, keyed: bool = False) -> DataFrame:
    """``(id, fp)`` per row of ``docs``; whole texts, in Arrow batches. If ``keyed``, also the text's hash as ``text_key``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *b.columns[2:]], ["id", "fp", *b.schema.names[2:]])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if keyed:
        src = src.withColumn("text_key", F.xxhash64("text"))
    return src.mapInArrow(run, "id long, fp long" + (", text_key long" if keyed else ""))


#: Per number of segments: the bits of each key (first, end; one or two segments) and the bits its ball flips.
SEGMENTATIONS = {2: (([(32, 64)], (32, 64)), ([(0, 32)], None)),
                 3: (([(21, 64)], (21, 64)), ([(42, 64), (0, 21)], (42, 64)), ([(0, 42)], None))}
#: Up to so many fingerprints two segments are used: a key of 32 bits then meets at most a few others by chance.
TWO_SEGMENTS_UP_TO = 1 << 30


def segments_for(fps: DataFrame) -> int:
    """The segmentation for the (approximate) number of different ``fps(fp)``; one pass, no shuffle of fingerprints."""
    n = fps.agg(F.approx_count_distinct("fp")).first()[0]
    return 2 if n <= TWO_SEGMENTS_UP_TO else 3


def _mask(ranges: list[tuple[int, int]]) -> int:
    bits = sum((1 << z) - (1 << a) for a, z in ranges)
    return bits - (1 << 64) if bits >> 63 else bits


def _one_more(key: Column, first: int, end: int) -> Column:
    """``key`` with one more of the bits from ``first`` to ``end`` set, each in turn."""
    flips = F.transform(F.sequence(F.lit(first), F.lit(end - 1)),
                        lambda i: key.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    return F.filter(flips, lambda k: k != key)


def _probes(fps: DataFrame, segments: int) -> DataFrame:
    """Keys each fingerprint looks up: ``(seg, key, fp, own)``.

    With two 32-bit segments and at most two differing bits, the high
    segments differ in at most one bit or the low segments are equal. So the
    high segment is looked up with its ball of radius one, the low one as it
    is. With three segments A, B, C of 22, 21 and 21 bits the keys are
    joined segments of 42 and 43 bits: two bits that differ both in A leave
    BC equal, one each in A and B differ by A's bit in AC, and all others
    leave at most one bit in AB. So AB is looked up with its ball, AC with
    the flips of A, BC as it is: twice the probes, but a key of 42 bits
    meets others by chance only from about 10^12 fingerprints on. Of a ball
    only the keys with one more bit set are needed: a pair one bit apart is
    then met once, from the side without the bit.
    """
    as_key = lambda seg, own: lambda k: F.struct(F.lit(seg).alias("seg"), k.alias("key"), F.lit(own).alias("own"))
    keys = []
    for seg, (ranges, ball) in enumerate(SEGMENTATIONS[segments]):
        key = F.col("fp").bitwiseAND(F.lit(_mask(ranges)))
        keys.append(F.array(as_key(seg, True)(key)))
        if ball:
            keys.append(F.transform(_one_more(key, *ball), as_key(seg, False)))
    return fps.select("fp", F.explode(F.concat(*keys)).alias("p")).select("p.seg", "p.key", "p.own", "fp")


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET, segments: int = 2) -> DataFrame:
    """Edges ``(u, v)`` that connect exactly the distinct ``fps(fp)`` within ``max_bits`` (0 to 2) bits, transitively.

    Segment buckets of up to ``bucket`` fingerprints give candidate pairs,
    verified on all 64 bits. In larger buckets (a group of near copies that
    share a segment) pairs would grow with the square of the group, so every
    fingerprint that meets one emits its own ball of radius one instead: two
    fingerprints are within two bits exactly if their balls share a point, a
    point has at most 65 fingerprints, and one edge each to the least of
    them connects them. Nothing is capped or dropped. ``segments`` changes the
    candidates, not the links.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    probes = stored(_probes(fps, segments), "probes")
    rows = probes.where("own").select("seg", "key", F.col("fp").alias("other"))
    large = stored(rows.groupBy("seg", "key").count().where(F.col("count") > bucket).select("seg", "key"), "large")
    cold = probes.join(large, ["seg", "key"], "left_anti").join(rows, ["seg", "key"]) \
        .where("(not own or fp < other) and fp != other") \
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits) \
        .select(F.col("fp").alias("u"), F.col("other").alias("v"))
    met = probes.join(large, ["seg", "key"], "left_semi").select("fp").distinct()
    if max_bits == 2:
        flips = F.transform(F.sequence(F.lit(0), F.lit(63)),
                            lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        points = met.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("point"))
    else:  # balls that meet at one bit: only the flips of a bit that is not set, and the fingerprint itself
        flips = F.transform(F.sequence(F.lit(0), F.lit(63)),
                            lambda i: F.col("fp").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        points = met.select("fp", F.explode(F.concat(F.array("fp"), flips) if max_bits else F.array("fp")).alias("point"))
        return cold.unionByName(_one_bit(points)) if max_bits else cold
    hubs = points.groupBy("point").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    hot = hubs.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u != v").distinct()
    return cold.unionByName(hot)


def _one_bit(points: DataFrame) -> DataFrame:
    """Edges between a point that is a fingerprint itself and the fingerprints one bit below it."""
    own = points.where("fp = point").select("point").distinct()
    return points.where("fp != point").join(own, "point").select(F.col("fp").alias("u"), F.col("point").alias("v"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row per row of ``docs``.

    Equal fingerprints are collapsed first, so copies cost one row each and
    never a pair. ``component_id`` is the least id reachable over links of
    at most ``max_bits`` differing bits. Texts that are null, empty or
    without words have fingerprint zero and link like any other; rows that
    repeat an id keep a row each; a component whose ids are all null has a
    null ``component_id``. An empty table gives an empty result; other
    columns of ``docs`` are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("id").alias("rep"))
    nodes = components(fingerprint_links(fps.select("fp"), max_bits, bucket, segments_for(rows)))
    linked = fps.join(nodes, fps.fp == nodes.node)
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    of = nodes.join(least, "root").select(F.col("node").alias("fp"), "least")
    per_fp = fps.join(of, "fp", "left").select("fp", F.coalesce("least", "rep").alias("component_id"))
    per_fp = stored(per_fp, "components")  # then the last join shuffles both sides and can split the rows of one fingerprint
    return rows.join(per_fp, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def kept_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """``(kept_id, kept_key)``, the row of each component that stays, and those of them that several rows of ``docs`` have.

    That row has the least id, nulls last, and of its texts the one of least
    ``xxhash64``, the key.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words, keyed=True), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key"))
    fps = rows.groupBy("fp").agg(first.alias("first"))
    nodes = components(fingerprint_links(fps.select("fp"), max_bits, bucket, segments_for(rows)))
    of = fps.join(nodes, fps.fp == nodes.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = stored(of.select(F.col("first.id").alias("kept_id"), F.col("first.text_key").alias("kept_key")), "kept")
    many = rows.groupBy("id", "text_key").count().where("count > 1")
    again = kept.join(many, kept.kept_id.eqNullSafe(many.id) & (kept.kept_key == many.text_key), "left_semi")
    return kept, stored(again, "kept-again")
