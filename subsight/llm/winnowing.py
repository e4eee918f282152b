"""Benchmark decontamination by winnowing: shared word spans found through joined fingerprints."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsight.llm.tables import stored
from subsight.llm.textbytes import Words, mix, word_runs

WINDOW_WORDS = 10
GRAM_WORDS = 5
#: The filter of benchmark fingerprints has 2^20 to 2^27 bits (16 MB at most), 2^10 a fingerprint if that fits.
FILTER_BITS = (20, 27)
_STEP = np.uint64(0xA0761D6478BD642F)


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words of ``h``, salted by ``k``."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * _STEP + h[j:j + n]
    return mix(out)


def window_prints(h: np.ndarray, words: int, gram: int) -> np.ndarray:
    """The fingerprint of each window of ``words`` words: its least hash of ``gram`` words.

    Two equal windows have equal fingerprints whatever surrounds them, so
    every shared span of at least ``words`` words is met by the join.
    """
    if words <= gram:
        return _grams(h, words)
    g = _grams(h, gram)
    n = max(0, len(h) - words + 1)
    out = g[:n].copy()
    for j in range(1, words - gram + 1):
        np.minimum(out, g[j:j + n], out=out)
    return out


def _item_rows(items: DataFrame, words: int, gram: int) -> DataFrame:
    """``(item, fp, words, window)``: the windows of every item; a shorter item is one window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, w in word_runs(b.column(1)):
                out = [], [], [], []
                for t in range(j - i):
                    a, z = int(w.first[t]), int(w.first[t + 1])
                    if a == z:
                        continue
                    n = min(words, z - a)
                    fps = window_prints(w.hashes[a:z], n, gram).view(np.int64)
                    for k, fp in enumerate(fps.tolist()):
                        for column, x in zip(out, (b.column(0)[i + t].as_py(), fp, n, w.text(a + k, a + k + n))):
                            column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(out, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
                    ["item", "fp", "words", "window"])

    return items.mapInArrow(run, "item string, fp long, words int, window string")


def _probe(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(64 - bits)
    return (fp >> low).astype(np.int64), ((fp * _STEP) >> low).astype(np.int64)


def _filter(prints: DataFrame) -> np.ndarray:
    """A Bloom filter of the fingerprints, two probes each, as bits in a byte array of bounded size.

    Built by a grouped bit_or; what reaches the driver is at most the filter
    itself. A larger benchmark lets more windows through to the join, which
    decides; none is lost.
    """
    n = prints.agg(F.approx_count_distinct("fp")).first()[0]
    bits = int(min(max(np.ceil(np.log2(max(n, 1))) + 10, FILTER_BITS[0]), FILTER_BITS[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(_probe(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)))
            mask = np.int64(1) << (at & 31)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(mask)], ["slot", "mask"])

    slots = prints.select("fp").mapInArrow(run, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    got = slots.toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[got["slot"].to_numpy()] = got["mask"].to_numpy().astype(np.uint32)
    return table


def _passes(table: np.ndarray, fp: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() - 1 + 5
    a, b = _probe(fp, bits)
    hit = np.flatnonzero((table[a >> 5] >> (a & 31).astype(np.uint32)) & 1)
    b = b[hit]
    return hit[((table[b >> 5] >> (b & 31).astype(np.uint32)) & 1).astype(bool)]


def _found(w: Words, lengths: Sequence[int], gram: int, table: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(fp, word, length)`` of the windows of a run of texts whose fingerprints pass the filter."""
    for n in lengths:
        fps = window_prints(w.hashes, n, gram)
        at = _passes(table, fps)
        owner = np.searchsorted(w.first, at, "right")  # the text's end is first[owner]
        at, owner = at[at + n <= w.first[owner]], owner[at + n <= w.first[owner]]
        yield from zip(fps[at].view(np.int64).tolist(), at.tolist(), [n] * len(at))


def _document_rows(docs: DataFrame, lengths: Sequence[int], gram: int, table: np.ndarray) -> DataFrame:
    """``(id, text_key, n_words, hits)``, one row per document, with its windows that pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("fp", pa.int64()), ("start", pa.int64()), ("words", pa.int32()), ("window", pa.string())]))
        for b in batches:
            counts, hits = [], []
            for i, j, w in word_runs(b.column(2)):
                counts += np.diff(w.first).tolist()
                mine = [[] for _ in range(j - i)]
                for fp, at, n in _found(w, lengths, gram, table):
                    t = int(np.searchsorted(w.first, at, "right")) - 1
                    mine[t].append({"fp": fp, "start": at - int(w.first[t]), "words": n, "window": w.text(at, at + n)})
                hits += mine
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int64()), pa.array(hits, kind)],
                                             ["id", "text_key", "n_words", "hits"])

    return docs.mapInArrow(run, "id long, text_key long, n_words long, "
                                "hits array<struct<fp: long, start: long, words: int, window: string>>")


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW_WORDS, gram: int = GRAM_WORDS,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``(id_col, text_key, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per row of ``docs``.

    A window is ``words`` consecutive words of an item, or the whole of a
    shorter item. Both sides are winnowed: a window's fingerprint is its
    least hash of ``gram`` words. Document windows whose fingerprint passes a
    bounded filter of the benchmark's are joined to the benchmark windows on
    the fingerprint and, to extend the hit exactly, on the window's words;
    overlapping windows merge into spans, of which ``n_hit`` counts the
    words. The join is Spark's choice of strategy; neither side is collected.

    Null and empty texts have no words and are never contaminated; an empty
    benchmark contaminates nothing; items without words have no window;
    windows of items with a null id count as hits, but not as items. Rows
    that repeat an id and text get equal results, one row each; rows that
    share an id (or have none) with other texts are judged by their own
    text, told apart by ``text_key``. Very long texts are read whole, about a
    megabyte of words at a time or one text. An empty table of documents
    gives an empty result. Other columns are not read.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    src = src.select("id", F.xxhash64("text").alias("text_key"), "text")
    items = stored(_item_rows(benchmark.select(F.col(item_col).cast("string").alias("item"),
                                               F.col(item_text_col).cast("string").alias("text")), words, gram), "windows")
    lengths = sorted(r[0] for r in items.select("words").distinct().collect())  # at most ``words`` numbers
    rows = stored(_document_rows(src, lengths, gram, _filter(items)), "candidates")
    hits = rows.where(F.size("hits") > 0).select("id", "text_key", F.explode("hits").alias("h")) \
        .select("id", "text_key", "h.fp", "h.window", "h.start", (F.col("h.start") + F.col("h.words")).alias("end")).distinct()
    # Written first, so that both sides of the join are plain shuffles and a window that many documents have can be split.
    windows = stored(items.select("fp", "window").distinct(), "distinct-windows")
    spans = hits.join(windows, ["fp", "window"], "left_semi")
    mine = Window.partitionBy("id", "text_key").orderBy("start", "end")
    reach = F.max("end").over(mine.rowsBetween(Window.unboundedPreceding, -1))
    n_hit = spans.select("id", "text_key", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reach, F.lit(0))))
                         .alias("new")).groupBy("id", "text_key").agg(F.sum("new").alias("n_hit"))
    pairs = hits.select("id", "text_key", "fp", "window").distinct() \
        .join(items.where("item is not null").select("fp", "window", "item").distinct(), ["fp", "window"]) \
        .select("id", "text_key", "item").distinct()
    per = pairs.groupBy("id", "text_key").agg(F.array_sort(F.collect_list("item")).alias("items")) \
        .select("id", "text_key", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("list"))
    found = n_hit.join(per, n_hit.id.eqNullSafe(per.id) & (n_hit.text_key == per.text_key), "left") \
        .select(n_hit.id, n_hit.text_key, "n_hit", "n_items", "list")
    out = rows.select("id", "text_key", "n_words").alias("r").join(
        found.alias("f"), F.col("r.id").eqNullSafe(F.col("f.id")) & (F.col("r.text_key") == F.col("f.text_key")), "left")
    return out.select(
        F.col("r.id").alias(id_col), "r.text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
