"""Phrase collocations: n-grams counted in quotient filters, scored by their weakest cut."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsight.llm.quotient import BUFFER, Filter, Layout, merged
from subsight.llm.tables import stored

MIN_COUNT = 10
#: A phrase goes if a longer one has at least so many percent of its occurrences.
SHARE = 50
TOP = 2000
#: Frequent words up to this number get dense ids, from a sorted array of their hashes that tasks hold; beyond it hashes are the ids.
DENSE_WORDS = (1 << 21) - 2
#: Parts of a language that are ranked first, each to its own top, so the last ranking sees ``SALTS * top`` rows of it at most.
SALTS = 64
#: Distinct words a task counts before it hands them on, or remembers the ids of.
HELD_WORDS = 1 << 19
#: Texts are cut into words so many bytes at a time.
CHUNK_BYTES = 1 << 20
#: About so many n-grams in a run of the merged filter.
RUN = 1 << 18
_BREAK = b"."
_DELIMITERS = b".,;:!?\n\x0b\x0c\r"
_TO_BREAK = bytes.maketrans(_DELIMITERS, _BREAK * len(_DELIMITERS))
_SPACE = b" \t" + _BREAK
#: Words with equal hashes are told apart by a list that every task holds; by chance there are next to none.
CLASHES = 100_000


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of ``text`` and a ``.`` between pieces, in lists; no word is cut."""
    text = text.lower().translate(_TO_BREAK)
    at = 0
    while at < len(text):
        end = at + CHUNK_BYTES
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].replace(_BREAK, b" . ").split()
        at = end


def _hash(lang: bytes, word: bytes) -> int:
    """63 bits of a word of a language."""
    return xxhash.xxh64_intdigest(lang + b"\0" + word) >> 1


def word_counts(texts: DataFrame, hash_bits: int = 63) -> DataFrame:
    """``lang, word, h, f`` of all words of ``texts(lang, text)``: counted in the tasks, added up across them."""
    mask = (1 << hash_bits) - 1
    schema = pa.schema([("lang", pa.binary()), ("word", pa.binary()), ("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Counter] = {}

        def take() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                counts.pop(_BREAK, None)
                words = list(counts)
                for at in range(0, len(words), 1 << 16):
                    some = words[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(some), pa.binary()), pa.array(some, pa.binary()),
                        pa.array([_hash(lang, w) & mask for w in some], pa.int64()),
                        pa.array([counts[w] for w in some], pa.int64())], schema=schema)
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                counts = held.setdefault(lang.as_py(), Counter())
                for tokens in _tokens(text.as_py()):
                    counts.update(tokens)
                    if len(counts) > HELD_WORDS:
                        yield from take()
                        counts = held.setdefault(lang.as_py(), Counter())
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from take()
        yield from take()

    rows = texts.select(F.col("lang").cast("binary"), F.col("text").cast("binary")).mapInArrow(run, "lang binary, word binary, h long, n long")
    return rows.groupBy(F.col("lang").cast("string").alias("lang"), F.col("word").cast("string").alias("word"), "h").agg(F.sum("n").alias("f"))


class _Ids(dict):
    """Ids of a language's words, 0 for those that are no candidate's; remembers what was asked, up to a bound."""

    def __init__(self, lang: bytes, codes: np.ndarray | None, clashes: dict, hash_mask: int):
        super().__init__()
        self.lang, self.codes, self.clashes, self.mask = lang, codes, clashes, hash_mask
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        code = self.clashes.get((self.lang, word)) if self.clashes else None
        if code is None:
            code = _hash(self.lang, word) & self.mask
        if self.codes is None:
            found = (code + 1) % (1 << 64)
        else:
            at = int(np.searchsorted(self.codes, code))
            found = at + 1 if at < len(self.codes) and self.codes[at] == code else 0
        if len(self) > HELD_WORDS:
            self.clear()
            self[_BREAK] = 0
        self[word] = found
        return found


def _ngrams(ids: np.ndarray, done: int) -> np.ndarray:
    """Id rows of the 2- and 3-grams of a stream of ids that end at or after place ``done``; 0 breaks them."""
    pair = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
    triple = pair[:-1][pair[1:] == pair[:-1] + 1]
    pair, triple = pair[pair + 1 >= done], triple[triple + 2 >= done]
    out = np.zeros((len(pair) + len(triple), 3), np.uint64)
    out[:len(pair), 0], out[:len(pair), 1] = ids[pair], ids[pair + 1]
    for k in range(3):
        out[len(pair):, k] = ids[triple + k]
    return out


def ngram_counts(texts: DataFrame, layout: Layout, codes, clashes: dict, least: int = MIN_COUNT, hash_bits: int = 63) -> DataFrame:
    """``c1, c2, c3, a``: word codes and count of every 2- and 3-gram of ``texts(lang, text)`` with at least ``least``.

    ``c3`` is null for pairs. ``codes`` is a broadcast of the sorted codes
    that have dense ids, or of None. A shard's filter is bounded; the merged
    ones are dealt by quotient and streamed in its order.
    """
    mask = (1 << hash_bits) - 1
    schema = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("c3", pa.int64()), ("a", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codes.value
        langs: dict[bytes, _Ids] = {}
        held = Filter(layout)
        stream: list[int] = []
        done = 0

        def flush() -> pa.RecordBatch | None:
            nonlocal stream, done
            out = held.add(_ngrams(np.array(stream, np.uint64), done))
            stream = stream[-2:]
            done = len(stream)
            return out

        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                lang = lang.as_py()
                if lang not in langs:
                    if len(langs) >= 256:
                        langs.clear()
                    langs[lang] = _Ids(lang, table, clashes, mask)
                of = langs[lang].__getitem__
                for tokens in _tokens(text.as_py()):
                    stream.extend(map(of, tokens))
                    if len(stream) > BUFFER:
                        full = flush()
                        if full:
                            yield full
                stream.append(0)
        if stream:
            full = flush()
            if full:
                yield full
        last = held.take()
        if last:
            yield last

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codes.value
        for ids, counts in merged(batches, layout, least):
            if not len(ids):
                continue
            coded = (ids - np.uint64(1)).view(np.int64) if table is None else table[np.maximum(ids, 1).astype(np.int64) - 1]
            pairs = ids[:, 2] == 0
            yield pa.RecordBatch.from_arrays([pa.array(coded[:, 0]), pa.array(coded[:, 1]), pa.array(coded[:, 2], mask=pairs),
                                              pa.array(counts)], schema=schema)

    runs = texts.select(F.col("lang").cast("binary"), F.col("text").cast("binary")).mapInArrow(count, "quotient long, slots binary")
    return runs.repartition("quotient").sortWithinPartitions("quotient").mapInArrow(reduce, "c1 long, c2 long, c3 long, a long")


def _clashing(words: DataFrame, least: int) -> dict:
    """Codes of the words that share their hash with another while one of them is frequent: negative, told apart."""
    shared = words.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("f").alias("most")).where((F.col("n") > 1) & (F.col("most") >= least))
    rows = words.join(shared, "h", "left_semi").select("lang", "word").orderBy("lang", "word").limit(CLASHES + 1).collect()
    if len(rows) > CLASHES:
        raise ValueError("too many words share a hash")
    return {(r[0].encode("utf-8", "surrogatepass"), r[1].encode("utf-8", "surrogatepass")): -2 - k for k, r in enumerate(rows)}


def _scored(grams: DataFrame, vocabulary: DataFrame, share: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer one covers."""
    one = lambda name: vocabulary.select(F.col("code").alias(f"c{name}"), F.col("lang").alias(f"lang{name}"),
                                         F.col("word").alias(f"w{name}"), F.col("f").alias(f"f{name}"))
    pairs = grams.where("c3 is null").drop("c3").join(one(1), "c1").join(one(2).drop("lang2"), "c2")
    pairs = stored(pairs.select("c1", "c2", F.col("lang1").alias("lang"), "w1", "w2", "a", "f1", "f2"), "pairs")
    triples = grams.where("c3 is not null")
    head = pairs.select("c1", "c2", "lang", F.col("w1"), F.col("f1"), F.col("a").alias("f12"))
    rest = pairs.select(F.col("c1").alias("c2"), F.col("c2").alias("c3"), F.col("w1").alias("w2"), F.col("w2").alias("w3"),
                        F.col("f2").alias("f3"), F.col("a").alias("f23"))
    triples = stored(triples.join(head, ["c1", "c2"]).join(rest, ["c2", "c3"]), "triples")
    longer = triples.select("a", F.explode(F.array(F.struct("c1", "c2"), F.struct(F.col("c2").alias("c1"), F.col("c3").alias("c2")))).alias("p")) \
        .groupBy("p.c1", "p.c2").agg(F.max("a").alias("most"))
    left = pairs.join(longer, ["c1", "c2"], "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share))
    wide = lambda c: F.col(c).cast("decimal(15,0)")

    def cut(left_count: str, right_count: str):
        top = wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)")
        exact = F.call_function("div", top, wide(left_count) * wide(right_count))
        return F.struct(exact.cast("long").alias("score"), F.col(left_count).alias("l"), F.col(right_count).alias("r"))

    two = left.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", cut("f1", "f2").alias("cut"))
    first, second = cut("f1", "f23"), cut("f12", "f3")
    weaker = F.when(second.getField("score") < first.getField("score"), second).otherwise(first)
    three = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", weaker.alias("cut"))
    return two.unionByName(three).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, share: int = SHARE, top: int = TOP, lang_col: str = "lang",
                 text_col: str = "text", dense_words: int = DENSE_WORDS, hash_bits: int = 63) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of two and three words.

    All occurrences in all whole texts count, per language; a null language
    is ``und``, a null text empty. A word is read from the vocabulary, by
    its hash, so phrases hold no other text than the documents'. Words rarer
    than ``min_count`` break phrases, since no phrase with one can be a
    candidate. Up to ``dense_words`` frequent words the ids are dense and an
    n-gram takes 64 bits; beyond that they are the hashes themselves, in
    three lanes, with the same result. Words of equal hash get codes of
    their own, so counts are exact.

    Repeated rows count each time. Ties in score and count are ordered by
    phrase, so the result does not depend on the partitioning. Texts of any
    length are read a megabyte at a time, a task holds two bounded tables of
    words and a bounded filter. An empty table gives an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .where("text is not null")
    words = stored(word_counts(texts, hash_bits), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    sizes = words.agg(F.coalesce(F.sum("f"), F.lit(0)), F.count_if(F.col("f") >= min_count)).first()
    clashes = _clashing(words, min_count)
    frequent = words.where(F.col("f") >= min_count)
    code = F.col("h")
    if clashes:
        known = spark.createDataFrame([(lang.decode("utf-8", "surrogatepass"), word.decode("utf-8", "surrogatepass"), c)
                                       for (lang, word), c in clashes.items()], "lang string, word string, clash long")
        frequent = frequent.join(known, ["lang", "word"], "left")
        code = F.coalesce("clash", "h")
    vocabulary = stored(frequent.select("lang", "word", "f", code.alias("code")), "vocabulary")
    table = None
    if sizes[1] <= dense_words:
        table = np.sort(vocabulary.select("code").toArrow().column(0).combine_chunks().to_numpy())
    id_bits = 64 if table is None else max(1, len(table).bit_length())
    quotient_bits = max(6, math.ceil(math.log2(max(2, 2 * sizes[0] / RUN))))
    layout = Layout(id_bits, min(quotient_bits, 3 * id_bits))
    grams = stored(ngram_counts(texts, layout, spark.sparkContext.broadcast(table), clashes, min_count, hash_bits), "ngrams")
    scored = _scored(grams, vocabulary, share)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = some.drop("salt").withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
