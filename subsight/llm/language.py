"""Language identification by character Kneser-Ney models with calibrated rejection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsight.llm.kneser_ney import Model, train
from subsight.llm.tables import stored
from subsight.llm.wordscores import Memory, owners, spelled, words_of

ORDER = 5
#: Each language learns from a hash sample of its rows of about so many characters, calibration included.
SAMPLE_CHARS = 1_500_000
#: Longer texts are sampled for learning in pieces of so many characters (they are predicted, whole).
PIECE_CHARS = 20_000
#: Share of the sample, by hash, held back to calibrate rejection.
CALIBRATION_SHARE = 0.2
#: A text is rejected if its cross-entropy is above that of all but this share of the calibration texts, plus the slack.
REJECT_SHARE, REJECT_SLACK = 0.001, 0.75
UNKNOWN = "und"


@dataclass
class Identifier:
    """Models of all languages, the rejection limits and the sharpness of the score."""

    model: Model
    limits: np.ndarray  #: per language: cross-entropy beyond which a long text is rejected
    per_root: float  #: allowance for short texts: divided by the root of the number of symbols
    sharpness: float = 12.0

    def entropies(self, texts: Sequence[str | None], memory: Memory) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol and language of whole texts, and their number of symbols (0: no letter)."""
        out, sizes = np.zeros((len(texts), len(self.model.classes))), np.zeros(len(texts), np.int64)
        run: list[tuple[int, np.ndarray]] = []
        chars = 0
        for i, text in enumerate(texts):
            ids = np.fromiter(map(memory.__getitem__, words_of(text)), np.int64)
            if len(ids):
                run.append((i, ids))
            chars += len(text or "")
            if chars >= 1 << 20 or i == len(texts) - 1:
                memory.settle()
                for k, ids in run:
                    sizes[k] = memory.sizes[ids].sum()
                    out[k] = -memory.scores[ids].sum(axis=0) / sizes[k]
                memory.trim()
                run, chars = [], 0
        return out, sizes

    def judge(self, texts: Sequence[str | None], memory: Memory) -> tuple[list, list, list, list]:
        """Language, score, cross-entropy and rejection of each text."""
        if not self.model.classes:
            n = len(texts)
            return [UNKNOWN] * n, [0.0] * n, [None] * n, [True] * n
        entropy, sizes = self.entropies(texts, memory)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-self.sharpness * (entropy - least[:, None])).sum(axis=1)
        known = sizes > 0
        far = least > self.limits[best] + self.per_root / np.sqrt(np.maximum(sizes, 1))
        names = [self.model.classes[b] if k else UNKNOWN for b, k in zip(best, known)]
        return (names, np.where(known, score, 0.0).tolist(), [float(e) if k else None for e, k in zip(least, known)],
                (far | ~known).tolist())


def draw_bound(share: float) -> int:
    """The signed 64-bit hash up to which ``share`` of all hashes lie. All 64 bits count, so no share is too small to be kept."""
    return min((1 << 63) - 1, int(min(share, 1.0) * (1 << 64)) - (1 << 63))


def learning_sample(rows: DataFrame, sample_chars: int = SAMPLE_CHARS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``(cls, text, held)``: a hash sample of ``rows(cls, text)`` of about ``sample_chars`` characters a class.

    The share of a class is its budget over the characters of its distinct
    texts, so the distinct rows of the sample are bounded however large the
    table or a class is, but it takes in the piece of least hash, so no class
    is left without one; equal texts are taken or left together, and callers
    collapse them by ``distinct`` (before the shuffle, within each task). Texts of over ``piece_chars`` are drawn in pieces of that
    length (a word on a border counts as two). ``held`` marks the rows kept
    back for calibration, all pieces of a text or none. The bounds, one
    number per class as the models have one column per class, are literals
    of the filter: no text is shuffled.
    """
    usable = rows.where("cls is not null and text is not null") \
        .select("cls", "text", F.xxhash64("text", F.lit("sample")).alias("key"), F.length("text").alias("size"))
    draw = lambda i: F.when(i == 0, F.col("key")).otherwise(F.xxhash64("key", i))
    pieces = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / piece_chars), F.lit(1)).cast("int") - 1)
    least = F.min(F.array_min(F.transform(pieces, draw))).alias("least")
    chars = usable.select("cls", "key", "size").distinct().groupBy("cls").agg(F.sum("size").alias("chars"), least).collect()
    bounds = F.create_map(*[F.lit(x) for r in chars for x in
                            (r["cls"], max(draw_bound(sample_chars / max(1, r["chars"])), r["least"]))]) \
        if chars else F.create_map().cast("map<string,bigint>")
    drawn = F.filter(pieces, lambda i: draw(i) <= F.col("bound"))
    held = F.xxhash64("text", F.lit("held")) <= draw_bound(CALIBRATION_SHARE)
    piece = F.when(F.col("size") <= piece_chars, F.col("text")).otherwise(F.col("text").substr(F.col("i") * piece_chars + 1, F.lit(piece_chars)))
    # Outer, so that the optimizer does not evaluate the draws, and with them the hash of the text, once more in a filter.
    return usable.withColumn("bound", F.try_element_at(bounds, F.col("cls"))) \
        .select("cls", "text", "size", F.explode_outer(drawn).alias("i")).where("i is not null") \
        .select("cls", piece.alias("text"), held.alias("held"))


def word_counts(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for c, t in zip(b.column(0), b.column(1)):
                name = c.as_py()
                seen.update((name, w) for w in words_of(t.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], ["cls", "word", "n"])

    return sample.select("cls", "text").mapInArrow(run, "cls string, word string, n long").groupBy("cls", "word").agg(F.sum("n").alias("n"))


def learning_counts(sample: DataFrame) -> tuple[pa.Table, list[str]]:
    """``(cls, word, n)`` of the rows not held back, and the classes that have no words there (few or equal texts).

    Those classes alone learn from their held rows, which then calibrate
    nothing. Classes without any word are in neither.
    """
    counts = word_counts(sample.where("not held")).toArrow()
    more = word_counts(sample.where(F.col("held") & ~F.col("cls").isin(sorted(set(counts["cls"].to_pylist()))))).toArrow()
    return pa.concat_tables([counts, more]), sorted(set(more["cls"].to_pylist()))


def fit_identifier(rows: DataFrame, order: int = ORDER, sample_chars: int = SAMPLE_CHARS,
                   piece_chars: int = PIECE_CHARS) -> Identifier:
    """Models and rejection limits from ``rows(cls, text)``; only the bounded sample's word counts reach the driver.

    A language without held rows that its model has not seen has no limit:
    texts nearest to it are not rejected.
    """
    sample = stored(learning_sample(rows, sample_chars, piece_chars).distinct(), "language-sample")
    got, learned_held = learning_counts(sample)
    words, at = np.unique(got["word"].to_numpy().astype(str), return_inverse=True)
    classes = sorted(set(got["cls"].to_pylist()))
    if not classes:
        return Identifier(Model([], order, np.zeros(0, np.float32)), np.zeros(0), 0.0)
    counts = np.zeros((len(words), len(classes)))
    np.add.at(counts, (at, np.searchsorted(classes, got["cls"].to_numpy().astype(str))), got["n"].to_numpy())
    codes, place, starts = spelled(words.tolist())
    model = train(codes, place, owners(starts, len(codes)), counts, classes, order)
    draft = Identifier(model, np.full(len(classes), np.inf), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(draft.model)
        for b in batches:
            entropy, sizes = draft.entropies(b.column(1).to_pylist(), memory)
            own = [classes.index(c) if c in classes else -1 for c in b.column(0).to_pylist()]
            ok = [i for i, c in enumerate(own) if c >= 0 and sizes[i]]
            yield pa.RecordBatch.from_arrays([pa.array([own[i] for i in ok], pa.int32()), pa.array([float(entropy[i, own[i]]) for i in ok]),
                                              pa.array([int(sizes[i]) for i in ok], pa.int64())], ["cls", "entropy", "size"])

    unseen = sample.where(F.col("held") & ~F.col("cls").isin(learned_held))
    held = unseen.select("cls", "text").mapInArrow(run, "cls int, entropy double, size long").toArrow()
    cls, entropy, size = (held[c].to_numpy() for c in ("cls", "entropy", "size"))
    # Symbols' surprise has a standard deviation of about 2 nats: three of them over the root of the length.
    per_root = 6.0
    limits = np.full(len(classes), np.inf)
    for c in range(len(classes)):
        excess = entropy[cls == c] - per_root / np.sqrt(size[cls == c])
        if len(excess):
            limits[c] = max(np.quantile(excess, 1 - REJECT_SHARE), np.mean(entropy[cls == c])) + REJECT_SLACK
    return Identifier(model, limits, per_root)


def identify(docs: DataFrame, identifier: Identifier, carry: Sequence[Column], text_col: str = "text") -> DataFrame:
    """``carry`` columns and ``lang_pred, score, entropy, rejected`` per row of ``docs``.

    The language of least cross-entropy per symbol over the whole text; its
    score compares the cross-entropies of all languages (1 / number of
    languages when they are equal). Null and texts without a letter are
    ``und`` with score 0 and rejected; ties go to the first language by
    name. ``rejected`` texts keep the best language as their prediction.
    Without learned languages every text is ``und``. Very long texts are
    scored whole, a megabyte at a time. Repeated rows keep a row each, an
    empty table gives none; no other column is read.
    """
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(identifier.model)
        for b in batches:
            names, score, entropy, rejected = identifier.judge(b.column(n).to_pylist(), memory)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()),
                 pa.array(rejected, pa.bool_())], [*b.schema.names[:n], "lang_pred", "score", "entropy", "rejected"])

    src = docs.select(*carry, F.col(text_col).cast("string").alias("__text"))
    added = T.StructType().add("lang_pred", "string").add("score", "double").add("entropy", "double").add("rejected", "boolean")
    return src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], *added.fields]))


def keep_identified(docs: DataFrame, identifier: Identifier, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the identifier does not reject, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(identifier.model)
        for b in batches:
            rejected = identifier.judge(b.column(at).to_pylist(), memory)[3]
            yield b.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
