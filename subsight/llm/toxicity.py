"""Toxicity by class-conditional Kneser-Ney models of words' characters and of phrases' words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsight.llm.kneser_ney import Model, train
from subsight.llm.language import draw_bound, learning_counts, learning_sample
from subsight.llm.tables import stored
from subsight.llm.wordscores import Memory, owners, spelled, words_of

ORDER = 6
#: The counts of so many lowest orders are pooled over both classes.
SHARED_ORDERS = 2
#: The models of phrases: words of an n-gram, orders with pooled counts, how often an n-gram occurs at least.
PHRASE_ORDER, PHRASE_SHARED, PHRASE_LEAST = 3, 1, 4
#: Phrases are judged by windows of so many words.
PHRASE_WORDS = 3
#: Phrases of each class are learned from a hash sample of its rows of about so many characters.
PHRASE_CHARS = 2_000_000
#: Words scored at once, a bound of memory for very long texts.
BLOCK_WORDS = 1 << 18
#: Each class learns from a hash sample of its rows of about so many characters, calibration included.
SAMPLE_CHARS = 8_000_000
#: Longer texts are sampled in pieces of so many characters.
PIECE_CHARS = 200_000
CLASSES = ["0", "1"]
#: Of each class a hash sample of about so many labelled ids is joined to the texts.
SAMPLE_IDS = 2500


class WordMemory(Memory):
    """Remembers a hash of each word as well."""

    def __init__(self, model: Model):
        super().__init__(model)
        self.codes = np.zeros(1024, np.uint64)

    def settle(self) -> None:
        new = self.waiting
        super().settle()
        if new:
            if len(self) > len(self.codes):
                self.codes = np.concatenate([self.codes, np.zeros(len(self.sizes) - len(self.codes), np.uint64)])
            self.codes[len(self) - len(new):len(self)] = word_codes(new)


def word_codes(words: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def _sequences(codes: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts, each text behind a start mark; each code's place in its text; each text's first code."""
    sizes = np.array([len(c) + 1 for c in codes], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    joined = np.zeros(sizes.sum(), np.uint64)
    place = np.arange(len(joined)) - np.repeat(starts, sizes)
    if len(codes):
        joined[place > 0] = np.concatenate(codes)
    return joined, place, starts


@dataclass
class Scorer:
    model: Model  #: of the characters of words
    phrases: Model  #: of the words of texts
    weights: np.ndarray  #: of the features and the constant

    FEATURES = 4

    def _phrase_ratios(self, codes: Sequence[np.ndarray]) -> Iterator[float]:
        """Per text: the largest length-normalised log-likelihood ratio of a window of words."""
        joined, place, starts = _sequences(codes)
        ratio = np.zeros(len(joined), np.float32)
        before = self.phrases.order - 1
        for lo in range(0, len(joined), BLOCK_WORDS):
            a = max(0, lo - before)
            logp = self.phrases.score(joined[a:lo + BLOCK_WORDS], place[a:lo + BLOCK_WORDS])[lo - a:]
            ratio[lo:lo + BLOCK_WORDS] = logp[:, 1] - logp[:, 0]
        for start, c in zip(starts, codes):
            total = np.concatenate([[0], np.cumsum(ratio[start + 1:start + 1 + len(c)], dtype=np.float64)])
            w = min(PHRASE_WORDS, len(c))
            yield (total[w:] - total[:-w]).max() / PHRASE_WORDS

    def features(self, texts: Sequence[str | None], memory: WordMemory) -> np.ndarray:
        """Per text: the largest length-normalised log-likelihood ratio of a word, the largest plain one, the text's, a phrase's.

        A ratio is that of the toxic to the ordinary model; a length is in
        symbols, in words for phrases. Texts without letters have zeros.
        """
        out = np.zeros((len(texts), self.FEATURES))
        run, chars = [], 0
        for i, text in enumerate(texts):
            ids = np.fromiter(map(memory.__getitem__, words_of(text)), np.int64)
            if len(ids):
                run.append((i, ids))
            chars += len(text or "")
            if chars >= 1 << 20 or i == len(texts) - 1:
                memory.settle()
                for (k, ids), phrase in zip(run, self._phrase_ratios([memory.codes[ids] for _, ids in run])):
                    ratio, size = memory.scores[ids, 1] - memory.scores[ids, 0], memory.sizes[ids]
                    out[k] = (ratio / size).max(), ratio.max(), ratio.sum() / size.sum(), phrase
                memory.trim()
                run, chars = [], 0
        return out

    def score(self, texts: Sequence[str | None], memory: WordMemory) -> np.ndarray:
        x = self.features(texts, memory)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and constant of a ridge-penalised logistic regression, by Newton's method on scaled columns."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T * (p * (1 - p) + 1e-9) @ z / len(x) + ridge, z.T @ (p - y) / len(x) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1])


def labelled_texts(docs: DataFrame, labels: DataFrame, sample_ids: int = SAMPLE_IDS, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(cls, text)`` of a hash sample of the ids that ``labels`` marks 0 or 1.

    The sampled ids, distinct, are about ``sample_ids`` a class whatever the
    tables' size, so that side is broadcast and no text is shuffled.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("mark_id"), F.col(label_col).cast("string").alias("cls")) \
        .where(F.col("mark_id").isNotNull() & F.col("cls").isin(*CLASSES)).distinct()
    count = {r["cls"]: r["n"] for r in marks.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = lambda cls: F.lit(draw_bound(sample_ids / max(1, count.get(cls, 0))))
    drawn = F.xxhash64("mark_id", F.lit("sample")) <= F.when(F.col("cls") == "1", bound("1")).otherwise(bound("0"))
    texts = docs.select(F.col(id_col).cast("long").alias("text_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(marks.where(drawn)), F.col("text_id") == F.col("mark_id")).select("cls", "text")


def fit_phrases(rows: DataFrame, learned_held: Sequence[str], phrase_chars: int = PHRASE_CHARS,
                piece_chars: int = PIECE_CHARS, least_count: int = PHRASE_LEAST) -> Model:
    """Models of the words of texts, from a bounded hash sample of ``rows(cls, text)`` without those held back.

    Rows of the classes ``learned_held`` are not held back. Word sequences
    reach the driver as hashes, about 1.5 bytes a character of the sample.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [word_codes(words_of(t)).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes, pa.binary())], ["cls", "codes"])

    sample = learning_sample(rows, phrase_chars, piece_chars).where(~F.col("held") | F.col("cls").isin(list(learned_held)))
    got = sample.select("cls", "text").distinct().mapInArrow(run, "cls string, codes binary").toArrow()
    codes, place, starts = _sequences([np.frombuffer(c, np.uint64) for c in got["codes"].to_pylist()])
    toxic = np.array([c == "1" for c in got["cls"].to_pylist()], bool)
    counts = np.column_stack([~toxic, toxic]).astype(float)
    return train(codes, place, owners(starts, len(codes)), counts, CLASSES, PHRASE_ORDER, PHRASE_SHARED, least_count)


def _blank() -> Model:
    """A model that finds every symbol equally likely in both classes."""
    return Model(CLASSES, 1, np.zeros(2, np.float32), [np.zeros(0, np.uint64)], [np.zeros((0, 2), np.float32)])


def fit_scorer(rows: DataFrame, order: int = ORDER, shared_orders: int = SHARED_ORDERS,
               sample_chars: int = SAMPLE_CHARS, piece_chars: int = PIECE_CHARS, phrase_chars: int = PHRASE_CHARS) -> Scorer:
    """A scorer from ``rows(cls, text)`` with cls "0" or "1".

    The models learn from bounded hash samples per class; the weights that
    compare the ratios are fitted on rows held back from them. A class without
    rows makes every score 0 or 1, the class that exists; no rows at all
    make every score 0.
    """
    rows = stored(rows.where(F.col("cls").isin(*CLASSES)), "labelled-texts")  # read several times below
    sample = stored(learning_sample(rows, sample_chars, piece_chars).distinct(), "toxicity-sample")
    got, learned_held = learning_counts(sample)
    words, at = np.unique(got["word"].to_numpy().astype(str), return_inverse=True)
    cls = got["cls"].to_numpy().astype(str)
    if len(set(cls.tolist())) < 2:
        return Scorer(_blank(), _blank(), np.array([0.0] * Scorer.FEATURES + [50.0 if "1" in cls else -50.0]))
    counts = np.zeros((len(words), 2))
    np.add.at(counts, (at, (cls == "1").astype(int)), got["n"].to_numpy())
    codes, place, starts = spelled(words.tolist())
    model = train(codes, place, owners(starts, len(codes)), counts, CLASSES, order, shared_orders)
    draft = Scorer(model, fit_phrases(rows, learned_held, phrase_chars, piece_chars), np.zeros(Scorer.FEATURES + 1))
    names = [f"x{k}" for k in range(Scorer.FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(draft.model)
        for b in batches:
            x = draft.features(b.column(1).to_pylist(), memory)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[:, k]) for k in range(len(names)))], ["cls", *names])

    unseen = sample.where(F.col("held") & ~F.col("cls").isin(learned_held))
    held = unseen.select("cls", "text").mapInArrow(run, ", ".join(["cls string", *(f"{x} double" for x in names)])).toArrow()
    y = (held["cls"].to_numpy().astype(str) == "1").astype(float)
    if 0 < y.sum() < len(y):
        draft.weights = _logistic(np.column_stack([held[x].to_numpy() for x in names]), y)
    else:  # too few rows to hold any back: equal likelihoods of the likeliest word are undecided
        draft.weights = np.array([4.0] + [0.0] * Scorer.FEATURES)
    return draft


def score_toxicity(docs: DataFrame, scorer: Scorer, carry: Sequence[Column], text_col: str = "text") -> DataFrame:
    """``carry`` columns and ``score, predicted`` per row of ``docs``, over whole texts.

    Null, empty and letterless texts have the score of no evidence; a score
    of exactly 0.5 predicts 1. Very long texts are scored whole. Repeated
    rows keep a row each, an empty table gives none; no other column than
    the text is an input.
    """
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(scorer.model)
        for b in batches:
            score = scorer.score(b.column(n).to_pylist(), memory)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             [*b.schema.names[:n], "score", "predicted"])

    src = docs.select(*carry, F.col(text_col).cast("string").alias("__text"))
    added = T.StructType().add("score", "double").add("predicted", "integer")
    return src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], *added.fields]))
