"""Whole texts scored by a plain Kneser-Ney over dictionaries, written apart from the library's arrays."""

import random
from collections import Counter
from math import log

import numpy as np
import pytest

from subsight.llm import language as L
from subsight.llm import toxicity as X
from subsight.llm.wordscores import Memory, words_of


class Plain:
    """Counts of every class as dictionaries, the formula as a recursion. A sequence's first symbol is no prediction."""

    def __init__(self, sequences, order, shared=0, least=1):
        self.order, self.least = order, least
        self.raw = [{} for _ in range(order + 1)]
        seen = [{} for _ in range(order + 1)]
        classes = sorted(sequences)
        for c in classes:
            for n in range(1, order + 1):
                count = Counter()
                for s, times in sequences[c].items():
                    for i in range(0 if n > 1 else 1, len(s) - n + 1):
                        count[s[i:i + n]] += times
                self.raw[n][c] = count
        starts = {s[:1] for c in classes for s in sequences[c]}
        for c in classes:
            for n in range(1, order + 1):
                left = Counter(g[1:] for g in self.raw[n + 1][c]) if n < order else {}
                # no n-gram but the first of a sequence holds its start mark
                seen[n][c] = {g: k if n == order or (n > 1 and g[:1] in starts) else left.get(g, 0) for g, k in self.raw[n][c].items()}
                if n == 1:
                    seen[n][c] = dict(left) if order > 1 else seen[n][c]
        for n in range(1, shared + 1):
            pool = Counter()
            for c in classes:
                pool.update(seen[n][c])
            for c in classes:
                seen[n][c] = dict(pool)
        self.seen, self.classes = seen, classes
        self.symbols = len({g for c in classes for g in self.raw[1][c]})
        self.discount, self.after = {}, {}
        for n in range(1, order + 1):
            for c in classes:
                ones, twos = (sum(k == v for k in seen[n][c].values()) for v in (1, 2))
                self.discount[n, c] = ones / (ones + 2 * twos) if ones and twos else 0.5
                for g, k in seen[n][c].items():
                    self.after.setdefault((n, c, g[:-1]), []).append((g, k))

    def p(self, c, context, symbol):
        n = len(context) + 1
        d = self.discount[n, c]
        follow = [(g, k) for g, k in self.after.get((n, c, context), []) if k > 0]
        total = sum(k for _, k in follow)
        if n == 1:
            return max(dict(follow).get((symbol,), 0) - d, 0) / total + d * len(follow) / total / (self.symbols + 1)
        lower = self.p(c, context[1:], symbol)
        if not total:
            return lower
        kept = {g: k - d for g, k in follow if sum(self.raw[n][x].get(g, 0) for x in self.classes) >= self.least and k > d}
        return kept.get((*context, symbol), 0) / total + (1 - sum(kept.values()) / total) * lower

    def logs(self, c, s):
        return [log(self.p(c, s[max(0, i - self.order + 1):i], s[i])) for i in range(1, len(s))]


def spelled(word):
    return ("\x02", *word, "\x03")


def made(seed, syllables, n, longest=3):
    r = random.Random(seed)
    return [" ".join("".join(r.choice(syllables) for _ in range(r.randint(1, longest))) for _ in range(r.randint(4, 20))) for _ in range(n)]


@pytest.mark.parametrize("order", [2, 3, 5])
def test_language_scores_of_whole_texts(spark, order):
    texts = {"aa": made(1, ["ba", "na", "do", "x"], 40), "bb": made(2, ["ri", "na", "tu", "o"], 40), "cc": made(3, ["ba", "tu", "é", "szk"], 40)}
    rows = spark.createDataFrame([(c, t) for c, ts in texts.items() for t in ts], "cls string, text string")
    sequences = {c: Counter() for c in texts}
    for r in L.learning_sample(rows).distinct().where("not held").collect():
        sequences[r.cls].update(map(spelled, words_of(r.text)))
    plain = Plain(sequences, order)
    identifier = L.fit_identifier(rows, order)
    unseen = ["bana riri szkoda", "Nana DOBA", "é", "wholly other words, tuna!", *made(9, ["ba", "ri", "szk", "q"], 10)]
    entropy, sizes = identifier.entropies(unseen, Memory(identifier.model))
    for text, got, size in zip(unseen, entropy, sizes):
        words = [spelled(w) for w in words_of(text)]
        want = [-sum(x for w in words for x in plain.logs(c, w)) / size for c in plain.classes]
        assert size == sum(len(w) - 1 for w in words) and np.allclose(got, want, rtol=1e-4), text


def test_toxicity_features_of_whole_texts(spark):
    texts = {"0": made(4, ["ba", "na", "do", "ri", "bana", "x"], 60, 1), "1": made(5, ["ba", "na", "tu", "ri", "natu", "x"], 60, 1)}
    rows = spark.createDataFrame([(c, t) for c, ts in texts.items() for t in ts], "cls string, text string")
    letters, phrases = {c: Counter() for c in texts}, {c: Counter() for c in texts}
    for r in L.learning_sample(rows, X.SAMPLE_CHARS, X.PIECE_CHARS).distinct().where("not held").collect():
        letters[r.cls].update(map(spelled, words_of(r.text)))
        phrases[r.cls][("", *words_of(r.text))] += 1
    chars = Plain(letters, X.ORDER, X.SHARED_ORDERS)
    words = Plain(phrases, X.PHRASE_ORDER, X.PHRASE_SHARED, X.PHRASE_LEAST)
    assert any(k >= X.PHRASE_LEAST for k in words.raw[3]["0"].values()) and any(k < X.PHRASE_LEAST for k in words.raw[3]["0"].values())
    scorer = X.fit_scorer(rows)
    unseen = ["ba", "bana dodo tuba", "Ba na, do NA ba never", *made(8, ["ba", "na", "do", "tu", "x"], 12, 2)]
    for text, got in zip(unseen, scorer.features(unseen, X.WordMemory(scorer.model))):
        ws = words_of(text)
        ratio = [sum(chars.logs("1", spelled(w))) - sum(chars.logs("0", spelled(w))) for w in ws]
        step = [b - a for a, b in zip(words.logs("0", ("", *ws)), words.logs("1", ("", *ws)))]
        n = min(X.PHRASE_WORDS, len(step))
        windows = [sum(step[i:i + n]) / X.PHRASE_WORDS for i in range(len(step) - n + 1)]
        want = [max(r / (len(w) + 1) for r, w in zip(ratio, ws)), max(ratio), sum(ratio) / sum(len(w) + 1 for w in ws), max(windows)]
        assert np.allclose(got, want, rtol=1e-3, atol=1e-4), (text, got, want)
