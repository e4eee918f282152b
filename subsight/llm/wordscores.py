"""Scores of words under character models, remembered between texts."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

from subsight.llm.kneser_ney import Model

#: Words and their characters that a worker remembers scores of; a full memory is emptied, which changes speed only.
MEMORY_WORDS, MEMORY_CHARS = 1 << 18, 1 << 22
_WORD = re.compile(r"[^\W\d_]+")
_START, _END = "\x02", "\x03"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; none if the text has no letter."""
    words = _WORD.findall(text.lower()) if text else []
    return words if any(w.isalpha() for w in words) or any(c.isalpha() for w in words for c in w) else []


def spelled(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the words between start and end marks, each code's place in its word, each word's first code."""
    text = _START + (_END + _START).join(words) + _END
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return codes, np.arange(len(codes)) - np.repeat(starts, sizes), starts


def owners(starts: np.ndarray, n: int) -> np.ndarray:
    """The word of each of ``n`` codes."""
    return np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, n)))


class Memory(dict):
    """Word to row of ``scores``; a new word gets the next row and waits for its score."""

    def __init__(self, model: Model):
        self.model = model
        self.waiting: list[str] = []
        self.chars = 0
        self.scores = np.zeros((1024, len(model.classes)), np.float64)
        self.sizes = np.zeros(1024, np.int64)

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.waiting.append(word)
        self.chars += len(word)
        return i

    def settle(self) -> None:
        if not self.waiting:
            return
        if len(self) > len(self.sizes):
            room = max(len(self), 2 * len(self.sizes)) - len(self.sizes)
            self.scores = np.concatenate([self.scores, np.zeros((room, self.scores.shape[1]))])
            self.sizes = np.concatenate([self.sizes, np.zeros(room, np.int64)])
        codes, place, starts = spelled(self.waiting)
        logp = self.model.score(codes, place)
        logp[starts] = 0  # the start mark is no prediction
        rows = slice(len(self) - len(self.waiting), len(self))
        self.scores[rows] = np.add.reduceat(logp, starts, axis=0)
        self.sizes[rows] = np.diff(np.append(starts, len(codes))) - 1
        self.waiting = []

    def trim(self) -> None:
        if len(self) > MEMORY_WORDS or self.chars > MEMORY_CHARS:
            self.clear()
            self.chars = 0
