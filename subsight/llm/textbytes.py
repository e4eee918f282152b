"""Words of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are taken together up to so many bytes; a longer one is taken alone, whole.
CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = (lower >= 128) | ((lower >= 97) & (lower <= 122)) | ((lower >= 48) & (lower <= 57))
    salt = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return lower, word, salt[lower]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER, _IS_WORD, _SALT = _byte_tables()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = _powers(_BASE, 1 << 16)
    down = _powers(_BASE_INVERSE, 1 << 16)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, min(2 * len(cls.up), 2 * CHUNK_BYTES))
            up, down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
            if size > 2 * CHUNK_BYTES:  # a very long text: not kept
                return up[:n], down[:n]
            cls.up, cls.down = up, down
        return cls.up[:n], cls.down[:n]


@dataclass
class Words:
    """Words of a run of texts: byte spans, 64-bit hashes and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  #: of text i: words first[i] to first[i + 1]

    def text(self, a: int, b: int) -> str:
        """Words a to b, lower-cased, joined by single spaces."""
        lower = _LOWER
        return b" ".join(lower[self.data[s:e]].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b])).decode("utf-8", "replace")


def _views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _words(data: np.ndarray, bounds: np.ndarray) -> Words:
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    inside = _IS_WORD[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _Powers.of(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SALT[data] * up, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, bounds))


def word_runs(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """``(i, j, words)`` of texts i to j of ``column``, about ``CHUNK_BYTES`` at a time.

    Words are runs of ASCII letters, digits and non-ASCII characters, with
    A-Z lower-cased for the hash. Null is the empty text; no word spans two
    texts.
    """
    at, data = _views(column)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK_BYTES, "right")) - 1)
        yield i, j, _words(data[at[i]:at[j]], at[i:j + 1] - at[i])
        i = j
