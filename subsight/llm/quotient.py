"""Counting quotient filters of packed word-id n-grams: exact counters in few bytes, merged across shards.

A packed n-gram is permuted invertibly. The leading bits of the result, the
quotient, name a run; a run holds the full remainders in order, so nothing
is lost and the n-gram can be read back. A counter takes a slot per non-zero
base-32 digit, as the remainder and one byte of digit and exponent; merging
adds the digits of equal remainders.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from subsight.llm.textbytes import mix

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
#: Keys gathered before they are counted, and entries a shard's filter holds before it is handed on.
BUFFER = 1 << 19
CAPACITY = 1 << 21


def _unmix_shift(x: np.ndarray, s: int) -> np.ndarray:
    out = x.copy()
    for _ in range(64 // s):
        out = x ^ (out >> np.uint64(s))
    return out


@dataclass(frozen=True)
class Layout:
    """How three ids of ``id_bits`` bits become a permuted key, its quotient of ``quotient_bits`` bits and its remainder.

    Ids that fit 64 bits together take one lane, wider ones three. Zero is
    no id; the third id of a pair is zero.
    """

    id_bits: int
    quotient_bits: int

    @property
    def lanes(self) -> int:
        return 1 if 3 * self.id_bits <= 64 else 3

    @property
    def key_bits(self) -> int:
        return 3 * self.id_bits if self.lanes == 1 else 64

    @property
    def slot_bytes(self) -> int:
        """Bytes of a remainder and its digit."""
        return -(-(self.key_bits - self.quotient_bits) // 8) + 8 * (self.lanes - 1) + 1

    def _mask(self, bits: int) -> np.uint64:
        return np.uint64((1 << bits) - 1)

    def permute(self, ids: np.ndarray) -> np.ndarray:
        """Keys ``(n, lanes)`` of ``ids (n, 3)``."""
        if self.lanes == 3:
            keys = ids.copy()
            keys[:, 0] = mix(ids[:, 0] ^ mix(ids[:, 1] ^ mix(ids[:, 2])))
            return keys
        b, mask, s = np.uint64(self.id_bits), self._mask(self.key_bits), np.uint64((self.key_bits + 1) // 2)
        x = ids[:, 0] | (ids[:, 1] << b) | (ids[:, 2] << (b + b))
        for m in _MULTIPLIERS:
            x = ((x ^ (x >> s)) * np.uint64(m)) & mask
        return (x ^ (x >> s)).reshape(-1, 1)

    def invert(self, keys: np.ndarray) -> np.ndarray:
        """The ids of ``permute``."""
        if self.lanes == 3:
            ids = keys.copy()
            x = _unmix_shift(keys[:, 0], 31) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
            x = _unmix_shift(x, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
            ids[:, 0] = _unmix_shift(x, 30) ^ mix(keys[:, 1] ^ mix(keys[:, 2]))
            return ids
        b, mask, s = self.id_bits, self._mask(self.key_bits), np.uint64((self.key_bits + 1) // 2)
        x = keys[:, 0] ^ (keys[:, 0] >> s)
        for m in reversed(_MULTIPLIERS):
            x = (x * np.uint64(pow(m, -1, 1 << 64))) & mask
            x = x ^ (x >> s)
        one = self._mask(b)
        return np.stack([(x >> np.uint64(k * b)) & one for k in range(3)], axis=1)

    def slots(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quotients ``(m)`` and slots ``(m, slot_bytes)`` of sorted keys with their counts, in order."""
        digits, owners = [], []
        for e in range(8):
            d = (counts >> (5 * e)) & 31
            held = np.flatnonzero(d)
            digits.append((d[held] | (e << 5)).astype(np.uint8))
            owners.append(held)
            if not len(held) and not np.any(counts >> (5 * e)):
                break
        owner, digit = np.concatenate(owners), np.concatenate(digits)
        order = np.argsort(owner, kind="stable")
        owner, digit = owner[order], digit[order]
        rest = self.key_bits - self.quotient_bits
        first = keys[:, 0]
        quotient = first >> np.uint64(rest) if rest < 64 else np.zeros_like(first)
        low = (first & self._mask(rest)).view(np.uint8).reshape(-1, 8)[:, :-(-rest // 8)]
        remainder = [low] + [np.ascontiguousarray(keys[:, k]).view(np.uint8).reshape(-1, 8) for k in range(1, self.lanes)]
        return quotient[owner], np.concatenate([np.concatenate(remainder, axis=1)[owner], digit[:, None]], axis=1)

    def entries(self, quotients: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of slots, one entry a slot."""
        rest = self.key_bits - self.quotient_bits
        width = -(-rest // 8)
        keys = np.zeros((len(slots), self.lanes), np.uint64)
        low = np.zeros((len(slots), 8), np.uint8)
        low[:, :width] = slots[:, :width]
        keys[:, 0] = low.view(np.uint64)[:, 0]
        if rest < 64:
            keys[:, 0] |= quotients << np.uint64(rest)
        for k in range(1, self.lanes):
            at = width + 8 * (k - 1)
            keys[:, k] = np.ascontiguousarray(slots[:, at:at + 8]).view(np.uint64)[:, 0]
        digit = slots[:, -1].astype(np.int64)
        return keys, (digit & 31) << (5 * (digit >> 5))


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed counts (one each where none are given)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if keys.shape[1] == 1:
        order = None if counts is None else np.argsort(keys[:, 0], kind="stable")
        found = np.sort(keys[:, 0]) if order is None else keys[order, 0]
        new = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        found = found.reshape(-1, 1)
    else:
        order = np.lexsort(keys.T[::-1])
        found = keys[order]
        new = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]).any(axis=1)]))
    if counts is None:
        return found[new], np.diff(np.append(new, len(found))).astype(np.int64)
    return found[new], np.add.reduceat(counts[order], new)


class Filter:
    """The filter of one shard: sorted runs of keys and counts, merged when they fill it, handed on when that frees too little."""

    def __init__(self, layout: Layout, capacity: int = CAPACITY):
        self.layout, self.capacity = layout, capacity
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, ids: np.ndarray) -> pa.RecordBatch | None:
        """Counts the n-grams ``ids (n, 3)``; the full filter's runs if it had to be emptied."""
        keys, counts = counted(self.layout.permute(ids))
        self.runs.append((keys, counts))
        self.held += len(keys)
        if self.held < self.capacity:
            return None
        self._merge()
        return self.take() if self.held > self.capacity // 2 else None

    def _merge(self) -> None:
        keys, counts = counted(np.concatenate([k for k, _ in self.runs]), np.concatenate([c for _, c in self.runs]))
        self.runs, self.held = [(keys, counts)], len(keys)

    def take(self) -> pa.RecordBatch | None:
        """A row ``(quotient, slots)`` for each run, and an empty filter."""
        if not self.held:
            return None
        if len(self.runs) > 1:
            self._merge()
        quotients, slots = self.layout.slots(*self.runs[0])
        self.runs, self.held = [], 0
        first = np.flatnonzero(np.concatenate([[True], quotients[1:] != quotients[:-1]]))
        offsets = (np.append(first, len(quotients)) * self.layout.slot_bytes).astype(np.int32)
        data = pa.py_buffer(np.ascontiguousarray(slots).tobytes())
        runs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), data])
        return pa.RecordBatch.from_arrays([pa.array(quotients[first].view(np.int64)), runs], ["quotient", "slots"])


def merged(batches: Iterator[pa.RecordBatch], layout: Layout, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids ``(n, 3)`` and counts of the n-grams with at least ``least``, from rows ``(quotient, slots)`` sorted by quotient.

    Holds the runs of a few quotients at a time; the last one of a batch
    waits for the next.
    """
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def finished(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = counted(*(np.concatenate(p) for p in zip(*parts)))
        often = counts >= least
        return layout.invert(keys[often]), counts[often]

    for b in batches:
        if not b.num_rows:
            continue
        runs = b.column(1).cast(pa.large_binary())
        _, offsets, data = runs.buffers()
        at = np.frombuffer(offsets, np.int64)[runs.offset:runs.offset + len(runs) + 1]
        slots = np.frombuffer(data, np.uint8)[at[0]:at[-1]].reshape(-1, layout.slot_bytes)
        quotient = np.asarray(b.column(0)).view(np.uint64)
        keys, counts = layout.entries(np.repeat(quotient, np.diff(at) // layout.slot_bytes), slots)
        if quotient[0] != quotient[-1] or (waiting and _quotient(waiting[-1][0][-1:], layout) != quotient[0]):
            split = int(np.searchsorted(np.repeat(quotient, np.diff(at) // layout.slot_bytes), quotient[-1]))
            yield finished([*waiting, (keys[:split], counts[:split])])
            waiting = [(keys[split:], counts[split:])]
        else:
            waiting.append((keys, counts))
    if waiting:
        yield finished(waiting)


def _quotient(keys: np.ndarray, layout: Layout) -> np.uint64:
    rest = layout.key_bits - layout.quotient_bits
    return (keys[:, 0] >> np.uint64(rest))[0] if rest < 64 else np.uint64(0)
