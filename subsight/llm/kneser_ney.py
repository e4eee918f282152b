"""Interpolated Kneser-Ney n-gram models of several classes, stored in sorted hash arrays.

Symbols are 64-bit codes. All classes share the arrays of an order: one
sorted array of n-gram hashes with a column of probabilities per class, and
one of context hashes with a column of backoff weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count, islice

import numpy as np

from subsight.llm.textbytes import mix

_STEP = np.uint64(0x9FB21C651E98DF25)


def rolling_hashes(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For n of 1, 2, ...: the hash of the n codes that end at each place (rubbish in the first n - 1)."""
    h = mix(codes + np.uint64(1))
    for n in count(2):
        yield h
        longer = np.zeros(len(codes), np.uint64)
        longer[1:] = mix(h[:-1] * _STEP + codes[1:] + np.uint64(n))
        h = longer


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def _discount(counts: np.ndarray) -> float:
    n1, n2 = int((counts == 1).sum()), int((counts == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


@dataclass
class Model:
    classes: list[str]
    order: int
    unseen: np.ndarray  #: log probability of a symbol never seen, per class
    grams: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)

    def score(self, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Log probability of each code per class, given up to order - 1 codes before it.

        ``place`` is a code's place in its sequence; only earlier codes of
        the sequence are context. The longest n-gram found holds the
        interpolated probabilities of all classes; a miss multiplies in the
        context's backoff weight and looks one order down.
        """
        hashes = list(islice(rolling_hashes(codes), self.order))
        out = np.zeros((len(codes), len(self.classes)), np.float32)
        todo = np.arange(len(codes))
        for n in range(self.order, 0, -1):
            fits = place[todo] >= n - 1
            now, later = todo[fits], todo[~fits]
            at = _find(self.grams[n - 1], hashes[n - 1][now])
            hit = at >= 0
            out[now[hit]] += self.logp[n - 1][at[hit]]
            missed = now[~hit]
            if n == 1:
                out[missed] += self.unseen
            else:
                ctx = _find(self.contexts[n - 1], hashes[n - 2][missed - 1])
                known = ctx >= 0
                out[missed[known]] += self.backoff[n - 1][ctx[known]]
            todo = np.concatenate([later, missed])
        return out


def train(codes: np.ndarray, place: np.ndarray, owner: np.ndarray, counts: np.ndarray, classes: list[str], order: int,
          shared_orders: int = 0, least_count: int = 1) -> Model:
    """A model from sequences: code i belongs to sequence ``owner[i]``, which occurs ``counts[owner[i], c]`` times in class c.

    Below the highest order an n-gram counts by its distinct left
    extensions (n-grams at a sequence's start by occurrences). Each order
    has one absolute discount per class; the unigrams are interpolated with
    a uniform distribution over the symbols seen and one more. The counts of
    the lowest ``shared_orders`` orders are those of all classes pooled, so
    what is rare in one class is smoothed by what all classes know of it.
    Of two and more symbols only n-grams that occur ``least_count`` times in
    all classes together are kept; the mass of the others goes to the
    context's backoff weight, so probabilities still sum to one. The first place of a sequence is a start mark and no prediction.
    """
    each = range(len(classes))
    model = Model(classes, order, np.zeros(len(classes), np.float32))
    uniq, raw, opens, suffix, context = [], [], [], [], []  # per order, one row per different n-gram
    shorter = None
    for n, h in enumerate(islice(rolling_hashes(codes), order), 1):
        at = np.flatnonzero(place >= max(n - 1, 1))
        keys, first, inverse = np.unique(h[at], return_index=True, return_inverse=True)
        own, first = owner[at], at[first]
        uniq.append(keys)
        raw.append(np.stack([np.bincount(inverse, counts[own, c], len(keys)) for c in each], axis=1))
        opens.append(place[first] == n - 1)
        suffix.append(shorter[first] if n > 1 else None)
        context.append(shorter[first - 1] if n > 1 else None)
        shorter = h
    below = None
    for n in range(order):  # n + 1 symbols
        seen = raw[n]
        if n + 1 < order:
            of = _find(uniq[n], suffix[n + 1])
            extended = np.stack([np.bincount(of, raw[n + 1][:, c] > 0, len(uniq[n])) for c in each], axis=1)
            seen = np.where(opens[n][:, None] & (n > 0), raw[n], extended)
        if n < shared_orders:
            seen = np.repeat(seen.sum(axis=1, keepdims=True), len(classes), axis=1)
        d = np.array([_discount(seen[:, c]) for c in each])
        if n == 0:
            total = np.maximum(seen.sum(axis=0), 1)
            spread = np.maximum(d * (seen > 0).sum(axis=0) / total / (len(uniq[0]) + 1), 1e-9)
            p = np.maximum(seen - d, 0) / total + spread
            model.unseen = np.log(spread).astype(np.float32)
            model.contexts.append(np.zeros(0, np.uint64))
            model.backoff.append(np.zeros((0, len(classes)), np.float32))
        else:
            ctx_keys, ctx = np.unique(context[n], return_inverse=True)
            total = np.stack([np.bincount(ctx, seen[:, c], len(ctx_keys)) for c in each], axis=1)
            kinds = np.stack([np.bincount(ctx, seen[:, c] > 0, len(ctx_keys)) for c in each], axis=1)
            weight = np.where(total > 0, d * kinds / np.maximum(total, 1e-12), 1.0)
            kept = raw[n].sum(axis=1) >= least_count
            if not kept.all():  # a suffix occurs as often as its n-gram at least, so it was kept as well
                cut = np.stack([np.bincount(ctx[~kept], np.maximum(seen - d, 0)[~kept, c], len(ctx_keys)) for c in each], axis=1)
                weight += np.where(total > 0, cut / np.maximum(total, 1e-12), 0)
                used = np.bincount(ctx[kept], minlength=len(ctx_keys)) > 0  # elsewhere the weight is one
                ctx_keys, weight, total = ctx_keys[used], weight[used], total[used]
                ctx = (np.cumsum(used) - 1)[ctx[kept]]
                uniq[n], seen, suffix[n] = uniq[n][kept], seen[kept], suffix[n][kept]
            lower = below[_find(uniq[n - 1], suffix[n])]
            p = np.where(total[ctx] > 0, np.maximum(seen - d, 0) / np.maximum(total[ctx], 1e-12), 0) + weight[ctx] * lower
            model.contexts.append(ctx_keys)
            model.backoff.append(np.log(np.maximum(weight, 1e-12)).astype(np.float32))
        model.grams.append(uniq[n])
        model.logp.append(np.log(np.maximum(p, 1e-30)).astype(np.float32))
        below = p
    return model
