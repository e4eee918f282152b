"""Collocations against brute force over all phrases; the quotient filter against a plain counter."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from subsight.llm import quotient
from subsight.llm.collocations import _ngrams, _tokens, collocations
from subsight.llm.quotient import Filter, Layout, merged

from .conftest import SMALL


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower)]


def brute(rows, least=10, share=50, top=2000):
    """Result rows of ``(lang, text)`` rows."""
    langs = {}
    for lang, text in rows:
        counts = langs.setdefault("und" if lang is None else lang, [Counter(), Counter(), Counter()])
        for words in pieces(text):
            for k, c in enumerate(counts):
                c.update(zip(*(words[i:] for i in range(k + 1))))
    out = set()
    for lang, counts in langs.items():
        n, f = sum(counts[0].values()), lambda p, c=counts: c[len(p) - 1][p]
        longer = Counter()
        for p, a in counts[2].items():
            for q in (p[:2], p[1:]):
                longer[q] = max(longer[q], a if a >= least else 0)
        found = []
        for p, a in [*counts[1].items(), *counts[2].items()]:
            if a >= least and not (len(p) == 2 and longer[p] and 100 * longer[p] >= share * a):
                score, k = min((10**6 * a * a // (f(p[:k]) * f(p[k:])), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f(p[:k]), f(p[k:])))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "text").collect()]


@pytest.mark.parametrize("options", [{}, {"dense_words": 0}, {"hash_bits": 11}, {"hash_bits": 11, "dense_words": 0}])
def test_equals_brute_force(spark, options):
    """Dense ids and hashes as ids, and hashes so short that many words share one, give the same."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = collocations(docs, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == brute(rows_of(docs))


def test_bounds_do_not_change_the_result(spark, documents, monkeypatch):
    """Repeated words, ties, cuts that tie, small top and buffers; a phrase across the border of a chunk counts."""
    r = random.Random(3)
    words = ["new", "york", "city", "a", "the", "Émile", "x_y", "\x00", "é"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(r.randint(0, 90))),
             r.choice(["en", "de", None, "und"]), "s") for i in range(80)]
    docs = documents(rows)
    want = brute([(lang, t) for _, t, lang, _ in rows], least=4, share=30, top=7)
    assert {tuple(x) for x in collocations(docs, min_count=4, share=30, top=7).collect()} == want
    import subsight.llm.collocations as module
    for name in ("CHUNK_BYTES", "HELD_WORDS", "BUFFER"):
        monkeypatch.setattr(module, name, 5)
    assert [w for part in _tokens(b"a b. C d" * 20) for w in part] == b"".join([b"a b. C d" * 20]).lower().replace(b".", b" . ").split()


def test_edge_rows(spark, edge_documents, documents):
    rows = rows_of(edge_documents)
    assert {tuple(r) for r in collocations(edge_documents).collect()} == brute(rows)
    assert collocations(documents([])).collect() == []


@pytest.mark.parametrize("bits,wide", [(1, False), (7, False), (21, False), (22, True), (64, True)])
@pytest.mark.parametrize("quotient_bits", [0, 3])
def test_filter_counts_losslessly(bits, wide, quotient_bits):
    """Ids come back from the keys, and merged shards count as one counter does, counters of many digits included."""
    layout = Layout(bits, quotient_bits)
    assert (layout.lanes == 3) == wide
    g = np.random.default_rng(bits)
    some = g.integers(0, min(2**bits, 2**63) - 1, (60, 3), dtype=np.uint64, endpoint=True)
    assert (layout.invert(layout.permute(some)) == some).all()
    shards, counter = [], Counter()
    for s in range(3):
        held = Filter(layout, capacity=40)
        for _ in range(4):
            ids = some[g.integers(0, 60, 500 if s else 40_000)]
            counter.update(map(tuple, ids.tolist()))
            shards += [held.add(ids)]
        shards.append(held.take())
    rows = sorted((r for b in shards if b for r in b.to_pylist()), key=lambda r: r["quotient"] & (2**64 - 1))
    batches = [pa.RecordBatch.from_pylist(rows[i:i + 2], pa.schema([("quotient", pa.int64()), ("slots", pa.binary())])) for i in range(0, len(rows), 2)]
    got = {}
    for ids, counts in merged(iter(batches), layout, 100):
        for key, n in zip(map(tuple, ids.tolist()), counts.tolist()):
            assert key not in got
            got[key] = n
    assert got == {k: n for k, n in counter.items() if n >= 100}


def test_stream_of_ids_counts_each_ngram_once():
    ids = np.array([1, 2, 0, 3, 4, 5, 0, 0, 6], np.uint64)
    whole = Counter(map(tuple, _ngrams(ids, 0).tolist()))
    assert whole == Counter([(1, 2, 0), (3, 4, 0), (4, 5, 0), (3, 4, 5)])
    parts = Counter(map(tuple, _ngrams(ids[:5], 0).tolist())) + Counter(map(tuple, _ngrams(ids[3:], 2).tolist()))
    assert parts == whole


def test_slots_are_compact():
    assert Layout(18, 12).slot_bytes == 7 and Layout(64, 12).slot_bytes == 24
    assert quotient.CAPACITY * Layout(64, 0).slot_bytes < 64 << 20
