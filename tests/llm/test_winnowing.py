import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from subsight.llm import winnowing as W
from subsight.llm.textbytes import word_runs

from .conftest import EDGE_ROWS, LONG

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, items, n=10):
    wins = {}
    for item, t in items:
        ws = words(t)
        k = min(n, len(ws))
        for i in range(len(ws) - k + 1 if ws else 0):
            wins.setdefault(tuple(ws[i:i + k]), set()).add(item)
    out = []
    for i, t, _, _ in rows:
        ws, hit, found = words(t), set(), set()
        for k in {len(w) for w in wins}:
            for a in range(len(ws) - k + 1):
                if tuple(ws[a:a + k]) in wins:
                    hit |= set(range(a, a + k))
                    found |= {str(x) for x in wins[tuple(ws[a:a + k])] if x is not None}
        out.append((i, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **kw):
    bench = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, fp string")
    return sorted(map(tuple, W.contamination(docs, bench, **kw).drop("text_key").collect()), key=repr)


def test_word_hashes_are_those_of_the_words():
    texts = ["Straße straße STRASSE", None, "", "a-b_c É9", "tail", "word word"] * 3
    got = {}
    for i, j, w in word_runs(pa.array(texts)):
        for t in range(i, j):
            a, z = w.first[t - i], w.first[t - i + 1]
            assert [w.text(k, k + 1) for k in range(a, z)] == words(texts[t])
            for k in range(a, z):
                got.setdefault(w.text(k, k + 1), set()).add(int(w.hashes[k]))
    assert all(len(h) == 1 for h in got.values()) and len({h for s in got.values() for h in s}) == len(got)


def test_chunks_and_slices_do_not_change_words(monkeypatch):
    from subsight.llm import textbytes

    r = random.Random(1)
    texts = ["".join(r.choice("ab é.\n9") for _ in range(r.randint(0, 60))) for _ in range(200)]
    monkeypatch.setattr(textbytes, "CHUNK_BYTES", 50)
    column = pa.array(["skipped", *texts]).slice(1)
    got = [w.text(k, k + 1) for _, _, w in word_runs(column) for k in range(len(w.starts))]
    assert got == [x for t in texts for x in words(t)]


def test_equal_windows_have_equal_fingerprints():
    r = np.random.default_rng(3)
    h = r.integers(0, 2**63, 60).astype(np.uint64)
    other = np.concatenate([r.integers(0, 2**63, 9).astype(np.uint64), h[20:30], r.integers(0, 2**63, 9).astype(np.uint64)])
    assert W.window_prints(other, 10, 5)[9] == W.window_prints(h, 10, 5)[20]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, documents, seed):
    """Few different words, so spans overlap, repeat and belong to many items; items of all lengths."""
    r = random.Random(seed)
    text = lambda n: " ".join(r.choice(["a", "B", "c,", "é", "--"]) for _ in range(n))
    items = [(i, text(r.randint(0, 25))) for i in range(12)] + [(50, None), (51, "..."), (None, text(12)), (3, text(11)), (90, "a a")]
    rows = []
    for i in range(40):
        t = text(r.randint(0, 40))
        if i % 3 == 0:
            t += " x9 " + r.choice(items[:12])[1] + " y8 " + text(5)
        rows.append((i, t, "en", "s"))
    rows += [rows[3], (4, "another " + text(20), "en", "s")]
    assert run(spark, documents(rows), items) == brute(rows, items)


def test_other_lengths(spark, documents):
    r = random.Random(9)
    text = lambda n: " ".join(r.choice("abcd") for _ in range(n))
    items = [(i, text(r.randint(1, 9))) for i in range(6)]
    rows = [(i, text(30), "en", "s") for i in range(20)]
    assert run(spark, documents(rows), items, words=6, gram=3) == brute(rows, items, 6)


def test_edges(spark, edge_documents):
    items = [(1, "two rows of the table"), (2, None), (3, ""), (4, "word " * 10), (10, "has its say"), (9, "its say")]
    got = run(spark, edge_documents, items)
    assert got == brute(EDGE_ROWS, items)
    assert (5, 120_001, 120_000, 1, hashlib.sha256(b"4").hexdigest(), True) in got and len(words(LONG)) == 120_001


def test_empty_tables(spark, documents, edge_documents):
    assert run(spark, documents([]), [(1, "a b")]) == []
    got = run(spark, edge_documents, [])
    assert got == brute(EDGE_ROWS, []) and not any(r[5] for r in got)


def test_a_full_filter_only_lets_more_through(spark, documents, monkeypatch):
    monkeypatch.setattr(W, "FILTER_BITS", (6, 6))
    r = random.Random(4)
    text = lambda n: " ".join(r.choice("abcdefgh") for _ in range(n))
    items = [(i, text(40)) for i in range(10)]
    rows = [(i, text(20) + " " + items[i % 10][1][:40], "en", "s") for i in range(15)]
    assert run(spark, documents(rows), items) == brute(rows, items)
