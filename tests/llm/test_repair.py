"""Conversation repair against a brute-force search over all edit sequences."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from subsight.llm.queries import op11_repair
from subsight.llm.repair import END, cost_before, damaged, digests, matrix, repair, walk

from .conftest import CLASHING, N_CLASHING, SMALL

GRAMMAR = {"": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else "fine")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Dijkstra over (cost, audit): the cheapest edits, of those the least audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i > len(rows):
            return cost, audit, out
        moves = []
        if i == len(rows):
            if state in ("", "A"):
                heapq.heappush(heap, (cost, audit, i + 1, state, out))
        else:
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] in ("fine", "cut"):
                stay = faults[i] == "cut"
                moves = [(stay, "K", role, text, 1)] + [(2 + stay, "R", r, text, 1) for r in ("user", "assistant")]
        for price, letter, role, text, step in moves + [(2, "I", r, "", 0) for r in ("user", "assistant")]:
            if role[:1] in GRAMMAR[state]:
                heapq.heappush(heap, (cost + price, audit + letter, i + step, GRAMMAR[state][role[:1]], out + ((role, text),)))
    raise AssertionError


def brute(rows):
    """The result row of one conversation, rows in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    faults = faults_of(rows)
    cost, audit, out = cheapest(rows, faults)
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("cut"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        shown = [" " if v is None else v for v in (conv, turn, role, text)]
        fault = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = ("user" if fault == 4 else shown[2]), shown[3]
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out[conv] += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {conv: in_order(found) for conv, found in out.items()}


def frame(spark, rows, extra=False):
    schema = "conv_id long, turn long, role string, text string"
    if not extra:
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame([(*r, *["x"] * N_CLASHING) for r in rows], f"{schema}, {CLASHING}")


def results(df, **options):
    done = repair(df, **options)
    hashes = {r[0]: r[1] for r in digests(done.rows).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv_id, nothing))
            for r in done.audits.collect()}


def random_rows(seed, conversations, longest):
    r = random.Random(seed)
    texts = ["Yes.", "no", " ", "", "Why? ", "same text!", "ends in a dot.\n"] + [f"text {i}." for i in range(9)]
    return [(c, None if r.random() < 0.05 else t, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sys", "a"]), r.choice(texts))
            for c in range(conversations) for t in range(r.randint(1, longest))]


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_equals_brute_force(spark, bits):
    """With strings of 2 and 4 rows every conversation crosses borders: vectors go back and states forward."""
    rows = random_rows(bits, 40, 14)
    want = {}
    for row in rows:
        want.setdefault(row[0], []).append(row)
    want = {c: brute(in_order(found)) for c, found in want.items()}
    assert results(frame(spark, rows), block_bits=bits) == want


def test_checkpoints_equal_the_whole_table():
    """The walk from checkpoints finds the cost that the backward vectors give, from every state, for many lengths."""
    r = random.Random(5)
    letters = [chr(97 + 4 * kind + fault) for kind in range(4) for fault in range(4)]
    for n in (*range(1, 30), 400):
        s = "".join(r.choice(letters) for _ in range(n))
        vectors = cost_before(s, END)
        table = matrix(s)
        assert tuple(min(table[to][q] + END[to] for to in range(4)) for q in range(4)) == vectors
        k = r.randint(0, n)
        middle = cost_before(s[k:], END)
        for q in range(4):
            first, state = walk(s[:k], middle, q)
            second, _ = walk(s[k:], END, state)
            assert first + second == walk(s, END, q)[0]


def test_edge_rows(spark):
    """Null ids, turns, roles and texts, empty and long texts, repeated rows, columns of clashing names."""
    long = "word " * 100_000 + "end."
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (1, None, None, None), (1, None, None, None), (2, 0, "user", long),
            (2, 0, "user", long), (2, 1, "assistant", long), (3, 0, "", ""), (4, 5, "system", "Be kind."), (4, 9, "user", "naïve \U0001f600?"),
            (5, 0, "user", "a.\x85"), (6, 1, "assistant", "Only this.")]
    given = frame(spark, rows, extra=True)
    shown = [tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in rows]
    want = {}
    for row in shown:
        want.setdefault(row[0], []).append(row)
    assert results(given) == {c: brute(in_order(found)) for c, found in want.items()}
    assert results(frame(spark, [])) == {}


def test_damage(spark):
    rows = random_rows(9, 60, 9) + [(None, None, None, None), (None, 3, "user", "x"), (70, None, "user", "y?")]
    got = damaged(frame(spark, rows))
    kept = [(r.conv_id, r.turn, r.role, r.text) for r in got.where("copy is not null").collect()]
    want = [row for found in damage(rows).values() for row in found]
    key = lambda r: tuple((v is None, v or 0) if i < 2 else v for i, v in enumerate(r))
    assert sorted(kept, key=key) == sorted(want, key=key)


def test_query_equals_brute_force(spark):
    got = {r[0]: tuple(r)[1:] for r in op11_repair(spark, SMALL).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == {c: brute(found) for c, found in damage(rows).items()}


def test_one_long_conversation_is_split(spark):
    """A conversation of 20,000 rows: no string has more rows than a block, and the cost is that of one pass."""
    df = spark.range(20_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 7 < 3, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"))
    done = repair(df, block_bits=8)
    audit = done.audits.first()
    s = "".join(chr(97 + 4 * (1 if i % 7 < 3 else 2)) for i in range(20_000))
    assert audit.cost == cost_before(s, END)[0]
    assert done.rows.groupBy("conv_id", "block").count().agg(F.max("count")).first()[0] <= 2 * 256
