import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from subsight.llm import chat as C

piece = st.sampled_from([*C.CONTROL, "\\", "<", "[", "/", "s", ">", "\n", "a", "|", "<\\", "\\|end|>", "é"])
texts = st.lists(piece, max_size=10).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts, texts)
def test_escape_round_trip(role, text):
    safe = C.escape(text)
    assert C.unescape(safe) == text and not any(c in safe for c in C.CONTROL)
    turn, head = C.format_turn(role, text)
    assert turn[head:len(turn) - len(C.CLOSE)] == safe
    assert [t[:2] for t in C.read_turns(turn * 2)] == [(role, text)] * 2


SCHEMA = "conv_id long, turn long, role string, text string, tokens string, formatted string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def check(spark, rows, **kw):
    df = frame(spark, rows)
    windows = C.format_windows(df, **kw)
    got = {r.conv_id: r for r in C.read_back(windows).collect()}
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    return windows.collect(), by


@pytest.mark.parametrize("budget, history", [(40, 0), (60, 20), (120, 1000), (1, 0), (10**6, 50)])
def test_windows(spark, budget, history):
    r = random.Random(budget)
    rows = []
    for c in range(12):
        n = r.randint(1, 25)
        for t in range(n):
            role = "system" if t == 0 and c % 2 else r.choice(["user", "assistant", "assistant", "tool"])
            rows.append((c, t, role, " ".join(r.choice(["hello", "<|end|>", "[INST]", "x" * 30]) for _ in range(r.randint(0, 12)))))
    windows, by = check(spark, rows, budget=budget, history=history)
    for w in windows:
        turns = [t[:2] for t in C.read_turns(w.formatted)]
        assert w.turns >= 1 and len(turns) == w.repeated + w.turns
        assert w.tokens <= budget or w.turns == 1                        # only a turn that does not fit goes over
        spans = list(zip(w.loss_starts, w.loss_ends))
        assert [C.unescape(w.formatted[a:z]) for a, z in spans] == [t for role, t in turns[w.repeated:] if role == "assistant"]
        opening = by[w.conv_id][0]
        if opening[0] == "system":
            assert turns[0] == opening                                   # the system turn stays
    for c in by:
        mine = sorted((w for w in windows if w.conv_id == c), key=lambda w: w.window)
        assert [w.window for w in mine] == list(range(len(mine))) and mine[0].repeated == 0
    if history == 1000:
        assert any(w.repeated > 1 for w in windows)


def test_prefix_sums_fill_the_budget(spark):
    """Greedy: the next window's first turn would not have fitted."""
    rows = [(1, t, "user", "word " * 7) for t in range(40)]
    windows, _ = check(spark, rows, budget=100, history=0)
    each = windows[0].tokens // windows[0].turns
    assert all(w.turns == 100 // each for w in windows[:-1])


def test_edges(spark):
    rows = [(None, 0, "user", "no conversation id"), (None, 1, "assistant", None), (1, None, "user", "no turn"), (1, 0, None, "no role"),
            (1, 0, "assistant", ""), (1, 0, "assistant", "tie b"), (1, 0, "assistant", "tie a"), (2, 0, "user", "same"), (2, 0, "user", "same"),
            (3, 5, "sys\ntem\\n", "odd role"), (4, 0, "assistant", "long " * 120_000), (5, 0, "user", None),
            (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    check(spark, rows)
    assert C.format_windows(frame(spark, [])).count() == 0 and C.read_back(C.format_windows(frame(spark, []))).count() == 0


def test_order_of_rows_does_not_matter(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t} " * 9) for c in range(5) for t in range(30)]
    one = C.format_windows(frame(spark, rows), budget=200).collect()
    two = C.format_windows(frame(spark, rows[::-1]).repartition(7), budget=200).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_one_long_conversation_streams(spark, monkeypatch):
    monkeypatch.setattr(C, "_HAND_ON", 1000)
    rows = [(9, t, ["user", "assistant"][t % 2], f"turn {t} says " + "w " * (t % 13)) for t in range(3000)]
    windows, _ = check(spark, rows, budget=300, history=60)
    assert len(windows) > 50
