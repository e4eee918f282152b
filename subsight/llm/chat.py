"""Chat formatting in budgeted, turn-aligned windows with a loss mask, and reading the result back."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsight.llm.tokens import VOCABULARY, counter, named

BUDGET = 1024
#: Tokens of earlier turns that a window may repeat before its own.
HISTORY = 256
#: Tokens counted for the marks of a turn.
OVERHEAD = 6
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: Strings that a text must not bring into the output as they are: this template's and those of common others.
CONTROL = ("<|turn|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
           "<<SYS>>", "<</SYS>>")
_ESCAPE = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(f"{re.escape(c[0])}\\\\+{re.escape(c[1:])}" for c in CONTROL))


def escape(text: str) -> str:
    """``text`` with one backslash more after the first character of every control string, escaped before or not."""
    return _ESCAPE.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0] + m.group()[2:], text)


def _role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The turn in the template, and where its text begins."""
    head = f"{OPEN}{_role(role)}\n"
    return f"{head}{escape(text)}{CLOSE}", len(head)


def read_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """``(role, text, start, end)`` of each turn of a formatted window; the positions are those of the escaped text."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(CLOSE, line + 1)
        out.append((_unrole(formatted[at + len(OPEN):line]), unescape(formatted[line + 1:end]), line + 1, end))
        at = end + len(CLOSE)
    return out


class _Windows:
    """Windows of one conversation, fed turn by turn; holds one window and the history it may repeat."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple[str, str, int] | None = None
        self.recent: deque = deque()
        self.recent_tokens = 0
        self.number = 0
        self._begin()

    def _begin(self) -> None:
        self.parts: list[tuple[str, str]] = []
        self.fresh = 0
        self.repeated = 0
        self.spent = 0
        if self.number:
            if self.system:
                self._put(self.system)
            for turn in self.recent:
                self._put(turn)
            self.repeated = len(self.parts)

    def _put(self, turn: tuple[str, str, int]) -> None:
        self.parts.append(turn[:2])
        self.spent += turn[2]

    def add(self, role: str, text: str, tokens: int, before: int) -> dict | None:
        """Takes the next turn; the finished window if it did not fit. ``before`` is the prefix sum of tokens up to it."""
        turn = (role, text, tokens)
        done = None
        # With the prefix sums the fresh part of the window ends where they pass what the repeated part leaves.
        if self.fresh and before + tokens - self.base > self.budget - self.fixed:
            done = self.finish()
            self.number += 1
            self._begin()
            # What is repeated must leave room for the turn itself; the oldest history goes first.
            while self.repeated > (1 if self.system else 0) and self.spent + tokens > self.budget:
                at = 1 if self.system else 0
                self.parts.pop(at)
                self.repeated -= 1
                self.spent -= self.recent[0][2]
                self.recent_tokens -= self.recent.popleft()[2]
        if not self.fresh:
            self.base, self.fixed = before, self.spent
        self._put(turn)
        self.fresh += 1
        if role == "system" and self.system is None and self.number == 0 and self.fresh == 1:
            self.system = turn
        else:
            self.recent.append(turn)
            self.recent_tokens += tokens
            while self.recent and self.recent_tokens > self.history:
                self.recent_tokens -= self.recent.popleft()[2]
        return done

    def finish(self) -> dict:
        pieces, starts, ends, at = [], [], [], 0
        for k, (role, text) in enumerate(self.parts):
            piece, head = format_turn(role, text)
            if role == "assistant" and k >= self.repeated:
                starts.append(at + head)
                ends.append(at + len(piece) - len(CLOSE))
            pieces.append(piece)
            at += len(piece)
        return {"window": self.number, "formatted": "".join(pieces), "repeated": self.repeated, "turns": self.fresh,
                "tokens": self.spent, "loss_starts": starts, "loss_ends": ends}


_OUT = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("formatted", pa.string()), ("repeated", pa.int32()),
                  ("turns", pa.int32()), ("tokens", pa.int64()), ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64()))])
_DDL = ("conv_id long, window int, formatted string, repeated int, turns int, tokens long, loss_starts array<long>, "
        "loss_ends array<long>")
#: Windows are handed on once their texts reach so many characters.
_HAND_ON = 1 << 22


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Formatted windows of all conversations: ``conv_id, window, formatted, repeated, turns, tokens, loss_starts, loss_ends``.

    Rows are ordered by turn, then role, text (ties do not depend on the
    input's order; equal rows are turns of their own). Prefix sums of the
    turns' tokens choose the windows: each takes whole turns, as many as fit
    ``budget`` beside what it repeats, and at least one, so a turn longer
    than the budget is a window over it, whole. A conversation's opening
    system turn is retained in every window; up to ``history`` tokens of the
    turns before are repeated where they leave room. The loss spans (code
    points of ``formatted``) cover the texts of assistant turns that are not
    ``repeated``, so each counts once.

    Null text or role is empty; a null turn comes first; null ``conv_id`` is
    a conversation of its own. Empty input gives empty output; other columns
    are not read. A task streams its sorted rows and holds one window, so a
    conversation of any length takes bounded memory.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary) if "/" in vocabulary else named(vocabulary)
        for b in batches:
            n = [tokens(r.as_py()) + tokens(t.as_py()) + OVERHEAD for r, t in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], [*b.schema.names, "tokens"])

    src = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                               F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                               F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = src.mapInArrow(count, "conv_id long, turn long, role string, text string, tokens long")
    mine = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.sum("tokens").over(mine.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    summed = counted.withColumn("before", before).withColumn("place", F.row_number().over(mine)) \
        .sortWithinPartitions("conv_id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Windows | None = None
        conv, rows, size = None, [], 0
        for b in batches:
            for c, role, text, n, before in zip(*(b.column(i) for i in range(5))):
                c = c.as_py()
                if current is None or c != conv:
                    if current:
                        rows.append({"conv_id": conv, **current.finish()})
                    current, conv = _Windows(budget, history), c
                done = current.add(role.as_py(), text.as_py(), n.as_py(), before.as_py())
                if done:
                    rows.append({"conv_id": conv, **done})
                    size += len(done["formatted"])
                if size >= _HAND_ON:
                    yield pa.RecordBatch.from_pylist(rows, _OUT)
                    rows, size = [], 0
        if current:
            rows.append({"conv_id": conv, **current.finish()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _OUT)

    return summed.select("conv_id", "role", "text", "tokens", "before").mapInArrow(run, _DDL)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of the conversations as read from formatted windows.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_windows``: the repeated turns of a window are passed
    over, the loss is what the spans cover, unescaped. Windows are dealt by
    conversation, sorted, and digested as a stream.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])

        def end() -> None:
            turns, n, loss, chars, total, count = state
            out.append({"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                        "loss_sha256": loss.hexdigest(), "formatted_chars": total, "n_windows": count})

        for b in batches:
            for c, formatted, repeated, starts, ends in zip(*(b.column(i) for i in range(5))):
                c, formatted = c.as_py(), formatted.as_py()
                if state is None or c != conv:
                    if state:
                        end()
                    conv, state = c, [hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for role, text, _, _ in read_turns(formatted)[repeated.as_py():]:
                    state[0].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    state[1] += 1
                for a, z in zip(starts.as_py(), ends.as_py()):
                    text = unescape(formatted[a:z])
                    state[2].update(text.encode("utf-8", "surrogatepass"))
                    state[3] += len(text)
                state[4] += len(formatted)
                state[5] += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if state:
            end()
            yield pa.RecordBatch.from_pylist(out, schema)

    dealt = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return dealt.select("conv_id", "formatted", "repeated", "loss_starts", "loss_ends").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
