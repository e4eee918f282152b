"""Repair of conversation structure: least-cost edits by a square-root checkpointed dynamic programme.

A conversation is right if its role initials read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turn. Rows are reduced to
one symbol each (role initial and first fault), the symbols of up to
``BLOCK`` rows in order to one string. A string's backward state-cost vectors
are kept at every square root of its length only; walking forward, the block
between two checkpoints is recomputed and the ASCII-least edit among the
tight ones is taken. A conversation of several strings hands a vector back
and a state forward between them, so no task holds a whole conversation.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.llm.tables import stored

#: White space of the contract.
BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: log2 of the rows in a string.
BLOCK_BITS = 12
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: State after a system, user, assistant or other initial that is kept; None: not allowed there.
_KEEP = ((_SYSTEM, _USER, None, None), (None, _USER, None, None), (None, None, _ASSISTANT, None), (None, _USER, None, None))
#: State after an inserted or re-roled row, and its letter: u/U user, a/A assistant (lower case: inserted).
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_PUT = "uuau"
_INF = math.inf

# A row's symbol is chr(97 + 4 * initial + fault).
INITIALS = "sua"
FINE, BLANK, DUPLICATE, CUT = range(4)


def _inserted(v: tuple) -> tuple:
    """Vector ``v`` where rows may be inserted first. An insertion never pays twice in a circle."""
    user = min(v[_USER], INSERT + v[_ASSISTANT])
    return (min(v[_START], INSERT + user), min(v[_SYSTEM], INSERT + user), user, min(v[_ASSISTANT], INSERT + v[_USER]))


#: Cost to go after the last row.
END = _inserted((0, _INF, _INF, 0))


def _row_edits(symbol: str, after: tuple, state: int) -> list[tuple[float, str, str, int]]:
    """``(cost, initial, letter, next state)`` of the edits that take the row in ``state``."""
    initial, fault = divmod(ord(symbol) - 97, 4)
    out = [(DELETE + after[state], "D", "D", state)]
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        kept = _KEEP[state][initial]
        if kept is not None:
            out.append((extra + after[kept], "K", "K", kept))
        out.append((REROLE + extra + after[_NEXT[state]], "R", _PUT[state].upper(), _NEXT[state]))
    return out


@lru_cache(1 << 16)
def _shifted_back(symbol: str, after: tuple) -> tuple:
    return _inserted(tuple(min(e[0] for e in _row_edits(symbol, after, q)) for q in range(4)))


def _back(symbol: str, after: tuple) -> tuple:
    """The vector before a row. Vectors are few up to a constant, so steps are remembered."""
    base = min(after)
    if not base or base == _INF:
        return _shifted_back(symbol, after)
    return tuple(c + base for c in _shifted_back(symbol, tuple(c - base for c in after)))


@lru_cache(1 << 16)
def _shifted_step(symbol: str, after: tuple, state: int) -> tuple[str, int]:
    letters = ""
    while True:
        edits = _row_edits(symbol, after, state)
        row = [(min(e[0] for e in _row_edits(symbol, after, q))) for q in range(4)]
        best = _inserted(tuple(row))
        tight = [(e[1], e[2], e[3]) for e in edits if e[0] == best[state]]
        if INSERT + best[_NEXT[state]] == best[state]:
            tight.append(("I", _PUT[state], _NEXT[state]))
        initial, letter, state = min(tight)
        letters += letter
        if initial != "I":
            return letters, state


def _step(symbol: str, after: tuple, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits in ``state`` up to and with the one that takes the row; the state after it."""
    base = min(after)
    return _shifted_step(symbol, tuple(c - base for c in after) if base and base != _INF else after, state)


def cost_before(symbols: str, after: tuple) -> tuple:
    """The vector before ``symbols``, holding one vector at a time."""
    for s in reversed(symbols):
        after = _back(s, after)
    return after


def matrix(symbols: str) -> list[tuple]:
    """Least costs from each state before (index of the inner tuples) to each state after (of the list)."""
    return [cost_before(symbols, tuple(0 if q == to else _INF for q in range(4))) for to in range(4)]


def walk(symbols: str, after: tuple, state: int) -> tuple[list[str], int]:
    """Letters of each row and the state after ``symbols``, from checkpoints a square root of their number apart."""
    n = len(symbols)
    gap = max(1, math.isqrt(n))
    marks = {}
    v = after
    for i in range(n - 1, -1, -1):
        if (i + 1) % gap == 0 or i == n - 1:
            marks[i + 1] = v
        v = _back(symbols[i], v)
    out = []
    for a in range(0, n, gap):
        z = min(a + gap, n)
        vectors = [marks[z]]
        for i in range(z - 1, a, -1):
            vectors.append(_back(symbols[i], vectors[-1]))
        for i in range(a, z):
            letters, state = _step(symbols[i], vectors.pop(), state)
            out.append(letters)
    return out, state


def tail(state: int) -> str:
    """Rows inserted after the last one."""
    out = ""
    while state in (_SYSTEM, _USER):
        out += _PUT[state]
        state = _NEXT[state]
    return out


def illegal_pairs(symbols: str) -> int:
    """Neighbours whose initials are not su, ua or au."""
    kinds = [(ord(s) - 97) // 4 for s in symbols]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(kinds, kinds[1:]))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy`` after the contract's damage, and a row without ``copy`` for each one dropped.

    The fault is crc32 of ``conv_id:turn`` modulo 20. Null role or text, and
    a null in the hashed key, are one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    copies = F.when(fault == 0, F.array(F.lit(None).cast("int"))).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _in_order(rows: DataFrame) -> DataFrame:
    """Narrow rows with ``place``, a number in the order of conversation, turn, role and text.

    Range partitions split a conversation, a turn and even equal rows (by
    their key) over several tasks, so none is held by one.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "key"]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(laid.withColumn("place", F.monotonically_increasing_id()), "places")


def _symbols(laid: DataFrame) -> DataFrame:
    """Rows with their symbol. A row is a duplicate if the first row of its text and role is another one.

    The first places are found by a map-side combined minimum and met again
    on the place, which is unique, so a text that a third of the rows have
    is no hot key.
    """
    rest = laid.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min("place").alias("first_place"))
    first = rest.select("first_place")
    marked = laid.join(first, laid.place == first.first_place, "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first_place").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    return marked.withColumn("symbol", F.char(F.lit(97) + _initial(F.col("role")) * 4 + fault))


_EDITED = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("ops", pa.string()), ("audit", pa.string()), ("cost", pa.int64()),
                     ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
                     ("first", pa.string()), ("last", pa.string())])
_EDITED_DDL = ("conv_id long, block long, ops string, audit string, cost long, blank long, duplicate long, truncated long, "
               "illegal long, first string, last string")
_PRICE = {"K": 0, "D": DELETE, "U": REROLE, "A": REROLE, "u": INSERT, "a": INSERT}
_INITIAL = str.maketrans("uaUA", "IIRR")
#: Strings handed on at once.
_HAND_ON = 256


def _edited_string(symbols: str, after: tuple, state: int, ends: bool) -> dict:
    ops, state = walk(symbols, after, state)
    faults = [(ord(s) - 97) % 4 for s in symbols]
    put = tail(state) if ends else ""
    cost = sum(_PRICE[c] for letters in ops for c in letters) + sum(_PRICE[c] for c in put)
    cost += TRUNCATED * sum(f == CUT and o[-1] != "D" for f, o in zip(faults, ops))
    return {"ops": ",".join([*ops, put]), "audit": ("".join(ops) + put).translate(_INITIAL), "cost": cost,
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
            "illegal": illegal_pairs(symbols), "first": symbols[0], "last": symbols[-1]}


def _edited(strings: DataFrame) -> DataFrame:
    """Edits of strings with their ``after`` vector, start ``state`` and whether they end the conversation (``ends``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, _HAND_ON):
                yield pa.RecordBatch.from_pylist([
                    {"conv_id": r["conv_id"], "block": r["block"],
                     **_edited_string(r["symbols"], tuple(r["after"]), r["state"], r["ends"])}
                    for r in b.slice(at, _HAND_ON).to_pylist()], _EDITED)

    return strings.select("conv_id", "block", "symbols", "after", "state", "ends").mapInArrow(run, _EDITED_DDL)


def _matrices(strings: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            costs = [[c for column in matrix(s.as_py()) for c in column] for s in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(costs, pa.list_(pa.float64()))], ["conv_id", "block", "costs"])

    return strings.select("conv_id", "block", "symbols").mapInArrow(run, "conv_id long, block long, costs array<double>")


def _scanned(blocks: DataFrame, forward: bool, step, value: str, ddl: str) -> DataFrame:
    """A value handed from string to string of each conversation, ``(conv_id, block, <value>, ends)``; a task streams and holds one value."""
    kind = pa.list_(pa.float64()) if ddl.startswith("array") else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, held = False, None, None
        for b in batches:
            values, ends = [], []
            for c, given in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                ends.append(not begun or c != conv)
                if ends[-1]:
                    begun, conv, held = True, c, None
                before, held = step(given, held)
                values.append(before)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(values, kind), pa.array(ends)], ["conv_id", "block", value, "ends"])

    order = ["conv_id", "block" if forward else F.col("block").desc()]
    return blocks.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, f"conv_id long, block long, {value} {ddl}, ends boolean")


def _vector_step(costs: list, after) -> tuple[list, tuple]:
    after = END if after is None else after
    before = tuple(min(costs[4 * to + q] + after[to] for to in range(4)) for q in range(4))
    return list(after), before


def _state_step(ends_in: list, state) -> tuple[int, int]:
    state = _START if state is None else state
    return state, int(ends_in[state])


def _walked_maps(strings: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = [[float(walk(s.as_py(), tuple(v.as_py()), q)[1]) for q in range(4)] for s, v in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(maps, pa.list_(pa.float64()))], ["conv_id", "block", "maps"])

    return strings.select("conv_id", "block", "symbols", "after").mapInArrow(run, "conv_id long, block long, maps array<double>")


def edit_strings(rows: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Strings of rows ``conv_id, place, key, symbol`` with their edits: ``conv_id, block, keys, ops, audit, cost, ...``.

    ``ops`` are, comma-joined, the letters of each row of ``keys``: those
    inserted before it (u, a), then K, D, U or A (re-roled); last those
    inserted at the conversation's end. Conversations within one string are
    edited at once; those that cross a string's border, one a string at most,
    need the vectors and states at its borders first.
    """
    block = F.shiftright("place", block_bits)
    strings = rows.groupBy("conv_id", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", "key", "symbol"))).alias("r")) \
        .select("conv_id", "block", F.col("r.key").alias("keys"), F.array_join("r.symbol", "").alias("symbols"))
    strings = stored(strings, "strings")
    per = strings.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    many = stored(per.where("n > 1").select(F.col("conv_id").alias("of")), "crossing")
    whole = strings.join(many, strings.conv_id.eqNullSafe(many.of), "left_anti") \
        .select("*", F.array(*[F.lit(float(c)) for c in END]).alias("after"), F.lit(_START).alias("state"), F.lit(True).alias("ends"))
    parts = stored(strings.join(many, strings.conv_id.eqNullSafe(many.of), "left_semi"), "parts")
    same = lambda a, b: a.conv_id.eqNullSafe(b.conv_id) & (a.block == b.block)
    vectors = _scanned(_matrices(parts), False, _vector_step, "after", "array<double>")
    with_after = stored(parts.join(vectors, same(parts, vectors)).select(parts["*"], "after", "ends"), "vectors")
    states = _scanned(_walked_maps(with_after), True, _state_step, "state", "int").drop("ends")
    known = with_after.join(states, same(with_after, states)).select(with_after["*"], "state")
    columns = ["conv_id", "block", "symbols", "after", "state", "ends"]
    edits = stored(_edited(whole.select(*columns)).unionByName(_edited(known.select(*columns))), "edits")
    return edits.join(strings, same(edits, strings)).select(edits["*"], "keys")


def _repaired(edits: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows that stay, with their texts, and those inserted."""
    per_row = edits.select("conv_id", "block", F.posexplode(F.arrays_zip(
        F.concat("keys", F.array(F.lit(None).cast("long"))).alias("key"), F.split("ops", ",").alias("letters")))) \
        .select("conv_id", "block", F.col("pos").alias("row"), "col.key", "col.letters")
    single = per_row.select("conv_id", "block", "row", "key", F.posexplode(F.split("letters", ""))).where("col not in ('', 'D')") \
        .select("conv_id", "block", "row", F.col("pos").alias("sub"), "key", F.col("col").alias("edit"))
    put = single.where("edit in ('u', 'a')").select(
        "conv_id", "block", "row", "sub", "edit", F.when(F.col("edit") == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text"))
    of = single.where("edit not in ('u', 'a')").select("block", "row", "sub", "edit", F.col("key").alias("of"))
    kept = texts.join(of, texts.key == of.of).select(
        "conv_id", "block", "row", "sub", "edit",
        F.when(F.col("edit") == "U", "user").when(F.col("edit") == "A", "assistant").otherwise(F.col("role")).alias("role"), "text")
    return kept.unionByName(put)


@dataclass
class Repair:
    """``audits``: per conversation ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``; ``rows``: the
    repaired conversations, ``conv_id, block, row, sub`` (their order), ``edit, role, text``."""

    audits: DataFrame
    rows: DataFrame


def _audits(edits: DataFrame, rows: DataFrame) -> DataFrame:
    """Per conversation, from its strings in order and its rows."""
    named = ["audit", "cost", "blank", "duplicate", "truncated", "illegal", "first", "last"]
    per = edits.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", *named))).alias("b"))
    kind = lambda s: F.floor((F.ascii(s) - 97) / 4)
    legal = lambda a, b: F.concat(kind(a).cast("string"), kind(b).cast("string")).isin("01", "12", "21")
    borders = F.zip_with(F.slice("b", 1, F.size("b") - 1), F.slice("b", 2, F.size("b")),
                         lambda x, y: F.when(legal(x.getField("last"), y.getField("first")), 0).otherwise(1).cast("long"))
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)
    found = per.select("conv_id", *[total(F.col(f"b.{c}")).alias(c) for c in ("blank", "duplicate", "truncated")],
                       (total(F.col("b.illegal")) + total(borders)).alias("illegal"), total(F.col("b.cost")).alias("cost"),
                       F.array_join("b.audit", "").alias("audit"))
    turns = rows.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id") \
        .agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")).withColumnRenamed("conv_id", "of")
    return found.join(turns, found.conv_id.eqNullSafe(turns.of), "left").drop("of") \
        .withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def repair(conversations: DataFrame, block_bits: int = BLOCK_BITS) -> Repair:
    """Repairs the structure of ``conversations(conv_id, turn, role, text)``; see :class:`Repair`.

    Rows are taken by turn, nulls first, ties by role and text; equal rows
    are rows of their own (the later ones duplicates). Null role or text is
    one space, so a null text is blank and a null role fits nowhere. A null
    ``conv_id`` is a conversation of its own. Texts are whole and of any
    length: they are reduced to faults and a digest where they lie and
    shuffled once, to meet their edits. Conversations may be of any length:
    a task holds ``2^block_bits`` symbols, and streams a vector a string.
    Empty input gives empty results; other columns are not read.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    texts = stored(conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"), space("text").alias("text")).withColumn("key", F.monotonically_increasing_id()), "turns")
    bare = F.rtrim("text", F.lit(BLANKS))
    narrow = texts.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), "key", (bare == "").alias("blank"),
                          (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    rows = stored(_symbols(_in_order(narrow)), "symbols")
    edits = stored(edit_strings(rows, block_bits), "keyed")
    return Repair(_audits(edits, rows), _repaired(edits, texts))


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: the rows of a conversation, in order, streamed into one digest."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, state = False, None, None
        for b in batches:
            out = []
            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if not begun or c != conv:
                    if begun:
                        out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    begun, conv, state = True, c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if begun:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "row", "sub")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")
