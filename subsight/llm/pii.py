"""Personal data: base patterns, and spans added by a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsight.llm.pii_rows import ROWS

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Words at each side of a word with a digit or @ that its segment takes in.
CONTEXT = 2
#: Shapes and scores of longer words are not remembered.
LONG_WORD = 80
#: Segments are decoded together once they hold so many words.
BATCH_WORDS = 1 << 14

# The base patterns are fixed values; lookbehind and possessive marks change no match, only the time of failing.
_AFTER_AT = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Characters of addresses beyond the base pattern: any letter, digit or mark, but not those of scripts written without
# spaces, which only count in a word that has no address without them.
_MARKS = "".join(c for c in map(chr, range(0x300, 0x3100)) if unicodedata.category(c)[0] == "M") + "\u200c\u200d"
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ud7ff\uf900-\ufaff\uff66-\uffdc\U00020000-\U0003ffff"


def _address(without: str) -> re.Pattern:
    letter = f"(?:[A-Za-z0-9]|(?![\x00-\x7f{without}])[\\w{_MARKS}])"
    return re.compile(f"(?<![._%+-])(?<!{letter})(?:{letter}|[._%+-])++@(?:{letter}|-)++(?:\\.(?:{letter}|-)++)+")


_ADDRESSES = (_address(_UNSPACED), _address(""))
_NAMED = re.compile(r"[^@]@[^@.][^@]*\.[^@.]")  #: of shapes: something at a dotted domain
_TRIGGER = re.compile(r"[0-9@]")
_SPACE = frozenset("\x20\t\n\x0b\x0c\r")
_EDGES = re.compile(r"[0-9A-Za-z+(].*[0-9A-Za-z]", re.S)

Span = tuple[int, int, int]  #: start, number of the kind, end


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: Sequence[int]) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def valid(kind: str, text: str) -> bool:
    """The check each kind must pass, base match or added span."""
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)
    if kind == "card":
        d = _digits(text)
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _AFTER_AT.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that pass their check, by start, then kind."""
    out = [(a, 0, z) for a, z in _emails(text)]
    if _TRIGGER.search(text):
        for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
            out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if valid(KINDS[k], m.group())]
    return sorted(out)


def _shape(word: str) -> tuple[str, str, str]:
    """The shapes of a whole word, remembered if it is short."""
    return _outline(word) if len(word) > LONG_WORD else _remembered(word)


def _outline(word: str) -> tuple[str, str, str]:
    """Detailed shape (run lengths to 4, then by range), plain shape, and range of the digit count."""
    detailed, plain = [], []
    for run in re.finditer(r"[0-9]+|[^\W\d_]+|[\s\S]", word):
        s, n = run.group(), run.end() - run.start()
        kind = "9" if s[0].isdigit() and s.isascii() else "a" if s[0].isalpha() else s
        detailed.append(kind * n if kind == "9" and n <= 4 else kind + ("*" if n <= 11 else "+" if n <= 19 else "#") if kind == "9" else kind)
        plain.append(kind)
    n = sum("0" <= c <= "9" for c in word)
    return "".join(detailed), "".join(plain), "0" if n == 0 else str(n) if n <= 4 else "5-8" if n <= 8 else "9-11" if n <= 11 else "12-15" if n <= 15 else "16-19" if n <= 19 else "20"


#: Bounded: a worker that reads ever new numbers and ids keeps no more than so many of their shapes.
_remembered = lru_cache(1 << 16)(_outline)


def _own(word: str) -> list[str]:
    detailed, plain, count = _shape(word)
    bare = plain.strip(".,;:!?")
    return ["d " + detailed.rstrip(".,;:!?"), "p " + plain, "b " + bare, "n " + count, "f " + plain[:1], "@ " + str("@" in plain), "e " + str(_NAMED.search(plain) is not None)]


class Field:
    """A linear-chain conditional random field over the words of a segment.

    A word's score is that of its own features and of its neighbours'
    shapes; transitions that leave the label scheme are forbidden.
    """

    def __init__(self) -> None:
        self.features: dict[str, int] = {}
        k = len(LABELS)
        self.blocked = np.array([[b[0] == "I" and a[1:] != b[1:] for b in LABELS] for a in LABELS])
        self.not_first = np.array([b[0] == "I" for b in LABELS])
        self.weights = np.zeros((0, k))
        self.moves = np.zeros((k, k))
        self.start = np.zeros(k)
        self.known: dict[tuple[str, str], np.ndarray] = {}

    def ids(self, words: Sequence[str], grow: bool = False) -> list[list[int]]:
        out = []
        for i, w in enumerate(words):
            names = _own(w)
            names.append("l " + (_shape(words[i - 1])[1] if i else "^"))
            names.append("r " + (_shape(words[i + 1])[1] if i + 1 < len(words) else "$"))
            out.append([self.features.setdefault(f, len(self.features)) if grow else self.features.get(f, -1) for f in names])
        return out

    def _part(self, kind: str, word: str) -> np.ndarray:
        """The score a word adds as itself ("o"), as left ("l") or right ("r") neighbour, remembered by shape."""
        detailed, plain, count = _shape(word) if word else ("", "^" if kind == "l" else "$", "")
        key = (kind, f"{detailed} {count}" if kind == "o" else plain)
        if key not in self.known:
            names = _own(word) if kind == "o" else [f"{kind} {plain}"]
            part = self.weights[[self.features[f] for f in names if f in self.features]].sum(axis=0)
            if len(word) > LONG_WORD:
                return part
            if len(self.known) > 1 << 16:
                self.known.clear()
            self.known[key] = part
        return self.known[key]

    def scores(self, words: Sequence[str]) -> np.ndarray:
        last = len(words) - 1
        return np.array([self._part("o", w) + self._part("l", words[i - 1] if i else "") + self._part("r", words[i + 1] if i < last else "")
                         for i, w in enumerate(words)])

    def decode(self, segments: Sequence[Sequence[str]]) -> list[np.ndarray]:
        """Best label path of each segment: Viterbi over padded batches of similar length."""
        out: list = [None] * len(segments)
        order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
        moves = np.where(self.blocked, -1e9, self.moves)
        first = np.where(self.not_first, -1e9, self.start)
        at = 0
        while at < len(order):
            size = len(segments[order[at]])
            end = at
            while end < len(order) and len(segments[order[end]]) <= size + size // 4 and (end - at + 1) * len(segments[order[end]]) <= 4 * BATCH_WORDS + size:
                end += 1
            batch = order[at:end]
            lengths = np.array([len(segments[i]) for i in batch])
            steps = int(lengths.max())
            x = np.zeros((len(batch), steps, len(LABELS)))
            for r, i in enumerate(batch):
                x[r, :lengths[r]] = self.scores(segments[i])
            back = np.zeros((len(batch), steps, len(LABELS)), np.int8)
            score = first + x[:, 0]
            for t in range(1, steps):
                options = score[:, :, None] + moves
                back[:, t] = options.argmax(axis=1)
                new = options.max(axis=1) + x[:, t]
                score = np.where((t < lengths)[:, None], new, score)
            label = score.argmax(axis=1)
            paths = np.zeros((len(batch), steps), np.int8)
            rows = np.arange(len(batch))
            for t in range(steps - 1, -1, -1):
                paths[:, t] = label
                label = np.where(t < lengths, back[rows, t, label], label) if t else label
            for r, i in enumerate(batch):
                out[i] = paths[r, :lengths[r]]
            at = end
        return out

    def fit(self, segments: Sequence[Sequence[str]], gold: Sequence[Sequence[int]], rounds: int = 250, rate: float = 0.15,
            ridge: float = 0.02) -> Field:
        """Maximum penalised likelihood: forward and backward sums over the padded table, Adam steps."""
        ids = [self.ids(s, grow=True) for s in segments]
        n, steps, k, f = len(ids), max(map(len, ids)), len(LABELS), len(self.features)
        width = len(ids[0][0])
        feats = np.full((n, steps, width), f)
        y = np.zeros((n, steps), int)
        mask = np.zeros((n, steps), bool)
        for r, (s, g) in enumerate(zip(ids, gold)):
            feats[r, :len(s)], y[r, :len(s)], mask[r, :len(s)] = s, g, True
        params = [np.zeros((f + 1, k)), np.zeros((k, k)), np.zeros(k)]
        one, rows = np.eye(k), np.arange(n)
        lengths = mask.sum(axis=1)
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        blocked, not_first = np.where(self.blocked, -1e9, 0), np.where(self.not_first, -1e9, 0)

        def logsum(a: np.ndarray, axis: int) -> np.ndarray:
            top = a.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        for step in range(1, rounds + 1):
            w, m, s = params[0], params[1] + blocked, params[2] + not_first
            x = w[feats].sum(axis=2)
            fwd, bwd = np.zeros((n, steps, k)), np.zeros((n, steps, k))
            fwd[:, 0] = s + x[:, 0]
            for t in range(1, steps):
                fwd[:, t] = np.where(mask[:, t, None], logsum(fwd[:, t - 1, :, None] + m, 1) + x[:, t], fwd[:, t - 1])
            for t in range(steps - 2, -1, -1):
                bwd[:, t] = np.where(mask[:, t + 1, None], logsum(m + (x[:, t + 1] + bwd[:, t + 1])[:, None, :], 2), 0)
            z = logsum(fwd[rows, lengths - 1], 1)
            node = np.exp(fwd + bwd - z[:, None, None]) * mask[..., None]
            diff = node - one[y] * mask[..., None]
            g_w = np.zeros_like(w)
            np.add.at(g_w, feats.reshape(n * steps, width), np.repeat(diff.reshape(n * steps, 1, k), width, axis=1))
            g_w[f] = 0
            g_m = np.zeros_like(m)
            for t in range(1, steps):
                pair = np.exp(fwd[:, t - 1, :, None] + m + (x[:, t] + bwd[:, t])[:, None, :] - z[:, None, None])
                seen = one[y[:, t - 1]][:, :, None] * one[y[:, t]][:, None, :]
                g_m += ((pair - seen) * mask[:, t, None, None]).sum(axis=0)
            grads = [g_w + ridge * w, np.where(self.blocked, 0, g_m) + ridge * params[1], np.where(self.not_first, 0, diff[:, 0].sum(axis=0)) + ridge * params[2]]
            for p, g, (a, b) in zip(params, grads, state):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        self.weights, self.moves, self.start = params[0][:f], params[1], params[2]
        return self


def labelled(rows: str = ROWS) -> tuple[list[list[str]], list[list[int]]]:
    """Words and label numbers of the marked rows."""
    segments, gold = [], []
    for row in rows.strip().splitlines():
        words, labels = [], []
        for part in re.finditer(r"([^\s\[]*)\[(\w+)\|([^\]]+)\](\S*)|\S+", row):
            if part.group(2):  # what touches a mark, a second mark too, is of the same words
                inside = (part.group(1) + part.group(3) + re.sub(r"\[\w+\|([^\]]+)\]", r"\1", part.group(4))).split()
                labels += [LABELS.index(("I-" if i else "B-") + part.group(2)) for i in range(len(inside))]
            else:
                inside = [part.group()]
                labels.append(0)
            words += inside
        segments.append(words)
        gold.append(labels)
    return segments, gold


@cache
def trained() -> Field:
    """The field of the labelled table; fitted once per process, the same weights each time."""
    return Field().fit(*labelled())


def segments_of(text: str) -> list[list[tuple[int, int]]]:
    """Word spans in runs: every word with a digit or @, and ``CONTEXT`` words at each side; runs that touch are one."""
    out: list[list[tuple[int, int]]] = []
    end = len(text)
    covered = 0  # words that begin before are in a run

    def word_before(at: int) -> tuple[int, int] | None:
        while at > covered and text[at - 1] in _SPACE:
            at -= 1
        z = at
        while at > covered and text[at - 1] not in _SPACE:
            at -= 1
        return (at, z) if at < z else None

    def word_after(at: int) -> tuple[int, int] | None:
        while at < end and text[at] in _SPACE:
            at += 1
        z = at
        while z < end and text[z] not in _SPACE:
            z += 1
        return (at, z) if at < z else None

    m = _TRIGGER.search(text)
    while m:
        a = z = m.start()
        while a > covered and text[a - 1] not in _SPACE:
            a -= 1
        while z < end and text[z] not in _SPACE:
            z += 1
        run, left = [(a, z)], []
        at = a
        for _ in range(CONTEXT):
            if (w := word_before(at)) is None:
                break
            left.append(w)
            at = w[0]
        gap = covered
        while gap < at and text[gap] in _SPACE:
            gap += 1
        touching = bool(out) and gap == at
        run = left[::-1] + run
        quiet, at = 0, z
        while quiet < CONTEXT and (w := word_after(at)):
            run.append(w)
            at = w[1]
            quiet = 0 if _TRIGGER.search(text, w[0], w[1]) else quiet + 1
        if touching:
            out[-1] += run
        else:
            out.append(run)
        covered = at
        m = _TRIGGER.search(text, at)
    return out


def _wider_emails(text: str, start: int, end: int) -> list[Span]:
    """Addresses in the word from ``start`` to ``end`` with characters outside the base pattern, which cuts or misses them."""
    word = text[start:end]
    if "@" not in word or word.isascii():
        return []
    found = next((f for p in _ADDRESSES if (f := [m.span() for m in p.finditer(word)])), [])
    return [(start + a, 0, start + z) for a, z in found if not word[a:z].isascii()]


def _covered(base: Sequence[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of what sorted spans cover, in order and apart."""
    starts: list[int] = []
    ends: list[int] = []
    for a, _, z in base:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], z)
        else:
            starts.append(a)
            ends.append(z)
    return starts, ends


def _added(text: str, run: Sequence[tuple[int, int]], path: np.ndarray, covered: tuple[list[int], list[int]]) -> list[Span]:
    """Spans of a decoded run that pass their kind's check and overlap nothing ``covered``, and wider addresses, which may."""
    out, i = [], 0
    starts, ends = covered
    while i < len(run):
        label = LABELS[path[i]]
        if label == "O":
            i += 1
            continue
        j = i + 1
        while j < len(run) and LABELS[path[j]] == "I" + label[1:]:
            j += 1
        m = _EDGES.search(text, run[i][0], run[j - 1][1])
        kind = label[2:]
        if kind == "email":  # the base has what its pattern accepts; what it cuts or misses is added beside it
            out.extend(s for a, z in run[i:j] for s in _wider_emails(text, a, z))
        elif m and valid(kind, m.group()):
            k = bisect_right(ends, m.start())  # the first that ends behind the span's start
            if k == len(starts) or starts[k] >= m.end():
                out.append((m.start(), KINDS.index(kind), m.end()))
        i = j
    return out


def find_spans(texts: Sequence[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and all spans, of each whole text; segments of many texts are decoded together."""
    out: list[tuple[list[Span], list[Span]]] = []
    waiting: list[tuple[int, list[tuple[int, int]]]] = []
    size = 0

    def settle() -> None:
        paths = field.decode([[texts[i][a:z] for a, z in run] for i, run in waiting])
        covered: dict[int, tuple[list[int], list[int]]] = {}
        for (i, run), path in zip(waiting, paths):
            if path.any():
                if i not in covered:
                    covered[i] = _covered(out[i][0])
                out[i][1].extend(_added(texts[i], run, path, covered[i]))
        for i in covered:
            out[i][1].sort()
        waiting.clear()

    for i, text in enumerate(texts):
        base = base_spans(text) if text else []
        out.append((base, list(base)))
        for run in segments_of(text) if text else []:
            waiting.append((i, run))
            size += len(run)
        if size >= BATCH_WORDS:
            settle()
            size = 0
    settle()
    return out


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def redacted(text: str | None, spans: Sequence[Span]) -> str | None:
    """``text`` with each run of overlapping spans replaced by the first one's kind, like ``<EMAIL>``."""
    if not spans:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for a, k, z in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], z)
        else:
            merged.append([a, k, z])
    for a, k, z in merged:
        out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = z
    return "".join(out) + text[at:]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)``, one row per row of ``docs``.

    The counts and the digest are those of the base patterns; ``spans`` has
    the base spans and those the field adds: what the patterns lose to each
    other, and, beside the cut base match if there is one, the whole of an
    address beyond the base pattern in a word that the field decodes as
    email. Positions are code points, end exclusive, ordered by start, then
    kind, then end. Null counts as empty text, with
    no spans. Very long texts are read whole, in time linear in their length
    and spans. Repeated rows keep a row each; an empty table gives none;
    other columns are not read.
    """
    field = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = find_spans(b.column(1).to_pylist(), field)
            counts = [[sum(k == n for _, k, _ in base) for base, _ in found] for n in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]),
                 pa.array([written(spans) for _, spans in found], pa.string()),
                 pa.array([len(spans) - len(base) for base, spans in found], pa.int64())],
                ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
                               "n_added long").withColumnRenamed("id", id_col)


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text column replaced by its kind; other columns and null texts as they are."""
    field, at = trained(), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            clean = [redacted(t, spans) for t, (_, spans) in zip(texts, find_spans(texts, field))]
            columns = [pa.array(clean, b.schema.field(at).type) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return docs.mapInArrow(run, docs.schema)
