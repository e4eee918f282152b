"""Exact token counts of a byte-level BPE vocabulary with a whole-token shortcut."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: The byte-level pre-tokenizer's pattern, a fixed value of the library.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Merged pieces kept per worker; a full memory is emptied, which changes speed only.
MEMORY = 1 << 20
#: Pieces of more characters are not kept in the memory.
LONG_PIECE = 64


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Counter:
    """Counts tokens of texts as the library does for the vocabulary file at ``path``.

    ``single`` holds the vocabulary strings proven to encode alone as one
    token: each is encoded by the library's own model, without splitting,
    and kept if that gives one token. A pre-token in it counts one; every
    other pre-token is merged by the library's model and remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre != pre | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        if any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("added tokens with strip or word rules are not supported")
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = byte_letters()
        added = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(sorted(added, key=len, reverse=True))) if added else None
        back = {c: b for b, c in enumerate(self.letters)}
        self.single = {}
        for word in spec["model"]["vocab"]:
            if all(c in back for c in word):
                try:
                    text = bytes(back[c] for c in word).decode("utf-8")
                except UnicodeDecodeError:
                    continue  # part of a character: no pre-token
                if len(self.model.tokenize(word)) == 1:
                    self.single[text] = 1
        self.merged: dict[str, int] = {}

    def merge(self, piece: str) -> int:
        letters = self.letters
        n = len(self.model.tokenize("".join([letters[b] for b in piece.encode("utf-8")])))
        if len(piece) <= LONG_PIECE:
            if len(self.merged) >= MEMORY:
                self.merged.clear()
            self.merged[piece] = n
        return n

    def plain(self, text: str) -> int:
        single, merged, merge = self.single, self.merged, self.merge
        total = 0
        for piece in PIECES.findall(text):
            if piece in single:
                total += 1
            else:
                n = merged.get(piece)
                total += merge(piece) if n is None else n
        return total

    def __call__(self, text: str | None) -> int:
        """Tokens of ``text``, without added begin or end tokens; a special string inside is one token."""
        if not text:
            return 0
        if self.special is None:
            return self.plain(text)
        total = at = 0
        for m in self.special.finditer(text):
            total += self.plain(text[at:m.start()]) + 1
            at = m.end()
        return total + self.plain(text[at:] if at else text)


@cache
def counter(path: str) -> Counter:
    """One counter per worker and file."""
    return Counter(path)


@lru_cache
def named(name: str) -> Counter:
    return counter(public_path(name))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    ``vocabulary`` is the name of a byte-level BPE file among the installed
    public tokenizers, or a path that every worker can open. Whole texts of
    any length; null is the empty text with 0 bytes and tokens; a text of
    exactly ``limit`` tokens is not over it. Repeated rows keep a row each, an
    empty table gives none; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary) if "/" in vocabulary else named(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([count(t.as_py()) for t in b.column(2)], pa.int64())],
                ["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return src.mapInArrow(run, "id long, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
