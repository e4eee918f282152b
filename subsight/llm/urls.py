"""URL judgement: host and path rules first, then a weighted vocabulary counted by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One hit rejects.
STRICT = ("adult-x", "spam-farm", "porn", "porno", "xxx", "hentai", "escort", "escorts", "camgirl", "camgirls",
          "phishing", "malware", "warez", "keygen", "viagra", "cialis")
#: So many distinct hits reject.
SOFT = ("adult", "sex", "sexy", "nude", "naked", "dating", "hookup", "casino", "poker", "betting", "bet", "bets",
        "slots", "jackpot", "lottery", "win", "free", "ads", "track", "loan", "loans", "payday", "pills", "pharmacy", "crack", "cracked", "torrent",
        "torrents", "spam", "farm", "clickbait", "cheap", "replica", "bitcoin", "giveaway")
SOFT_DISTINCT = 2
#: (host, path start, verdict), fixed values: the longest fitting rule decides.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

#: A vocabulary table may hold so many characters of terms: it is read to the driver and sent to every task.
VOCABULARY_CHARS = 8_000_000


def vocabulary_from(terms: DataFrame, term_col: str = "term", weight_col: str = "weight",
                    max_chars: int = VOCABULARY_CHARS) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Strict and soft terms, for ``judge_urls``, from a table with a term and its weight (``strict`` or ``soft``) per row.

    Terms are trimmed and A-Z lower-cased; nulls and empty terms are
    skipped, repeated ones count once, a term with both weights is strict.
    An empty table gives no terms. Another weight, or more than
    ``max_chars`` characters of terms, measured before anything is read to
    the driver, is an error.
    """
    weight = F.lower(F.trim(F.col(weight_col).cast("string")))
    term = F.translate(F.trim(F.col(term_col).cast("string")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = terms.select(term.alias("term"), weight.alias("weight")).where("term <> ''").groupBy("term") \
        .agg(F.max((F.col("weight") == "strict").cast("int")).alias("strict"),
             F.count_if(~F.coalesce(F.col("weight").isin("strict", "soft"), F.lit(False))).alias("other"))
    chars, other = rows.agg(F.coalesce(F.sum(F.length("term")), F.lit(0)), F.coalesce(F.sum("other"), F.lit(0))).first()
    if other:
        raise ValueError(f"{other} terms have a weight that is neither strict nor soft")
    if chars > max_chars:
        raise ValueError(f"the vocabulary has {chars} characters, over {max_chars}")
    got = [(r["term"], r["strict"]) for r in rows.select("term", "strict").collect()]
    return tuple(sorted(t for t, strict in got if strict)), tuple(sorted(t for t, strict in got if not strict))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (host or a subdomain of it, path start) as text, and its verdict; else nulls.

    Of several of equal length the first of ``rules`` decides.
    """
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


@cache
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for weight, terms in (("soft", soft), ("strict", strict)):  # a term in both is strict
        for t in terms:
            a.add_word(t, (t, weight))
    a.make_automaton()
    return a


def _word(c: str) -> bool:
    return c.isascii() and c.isalnum()


def vocabulary_hits(url: str | None, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> tuple[list[str], list[str]]:
    """Distinct strict and soft terms of ``url``, A-Z lower-cased, that stand between characters other than letters and digits."""
    return _hits(url, _automaton(strict, soft)) if strict or soft else ([], [])


def _hits(url: str | None, automaton: ahocorasick.Automaton) -> tuple[list[str], list[str]]:
    text = (url or "").encode("utf-8", "replace").lower().decode("utf-8", "replace")
    found = {"strict": set(), "soft": set()}
    for end, (term, weight) in automaton.iter(text):
        start = end - len(term)
        if (start < 0 or not _word(text[start])) and (end + 1 == len(text) or not _word(text[end + 1])):
            found[weight].add(term)
    return sorted(found["strict"]), sorted(found["soft"])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, strict: Sequence[str] = STRICT,
               soft: Sequence[str] = SOFT, soft_distinct: int = SOFT_DISTINCT, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``(id_col, host, path, rule, verdict, n_strict, n_soft)``, one row per row of ``pages``.

    The longest fitting rule decides, of equally long ones the first given;
    where none fits, the vocabulary does:
    block on one strict term or ``soft_distinct`` distinct soft terms, allow
    otherwise. A term counts only between characters that are no ASCII
    letters or digits. Null, empty and scheme-less urls have empty host and
    path, so only the vocabulary judges them, and null is allowed. Very long
    urls are read whole, in time linear in their length. Rows that
    repeat keep a row each; an empty table gives none; other columns are not
    read. The vocabulary travels with the code, so its size is that of the
    parameters.
    """
    strict_terms, soft_terms = tuple(sorted(set(strict))), tuple(sorted(set(soft)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(strict_terms, soft_terms) if strict_terms or soft_terms else None
        for b in batches:
            hits = [_hits(u.as_py(), automaton) if automaton else ([], []) for u in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s, _ in hits], pa.int32()), pa.array([len(s) for _, s in hits], pa.int32())],
                ["id", "url", "n_strict", "n_soft"])

    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"))
    counted = src.mapInArrow(run, "id long, url string, n_strict int, n_soft int") \
        .select("id", "n_strict", "n_soft", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("n_strict") >= 1) | (F.col("n_soft") >= soft_distinct), "block").otherwise("allow")
    return counted.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
                          F.coalesce(verdict, own).alias("verdict"), "n_strict", "n_soft")
