import random
import re

import pytest

from subsight.llm import urls as U


def rule_by_hand(host, path):
    best = None
    for h, p, v in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, None)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate({c: c + 32 for c in range(65, 91)}), re.match(r"[^?#]*", rest[len(host):]).group()


def hits(url, terms):
    low = (url or "").translate({c: c + 32 for c in range(65, 91)})
    return sum(bool(re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low)) for t in terms)


def expected(url):
    host, path = parts(url)
    rule, verdict = rule_by_hand(host, path)
    strict, soft = hits(url, set(U.STRICT)), hits(url, set(U.SOFT) - set(U.STRICT))
    return host, path, rule, verdict or ("block" if strict or soft >= U.SOFT_DISTINCT else "allow"), strict, soft


URLS = [None, "", "no scheme", "http://", "://x", "http://EXAMPLE.com/en/a", "http://www.example.com/en/", "http://example.com",
        "https://a.b.net/es/x?q#f", "https://net/fr/", "http://notnet/fr/", "http://x.net/en/?next=/es/", "http://a.org/xxx",
        "http://a.org/xxxl", "http://casino-bet.org", "http://casino.org/casino", "http://a.org/adult-x-y", "http://a.org\n/porn",
        "http://a.org/PORN", "ftp://h?x=://other/y", "http://ünï.org/sex/é-casino", "http://xn.org/" + "a/" * 5000 + "porn",
        "http://cheap-pills.org", "http://blog.cheap.org/pills", "http://example.com/EN/"]


def test_equals_brute_force(spark):
    r = random.Random(1)
    pieces = [*U.STRICT, *U.SOFT, "-", "/", ".", "net", "com", "example", "a", "9", "?", "#", "es", "fr", "É", "://"]
    urls = URLS + ["http://" + "".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(400)]
    rows = [(i, u, "h", "x") for i, u in enumerate(urls)] + [(None, "http://a.org/xxx", None, None)]
    got = sorted(map(tuple, U.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()), key=repr)
    assert got == sorted(((i, *expected(u)) for i, u, _, _ in rows), key=repr)


def test_sql_agrees(spark):
    import duckdb
    import pandas as pd

    from subsight.llm.urls_sql import VERDICTS

    con = duckdb.connect()
    con.register("pages", pd.DataFrame({"page_id": range(len(URLS)), "url": URLS}))
    cur = con.execute(VERDICTS)
    names = [d[0] for d in cur.description]
    got = {r[names.index("page_id")]: tuple(r[names.index(n)] for n in ("host", "path", "rule", "verdict", "n_strict", "n_soft"))
           for r in cur.fetchall()}
    assert got == {i: expected(u) for i, u in enumerate(URLS)}


def test_own_vocabulary_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.org/one-two"), (2, "http://a.org/bad")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge_urls(df, rules=(), strict=["bad"], soft=["one", "two", "bad"]).collect()}
    assert got == {1: "block", 2: "block"}
    assert {r.verdict for r in U.judge_urls(df, rules=(), strict=[], soft=[]).collect()} == {"allow"}
    assert U.judge_urls(df.limit(0)).count() == 0


def test_rules_of_equal_length(spark):
    """The first given decides, as in the SQL."""
    rules = [("b.org", "/", "block"), ("org", "/xy", "allow"), ("org", "/xyz", "block"), ("b.org", "/x", "allow")]
    urls = ["http://b.org/xy", "http://b.org/xyz", "http://a.b.org/a", "http://c.org/xyz"]
    got = U.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=rules).collect()
    assert [(r.rule, r.verdict) for r in sorted(got)] == [("b.org/x", "allow"), ("org/xyz", "block"), ("b.org/", "block"), ("org/xyz", "block")]
    tied = spark.createDataFrame([(1, "http://b.org/x")], "page_id long, url string")
    for first, second in (("allow", "block"), ("block", "allow")):
        got = U.judge_urls(tied, rules=[("b.org", "/", first), ("b.org", "/", second), ("org", "/", second)]).first()
        assert (got.rule, got.verdict) == ("b.org/", first)


def test_vocabulary_from_a_table(spark):
    rows = [(" Bad-Word ", "STRICT", 1), ("one", "soft", 2), ("one", "soft", 3), ("two", "soft", 4), ("two", "strict", 5),
            (None, "soft", 6), ("", None, 7), ("É", "soft", 8)]
    table = spark.createDataFrame(rows, "term string, weight string, url long")
    strict, soft = U.vocabulary_from(table)
    assert (strict, soft) == (("bad-word", "two"), ("one", "É"))
    urls = spark.createDataFrame([(1, "http://a.org/BAD-word"), (2, "http://a.org/one"), (3, "http://a.org/one/two"), (4, None)],
                                 "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge_urls(urls, rules=(), strict=strict, soft=soft).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow"}
    assert U.vocabulary_from(table.limit(0)) == ((), ())
    with pytest.raises(ValueError, match="neither"):
        U.vocabulary_from(spark.createDataFrame([("a", "hard"), ("b", None)], "term string, weight string"))
    with pytest.raises(ValueError, match="characters"):
        U.vocabulary_from(table, max_chars=10)


def test_a_long_vocabulary_equals_brute_force(spark):
    r = random.Random(4)
    terms = sorted({"".join(r.choice("abc-") for _ in range(r.randint(1, 6))) for _ in range(1500)})
    strict, soft = U.vocabulary_from(spark.createDataFrame([(t, "strict" if i % 9 == 0 else "soft") for i, t in enumerate(terms)],
                                                           "term string, weight string"))
    assert len(strict) + len(soft) == len(terms)
    urls = ["http://" + "".join(r.choice("abc-/.") for _ in range(30)) for _ in range(60)]
    got = U.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=(), strict=strict, soft=soft)
    assert {r.page_id: (r.n_strict, r.n_soft) for r in got.collect()} == {i: (hits(u, strict), hits(u, soft)) for i, u in enumerate(urls)}
