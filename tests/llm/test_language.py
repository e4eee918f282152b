import numpy as np
import pytest
from pyspark.sql import functions as F

from subsight.llm import language as L
from subsight.llm.kneser_ney import train
from subsight.llm.wordscores import Memory, owners, spelled, words_of

from .conftest import EDGE_ROWS


def model(words, classes=("x", "y"), order=4, shared=0):
    names = sorted(words)
    codes, place, starts = spelled(names)
    return train(codes, place, owners(starts, len(codes)), np.array([words[w] for w in names], float), list(classes), order, shared)


WORDS = {"banana": (5, 0), "bandana": (2, 1), "cabana": (1, 1), "dog": (0, 4), "dodo": (0, 3), "b": (1, 0)}


@pytest.mark.parametrize("shared", [0, 1, 2])
def test_probabilities_sum_to_one(shared):
    """After any context, over all symbols seen and one for the unseen."""
    m = model(WORDS, shared=shared)
    symbols = sorted({c for w in WORDS for c in w}) + ["\x03"]
    for context in ("", "b", "ba", "ban", "d", "do", "zz"):
        rows = []
        for s in symbols + ["一"]:
            text = "\x02" + context + s
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
            rows.append(np.exp(m.score(codes, np.arange(len(codes)))[-1]))
        total = np.sum(rows, axis=0)
        assert np.allclose(total, 1, atol=1e-3), (context, total)


def test_bigrams_by_hand():
    """Interpolated Kneser-Ney of order two against the formula."""
    words = {"ab": (2,), "ac": (1,), "bb": (1,)}
    m = model(words, ("x",), 2)
    seq = [("^" + w + "$", n) for w, (n,) in words.items()]
    raw = {}
    for s, n in seq:
        for a, b in zip(s, s[1:]):
            raw[a, b] = raw.get((a, b), 0) + n
    cont = {}
    for _, b in raw:
        cont[b] = cont.get(b, 0) + 1
    disc = lambda c: (sum(x == 1 for x in c) / (sum(x == 1 for x in c) + 2 * sum(x == 2 for x in c))
                      if 1 in c and 2 in c else 0.5)
    d1, d2 = disc(list(cont.values())), disc(list(raw.values()))
    n1 = sum(cont.values())
    uni = lambda b: max(cont.get(b, 0) - d1, 0) / n1 + d1 * len(cont) / n1 / (len(cont) + 1)

    def p(a, b):
        total = sum(n for (x, _), n in raw.items() if x == a)
        kinds = sum(x == a for x, _ in raw)
        return max(raw.get((a, b), 0) - d2, 0) / total + d2 * kinds / total * uni(b)

    for text in ("ab", "ac", "cb", "ba"):
        codes, place, _ = spelled([text])
        got = np.exp(m.score(codes, place)[1:, 0])
        marked = "^" + text + "$"
        want = [p(a, b) if any(x == a for x, _ in raw) else uni(b) for a, b in zip(marked, marked[1:])]
        assert np.allclose(got, want, rtol=1e-4), text


def test_memory_is_only_speed(monkeypatch):
    from subsight.llm import wordscores

    m = model(WORDS)
    who = L.Identifier(m, np.array([9.0, 9.0]), 6.0)
    texts = ["banana dog " * 50, "dodo", None, "", "bandana b cabana unheard " * 20]
    whole = who.judge(texts, Memory(m))
    monkeypatch.setattr(wordscores, "MEMORY_WORDS", 1)
    tiny = Memory(m)
    assert [who.judge([t], tiny) for t in texts] == [([a], [b], [c], [d]) for a, b, c, d in zip(*whole)]


def test_words():
    assert words_of("Über-Fluss 9x_y ² 漢字") == ["über", "fluss", "x", "y", "²", "漢字"]
    assert words_of("² ½ 9 _") == [] == words_of(None) == words_of("")


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from subsight.llm.queries import learned_identifier, op1_language

    got = op1_language(spark, "/root/testdata/sf0.01").toPandas()
    truth = docs.select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(got) == docs.count() and len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98
    assert got.rejected.mean() < 0.005                                   # documents of the languages stay
    learned = learned_identifier(docs)
    noise = ["xqzvkj wqxzjk vvqkxj zzxqj kqxwv " * 20, "Ђурђевак живи тамо где река тече " * 10, "12345 !!"]
    assert learned.judge(noise, Memory(learned.model))[3] == [True, True, True]


def test_edges(spark, documents, edge_documents):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(
        [("the cat sat on the mat and the dog ran", "en"), ("der hund und die katze sind im haus", "de")] * 20)]
    learned = L.fit_identifier(documents(rows, extra=False).selectExpr("lang AS cls", "text"))
    assert sorted(learned.model.classes) == ["de", "en"]
    out = L.identify(edge_documents, learned, [edge_documents.doc_id]).collect()
    assert len(out) == len(EDGE_ROWS)
    for (_, text, _, _), r in zip(EDGE_ROWS, out):
        if not words_of(text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("de", "en") and 0 <= r.score <= 1
    kept = L.keep_identified(edge_documents, learned)
    assert kept.columns == edge_documents.columns and kept.count() == sum(not r.rejected for r in out)
    assert L.identify(documents([]), learned, []).count() == 0


def test_nothing_learned(spark, documents):
    empty = L.fit_identifier(documents([(1, None, "en", "s"), (2, "no language", None, "s")]).selectExpr("lang AS cls", "text"))
    got = L.identify(documents([(1, "text", "en", "s")]), empty, []).collect()
    assert [tuple(r) for r in got] == [("und", 0.0, None, True)]
    one = L.fit_identifier(documents([(i, "only one language here", "en", "s") for i in range(30)]).selectExpr("lang AS cls", "text"))
    assert L.identify(documents([(1, "one language", "en", "s")]), one, []).first().lang_pred == "en"


def test_sample_is_bounded_and_even(documents):
    rows = [(i, f"text number {i} " * 20, "en" if i % 10 else "de", "s") for i in range(2000)]
    sample = L.learning_sample(documents(rows).selectExpr("lang AS cls", "text"), sample_chars=40_000).toPandas()
    size = sample.assign(n=sample.text.str.len()).groupby("cls").n.sum()
    assert 25_000 < size["en"] < 55_000 and 25_000 < size["de"] < 55_000 and 0.1 < sample.held.mean() < 0.3


def test_no_text_is_shuffled_for_the_sample(documents):
    plan = L.learning_sample(documents([(1, "a", "en", "s")]).selectExpr("lang AS cls", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_class_without_words_to_learn_from_changes_no_other(spark, monkeypatch):
    """One language's only text is held, one has no letters; the others learn from and are calibrated on other rows."""
    from subsight.llm import toxicity as X

    rows = [("en", f"the cat sat on the mat number {w}", w == "seven") for w in ("one", "two", "three", "seven")]
    rows += [("de", f"der hund ist im haus {w}", w == "sieben") for w in ("eins", "zwei", "drei", "sieben")]
    rows += [("fr", "le chat est sur la table", True), ("und", "12 34", False), ("und", "", True)]
    sample = spark.createDataFrame(rows, "cls string, text string, held boolean")
    counts, late = L.learning_counts(sample)
    words = {(r["cls"], r["word"]) for r in counts.to_pylist()}
    assert late == ["fr"] and {c for c, _ in words} == {"de", "en", "fr"} and ("fr", "chat") in words
    assert ("en", "one") in words and ("en", "seven") not in words and ("de", "sieben") not in words
    monkeypatch.setattr(L, "learning_sample", lambda *a, **k: sample)
    learned = L.fit_identifier(sample)
    assert learned.model.classes == ["de", "en", "fr"] and np.isfinite(learned.limits).tolist() == [True, True, False]
    # toxicity: a class that has learned from its held rows calibrates no weights
    few = spark.createDataFrame([("0", "fine words", False), ("0", "other fine words", True), ("1", "grobian", True)], sample.schema)
    monkeypatch.setattr(X, "learning_sample", lambda *a, **k: few)
    assert X.fit_scorer(few).weights.tolist() == [4.0] + [0.0] * X.Scorer.FEATURES


def test_long_texts_are_learned_from(spark, documents):
    """A language of one long text, and a budget below any text: each language has a model and a bounded sample."""
    rows = [(i, f"text number {i} of the language " * 5, "en", "s") for i in range(300)]
    rows += [(1000, " ".join(f"langer satz mit wort{i} darin" for i in range(10_000)), "de", "s")]
    frame = documents(rows).selectExpr("lang AS cls", "text")
    sample = L.learning_sample(frame, sample_chars=60_000, piece_chars=2000).toPandas()
    size = sample.assign(n=sample.text.str.len()).groupby("cls").n.agg(["sum", "max"])
    assert 30_000 < size["sum"]["de"] < 90_000 and size["max"]["de"] == 2000 and sample[sample.cls == "de"].held.nunique() == 1
    assert all(rows[-1][1].find(t) % 2000 == 0 for t in sample[sample.cls == "de"].text)
    assert set(L.learning_sample(frame, sample_chars=1).toPandas().cls) == {"de", "en"}
    learned = L.fit_identifier(frame, sample_chars=60_000)
    got = L.identify(documents([(1, "ein langer satz mit wort", "de", "s"), (2, "the number of the text", "en", "s")]), learned, [])
    assert [r.lang_pred for r in got.collect()] == ["de", "en"]


def test_copies_neither_fill_nor_use_up_the_sample(documents, monkeypatch):
    """Two texts make up two thirds of the rows: the others are drawn as without them, and a text trains once."""
    rows = [(i, f"text number {i} " * 20, "en", "s") for i in range(2000)]
    rows += [(5000 + i, f"copied text {i % 2} " * 20, "en", "s") for i in range(4000)]
    taken = []
    monkeypatch.setattr(L, "stored", lambda df, name: taken.append(df.cache()) or taken[-1])
    L.fit_identifier(documents(rows).selectExpr("lang AS cls", "text"), sample_chars=40_000)
    texts = taken[0].toPandas().text
    assert texts.is_unique and 25_000 < texts.str.len().sum() < 55_000


def test_no_share_is_too_small(documents, spark):
    """A budget far below 2^-20 of a class still bounds its sample; bounds are those of the share."""
    assert L.draw_bound(1.0) == L.draw_bound(7.0) == 2**63 - 1 and L.draw_bound(0.0) == -(2**63) and L.draw_bound(0.5) == 0
    rows = spark.range(3_000_000).select(F.lit("en").alias("cls"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    assert 1 <= L.learning_sample(rows, sample_chars=20).count() <= 12
