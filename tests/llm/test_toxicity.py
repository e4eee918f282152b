import random

import numpy as np

from subsight.llm import toxicity as X
from subsight.llm.kneser_ney import train
from subsight.llm.wordscores import owners

from .conftest import EDGE_ROWS

RUDE = ["grobian", "grobiansch", "skunkface", "skunkfaced", "vilelout"]


def rows(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(r.choice(["ta", "ri", "no", "ke", "lu", "mo"]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(20, 200))]
        bad = i % 5 == 0
        for _ in range(r.randint(1, 3) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(RUDE))
        out.append(("1" if bad else "0", " ".join(words)))
    return out


def test_held_out(spark):
    scorer = X.fit_scorer(spark.createDataFrame(rows(800, 1), "cls string, text string"))
    test = rows(400, 2)
    y = np.array([c == "1" for c, _ in test])
    s = scorer.score([t for _, t in test], X.WordMemory(scorer.model))
    assert ((s >= 0.5) == y).mean() > 0.98
    # a rude word's unseen ending is still recognised, a clean long text left alone
    clean = " ".join(t for c, t in test if c == "0")
    more = scorer.score(["tari nokelu skunkfacest mori", clean, "", None, "12 !"], X.WordMemory(scorer.model))
    assert more[0] >= 0.5 and (more[1:] < 0.5).all()


def test_phrases_of_ordinary_words(spark):
    vocabulary = "you are not a good man go home now take your dog out and eat the soup we like him very much".split()
    phrases = ["go eat dog", "your man soup", "home you not"]  # every word is as ordinary as the others

    def texts(n, seed):
        r = random.Random(seed)
        out = []
        for i in range(n):
            words = [r.choice(vocabulary) for _ in range(r.randint(30, 120))]
            while any(p in " ".join(words) for p in phrases):
                words = [r.choice(vocabulary) for _ in range(len(words))]
            if i % 3 == 0:
                words.insert(r.randrange(len(words) + 1), r.choice(phrases))
            out.append(("1" if i % 3 == 0 else "0", " ".join(words)))
        return out

    scorer = X.fit_scorer(spark.createDataFrame(texts(3000, 1), "cls string, text string"))
    test = texts(600, 2)
    s = scorer.score([t for _, t in test], X.WordMemory(scorer.model))
    y = np.array([c == "1" for c, _ in test])
    assert ((s >= 0.5) == y).mean() > 0.9
    s = scorer.score(["we like him very much", "go eat dog"], X.WordMemory(scorer.model))
    assert s[1] > s[0]


def test_phrase_windows_by_brute_force(monkeypatch):
    r = random.Random(5)
    texts = [[r.choice("abcde") for _ in range(r.randint(0, 30))] for _ in range(60)]
    codes, place, starts = X._sequences([X.word_codes(t) for t in texts])
    counts = np.array([[1.0, 0.0], [0.0, 1.0]])[np.arange(60) % 2]
    model = train(codes, place, owners(starts, len(codes)), counts, X.CLASSES, 3, 1, 4)
    # every context's probabilities sum to one over the words and the unseen, pruned or not
    for before in (["a", "b"], ["c", "c"], ["e"], ["never", "a"], []):
        follow = [X.word_codes([*before, w]) for w in [*"abcde", "never"]]
        p = sum(np.exp(model.score(*X._sequences([f])[:2])[-1]) for f in follow)
        assert np.allclose(p, 1, atol=1e-5)

    def plain(text):
        whole = model.score(*X._sequences([X.word_codes(text)])[:2])[1:]
        ratio = whole[:, 1] - whole[:, 0]
        w = min(X.PHRASE_WORDS, len(ratio))
        return max(ratio[i:i + w].sum() for i in range(len(ratio) - w + 1)) / X.PHRASE_WORDS

    some = [t for t in texts if t]
    want = [plain(t) for t in some]
    scorer = X.Scorer(X._blank(), model, np.zeros(5))
    for block in (1 << 18, 7, 1):
        monkeypatch.setattr(X, "BLOCK_WORDS", block)
        assert np.allclose(list(scorer._phrase_ratios([X.word_codes(t) for t in some])), want, atol=1e-5)


def test_accuracy_on_the_given_labels(spark):
    from subsight.llm.queries import op6_toxicity

    got = op6_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = got.merge(marks, on="doc_id")
    held = held[held.held_out]
    # about half of the toxic texts of this table hold no word that others do not
    assert len(held) > 500 and (held.predicted == held.toxic).mean() > 0.93
    assert held[held.toxic == 0].predicted.mean() < 0.01
    text = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").toPandas()
    rude = held.merge(text, on="doc_id")
    rude = rude[rude.text.str.lower().str.contains(r"\b(?:idiot|moron|scum|trash|worthless|disgusting|pathetic|stupid)\b")]
    assert len(rude) > 20 and rude.predicted.mean() > 0.97


def test_edges(spark, documents, edge_documents):
    scorer = X.fit_scorer(spark.createDataFrame(rows(200, 3) + [(None, "x"), ("1", None), ("7", "y"), ("0", "")], "cls string, text string"))
    out = X.score_toxicity(edge_documents, scorer, [edge_documents.doc_id]).collect()
    assert [r.doc_id for r in out] == [r[0] for r in EDGE_ROWS]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    none = [r.score for r, e in zip(out, EDGE_ROWS) if not any(c.isalpha() for c in e[1] or "")]
    assert len(set(none)) == 1 and none[0] < 0.5
    assert X.score_toxicity(documents([]), scorer, []).count() == 0


def test_few_or_one_sided_labels(spark):
    frame = lambda data: X.fit_scorer(spark.createDataFrame(data, "cls string, text string"))
    for data, want in (([], 0), ([("0", "fine words")] * 3, 0), ([("1", "rude words")] * 3, 1)):
        s = frame(data)
        assert [int(v >= 0.5) for v in s.score(["any words", None], X.WordMemory(s.model))] == [want, want]
    two = frame([("0", "fine words here"), ("1", "grobian skunkface")])
    assert all(0 <= v <= 1 for v in two.score(["grobian", "fine"], X.WordMemory(two.model)))
