"""The pipeline's stages, each against its operator's brute-force meaning on its own input."""

from collections import Counter

import corpus_pipeline as P
import pytest

from subsight.llm import pii
from subsight.llm.queries import learned_identifier
from subsight.llm.simhash import fingerprint
from subsight.llm.tables import stored, table
from subsight.llm.wordscores import Memory

from .conftest import SMALL
from .test_mixing import check
from .test_simhash import brute as brute_components
from .test_winnowing import brute as brute_windows


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SMALL, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_stages_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "redact", "mix"]
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_language_stage(steps):
    learned = learned_identifier(steps[0])
    given = steps[0].collect()
    rejected = learned.judge([r.text for r in given], Memory(learned.model))[3]
    assert Counter(steps[1].collect()) == Counter(r for r, no in zip(given, rejected) if not no)
    assert steps[1].count() >= 0.99 * len(given)


def test_dedup_stage(steps):
    given = rows(steps[1])
    keep = {i for i, _, c in brute_components([(i, fingerprint(t)) for i, t, _, _ in given], 2) if i == c}
    assert Counter(rows(steps[2])) == Counter(r for r in given if r[0] in keep) and len(keep) < len(given)


def test_decontamination_stage(spark, steps):
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    given = rows(steps[2])
    bad = {r[0] for r in brute_windows(given, items) if r[5]}
    assert bad and Counter(rows(steps[3])) == Counter(r for r in given if r[0] not in bad)


def test_redaction_stage(steps):
    given, got = {r.doc_id: r for r in steps[3].collect()}, {r.doc_id: r for r in steps[4].collect()}
    assert set(given) == set(got)
    changed = 0
    for i, r in given.items():
        (base, spans), = pii.find_spans([r.text], pii.trained())
        assert got[i].text == pii.redacted(r.text, spans) and got[i].n_chars == len(got[i].text)
        changed += bool(spans)
    assert changed


def test_mixing_stage(steps):
    from subsight.llm.mixing import mix_documents

    given = rows(steps[4])
    per = mix_documents(steps[4]).collect()
    check(given, per)
    got = steps[5].collect()
    assert Counter(r.doc_id for r in got) == Counter({r.doc_id: r.copies for r in per if r.copies and r.size})
    assert all(r.text == {i: t for i, t, _, _ in given}[r.doc_id] for r in got[:20])


def test_run_gives_the_last_stage(spark, steps):
    assert Counter(map(tuple, P.run(spark, SMALL).collect())) == Counter(map(tuple, steps[5].collect()))


def test_edge_documents_pass_every_stage(spark, edge_documents):
    docs = edge_documents
    for name, stage in P.STAGES:
        before, docs = docs, stored(stage(spark, docs, SMALL), name)
        if name != "mix":
            assert docs.columns == before.columns
        docs.count()


def test_empty_documents_pass_every_stage(spark, documents):
    docs = documents([], extra=False)
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.count() == 0


def test_one_document_of_each_component(spark, documents):
    """Components without ids, rows that repeat an id, and an id with two texts."""
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(300)) for w in "abcd")
    lone = [(None, a, "en", "s")] * 3 + [(None, a.upper(), "en", "s")]
    repeated = [(4, b, "en", "s"), (4, b, "de", "t"), (4, b.upper(), "en", "s"), (9, b, "en", "s"), (None, b, "en", "s")]
    two = [(3, c, "en", "s"), (5, c, "en", "s"), (5, d, "en", "s")]
    given = lone + repeated + two + [(5, "some text that no other row has", "en", "s")]
    out = P.simhash_dedup(spark, documents(given), SMALL)
    assert out.columns == documents(given).columns
    assert sorted((r.doc_id or 0, r.text[:2].lower()) for r in out.collect()) == [(0, "a0"), (3, "c0"), (4, "b0"), (5, "d0"), (5, "so")]
    assert Counter(rows(out)) <= Counter(given)


def test_rows_with_maps_are_deduplicated(spark):
    """A column that has no order: of rows equal in id and text one stays, the same one each time."""
    text = " ".join(f"w{i}" for i in range(50))
    given = spark.createDataFrame([(1, text, {"a": 2}), (1, text, {"a": 1}), (2, text, {}), (3, "other words " * 9, None)],
                                  "doc_id long, text string, tags map<string,int>")
    out = sorted((r.doc_id, r.tags) for r in P.simhash_dedup(spark, given, SMALL).collect())
    assert out == [(1, {"a": 1}), (3, None)]
