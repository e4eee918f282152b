import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT / "tools"))

SMALL = "/root/testdata/sf0.001"
#: Columns whose names operators use themselves; they must neither clash nor be read.
CLASHING = ("id string, fp string, text_key string, component_id string, score string, size string, target string, taken string, "
            "cls string, held string, rep string, node string, root string, u string, v string, key string, bucket string, "
            "kept string, hits string, position string, repeat string, tokens string, before string")
N_CLASHING = CLASHING.count(",") + 1


@pytest.fixture(scope="session", autouse=True)
def workers_import_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
        filter(None, [str(ROOT), spark.sparkContext.environment.get("PYTHONPATH", "")]))


@pytest.fixture()
def documents(spark):
    """Documents from ``(doc_id, text, lang, source)`` rows, with columns of clashing names."""
    def make(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        data = [(i, t, lang, src, len(t) if t is not None else None) for i, t, lang, src in rows]
        if not extra:
            return spark.createDataFrame(data, schema)
        return spark.createDataFrame([(*r, *["x"] * N_CLASHING) for r in data], f"{schema}, {CLASHING}")

    return make


LONG = "word " * 120_000 + "end"
#: Nulls in every column, empty and blank texts, one letter, a very long text, repeated rows and ids, ties.
EDGE_ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "a", None, "a"), (5, LONG, "en", "b"),
    (6, "the same words in two rows of the table", "en", None), (6, "the same words in two rows of the table", "en", None),
    (6, "another text with the id of two other rows", "de", "b"), (None, "a text without an id has its say", "de", "b"),
    (None, None, None, None), (7, "1234 5678 !!! ???", "en", "c"), (8, "Ünïcödé \U0001f600 漢字 text", "de", "c"),
]


@pytest.fixture()
def edge_documents(documents):
    return documents(EDGE_ROWS)
