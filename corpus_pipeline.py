"""The corpus pipeline: documents to a training order, stage by stage.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which ``run`` writes to the shared folder
and rereads as the next one's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight.llm.language import keep_identified
from subsight.llm.mixing import training_order
from subsight.llm.pii import redact_pii
from subsight.llm.queries import learned_identifier
from subsight.llm.simhash import kept_copies
from subsight.llm.tables import stored, table
from subsight.llm.winnowing import contamination


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models, learned from the labelled ones among them, do not reject.

    Rows without a letter (null or blank texts, numbers) have no language and go.
    """
    return keep_identified(docs, learned_identifier(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays: the one with the least ``doc_id``, nulls last.

    Of several texts with that id in the component, the one of least hash
    stays; of several rows with that id and text, the least by the JSON form
    of its columns (maps included). Null texts are one component with the
    empty ones.
    """
    kept, again = kept_copies(docs)
    of = lambda keys: docs.doc_id.eqNullSafe(keys.kept_id) & (F.xxhash64(docs.text) == keys.kept_key)
    if again.isEmpty():
        return docs.join(kept, of(kept), "left_semi")
    once = kept.join(again.select(F.col("kept_id").alias("id"), F.col("kept_key").alias("key")),
                     F.col("kept_id").eqNullSafe(F.col("id")) & (F.col("kept_key") == F.col("key")), "left_anti")
    whole = F.struct(*docs.columns)
    repeated = docs.join(again, of(again), "left_semi")
    least = repeated.groupBy(repeated.doc_id, F.xxhash64(repeated.text)).agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return docs.join(once, of(once), "left_semi").unionByName(least.select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null texts have none and stay.

    The ids to drop are written first, so that their size is known when the
    join is planned: where they are few no text is shuffled.
    """
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated") \
        .select(F.col("doc_id").alias("hit_id"), "text_key").distinct()
    found = stored(found, "contaminated")
    return docs.join(found, docs.doc_id.eqNullSafe(found.hit_id) & (F.xxhash64(docs.text) == found.text_key), "left_anti")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` that of the new text."""
    clean = redact_pii(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in training order; documents without words (null texts) are not taken."""
    return training_order(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("mix", mix),
]
#: Model scores and fingerprints are not SQL; the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
