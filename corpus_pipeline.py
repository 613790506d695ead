"""A training corpus in five stages, each read from what the one before has written.

``run`` applies STAGES to the documents of a folder. All stages but the last return the columns
of documents; a stage's decisions take effect in its rows: language ID drops documents without
a letter and labels those without a label, the n-gram join keeps one document of each group of near duplicates,
decontamination cuts benchmark passages out of the texts (a text that is nothing else goes),
personal data is replaced by its kind in brackets, and packing returns the pieces of sequences.
An empty table passes through every stage as an empty table. Further columns of documents, whatever
they are called, are carried in one struct while an operator runs, so none of them meets its own
columns, and come out as they were.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from salesloom.llm import decontaminate, langid, ngram_join, packing, pii  # noqa: E402
from salesloom.llm.common import remainder, ship, stage, table  # noqa: E402


# The columns of documents that the stages read or change.
OWN = ("doc_id", "text", "lang", "source", "n_chars")
CARRIED = "_carried"


def _apart(docs: DataFrame) -> DataFrame:
    """The columns of documents, and all others in one struct."""
    own, others = [], []
    for name in docs.columns:
        (own if name in OWN else others).append(name)
    return docs.select(*own, *([F.struct(*[f"`{c}`" for c in others]).alias(CARRIED)] if others else []))


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of a result over ``_apart(docs)``."""
    return found.select(*[
        F.col(c) if c in OWN else F.col(CARRIED).getField(c).alias(c) for c in docs.columns
    ])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; a missing label becomes the predicted one, if any was learned."""
    ship(spark)
    rows = _apart(docs)
    samples = langid.sample(rows.where(remainder(F.col("doc_id"), 5) != 0))
    found = rows.withColumn("_found", langid.language(F.col("text"), samples))
    predicted = F.nullif(F.col("_found.lang"), F.lit(langid.UNKNOWN))
    # Without labels nothing is predicted: a text with letters stays all the same.
    kept = found.where(predicted.isNotNull() | F.col("text").rlike(r"\p{L}"))
    return _back(kept.withColumn("lang", F.coalesce("lang", predicted)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 similarity of five-word shingles."""
    return _back(ngram_join.first_of_groups(_apart(docs), words=5, num=80, den=100), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that hold a ten-word window of a benchmark item."""
    found = decontaminate.find(_apart(docs), table(spark, sf_dir, "benchmark"), remove=True)
    rest = found.where(
        (F.size("spans") == 0) | (decontaminate.hit_words(F.col("spans")) < F.col("n_words"))
    )
    return _with_length(rest, docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data redacted."""
    rows = _apart(docs)
    return _with_length(pii.redact(pii.detect(rows, pii.fit(rows))), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences of at most 1024 tokens."""
    return packing.sequences(docs)


def _with_length(changed: DataFrame, docs: DataFrame) -> DataFrame:
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return _back(changed.withColumn("n_chars", length), docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing_stage),
]

# Language models, boosted trees and tokenizers are not SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
