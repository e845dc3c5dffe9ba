"""From raw documents to packed sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows that
its predecessor kept; ``run`` writes what a stage returns as Parquet in the
shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casework.llm import decontaminate, language_id, ngram_join, packing, pii
from casework.llm.common import stage, table


# languages that stay; None: every language that is learned
WANTED: list[str] | None = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a wanted language (``WANTED``; None: in any
    that the documents' labels teach)."""
    return language_id.keep_languages(docs, language_id.train(docs), WANTED)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redacted(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", sequences),
]

# SQL can express neither the trained language model nor the tokenizer; tests
# hold the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
