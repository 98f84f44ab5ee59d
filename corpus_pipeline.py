"""A pipeline over ``documents``, each stage on all that the one before has kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir), docs being the rows that the
stage before wrote, and returns a DataFrame with the columns of ``documents``. The last stage returns
the mix: those columns and ``repetition``, a row for each repetition of a document.

Every stage handles NULLs, empty texts, repeated rows, empty tables and further columns as the
docstring of its operator says; further columns are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontamination, langid, mixing, pii, simhash
from barloom.llm.common import read_table, shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier rejects go; the labels of ``docs`` train it."""
    return langid.accepted(docs, langid.fit(docs.select("doc_id", "text", "lang")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.keep_one_each(docs, words=3, radius=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in a text are replaced by their kind; every document stays.

    ``n_chars`` follows the text.
    """
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target shares, documents repeated as the mix takes them."""
    return mixing.mixed_rows(docs, weights=(5.0, 2.0, 1.0), share=1.5, max_epochs=2.0)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact_personal_data),
    ("source_mixing", mix_sources),
]

# Trained classifiers, fingerprints and seeded sampling are beyond SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet in the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
