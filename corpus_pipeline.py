"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import decontam, language_id, minhash, packing, suffix_dedup
from millwright.llm.common import read_table
from millwright.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language learned from the labelled ones."""
    docs = docs.select(*COLUMNS)
    return language_id.supported(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document, by id, of each group of near-duplicates.

    Rows with equal or null ids are documents of their own. Candidates are found by SimHash, and by
    MinHash bands where fingerprints are too far apart. Near-duplicates are those texts whose sets of
    five-word shingles have a Jaccard similarity of at least 0.8; groups are what such pairs connect.
    """
    return minhash.first_of_groups(docs, COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings that occur more than once out of the texts; documents stay, maybe empty."""
    kept = suffix_dedup.remove_repeats(docs, with_text=True, carry=["lang", "source"])
    return kept.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "carried.lang",
        "carried.source",
        F.length("kept_text").cast("bigint").alias("n_chars"),
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that contain no benchmark item."""
    items = read_table(spark, sf_dir, "benchmark")
    return decontam.without_items(docs.select(*COLUMNS), items, every_item=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' tokens in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("packing", packed),
]

# SQL can express neither the classifier nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
