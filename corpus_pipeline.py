"""The training-data pipeline: five stages over documents, each from a DataFrame to a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import linededup, minhash, mixing, packing, toxicity
from textmill.llm.common import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Toxic documents go; the grammar is learned from the labels that are not held out."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, folder, "labels")))


def deduplicate_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of similar lines the first stays; a document that loses all its lines stays with an empty text."""
    return linededup.deduplicated(docs)


def deduplicate_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8 or more."""
    return minhash.deduplicated(docs, size=5, parts=80, whole=100)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources in their target shares of words; documents of scarce sources repeat."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in bins of 2048 words; repeats of a document never share a bin."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", deduplicate_lines),
    ("minhash", deduplicate_documents),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: fuzzy line groups, near-duplicate groups and the learned grammar are not expressible in SQL; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), name)
    return docs
