"""The queries of this subpackage, one for each operator, with a DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import licences, linededup, minhash, mixing, negatives, packing, pii, repair, sharding, tokencounts, topk, toxicity, vectors
from textmill.llm.common import table
from textmill.llm.sql import OP1_SQL, OP4_SQL, OP8_SQL, OP9_SQL, OP10_SQL, OP13_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles are similar by 85 % or more."""
    return minhash.duplicate_groups(table(spark, folder, "documents"), size=3, parts=85, whole=100)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from labels that are not held out."""
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """40 shards of equal counts, each with the mixture of sources."""
    return sharding.interleaved_shards(table(spark, folder, "documents"), shards=40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licences that a document is or holds as a whole paragraph or line."""
    found = licences.scanned(table(spark, folder, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with pseudonyms for personal data, and the number of values replaced."""
    return pii.pseudonymised(table(spark, folder, "documents")).select("doc_id", "text", "n_values")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Bins of 2048 words without two pieces of a source or of a duplicate cluster."""
    docs = table(spark, folder, "documents")
    return packing.packed(docs, near=packing.near_copies(docs))


def op7_linededup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document that go because a similar line stays elsewhere."""
    return linededup.decisions(table(spark, folder, "documents"))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 highest scores of every vector whose id is divisible by 20."""
    return topk.top_scores(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mixture takes of every document."""
    return mixing.decisions(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op10_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of vectors with a cosine of 0.9 or more."""
    return vectors.duplicate_groups(table(spark, folder, "embeddings"), least=0.9)


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation after its damage."""
    return repair.repaired(table(spark, folder, "conversations"))


#: the tokenizer file of op12, a parameter: its place comes from the package of public tokenizers
TOKENIZER = "byte_bpe_50k.json"


def op12_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole text, and whether they pass 1024."""
    import public_tokenizers

    docs = table(spark, folder, "documents")
    counted = tokencounts.token_prefixes(docs, public_tokenizers.path(TOKENIZER), columns=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (~tokencounts.fits(F.col("n_tokens"), 1024)).alias("over_limit"))


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor (vec_id divisible by 100) and each of its 5 positives."""
    return negatives.mined(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_minhash": op1_minhash,
    "op2_toxicity": op2_toxicity,
    "op3_sharding": op3_sharding,
    "op4_licences": op4_licences,
    "op5_pii": op5_pii,
    "op6_packing": op6_packing,
    "op7_linededup": op7_linededup,
    "op8_topk": op8_topk,
    "op9_mixing": op9_mixing,
    "op10_vectors": op10_vectors,
    "op11_repair": op11_repair,
    "op12_tokens": op12_tokens,
    "op13_negatives": op13_negatives,
}
ORACLES: dict[str, str] = {
    "op1_minhash": OP1_SQL,
    "op4_licences": OP4_SQL,
    "op8_topk": OP8_SQL,
    "op9_mixing": OP9_SQL,
    "op10_vectors": OP10_SQL,
    "op13_negatives": OP13_SQL,
}
