"""Shards that all carry the mixture of the corpus: proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; row r of n gets the fraction (2r - 1) / 2n. Sorted by that
fraction the sources are interleaved in proportion all along the order, so every run of rows, and with it every shard, has the
mixture of the whole. The order is cut into equal counts.

Cases: a null source is a source of its own; a null text has no bytes and no checksum; null ids are hashed like a value; equal
rows are separate rows; an empty table gives an empty result; other columns are ignored. Equal texts are not held together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import source_key, stored
from textmill.operators.ordering import global_running

ROW_BYTES = 16


def interleaved_shards(docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, source, shard and slot of every row; shard counts differ by one at most.

    Both orders are range partitions with offsets per partition, so a source with a third of the rows is spread over
    partitions like any other. Only slim rows are sorted; texts are read once and never shuffled.
    """
    raw = F.col("text").cast("binary")
    rows = stored(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            (F.coalesce(F.octet_length(raw), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            source_key(F.col("source")).alias("stratum"),
            F.xxhash64(F.lit(seed), F.col("doc_id")).alias("shuffle"),
        ),
        "shards",
    )
    total = rows.count()
    unique = [F.col(c) for c in ("shuffle", "doc_id", "text_crc32", "size")]
    ranked = stored(global_running(rows, [F.col("stratum"), *unique], rank="place"), "ranks")
    strata = ranked.groupBy("stratum").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("members"))
    within = F.col("place") - F.col("start")
    mixed = ranked.join(strata, "stratum").select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "shuffle",
        F.xxhash64(F.lit(seed), F.col("stratum")).alias("turn"),
        ((2 * within + 1) / (2 * F.col("members"))).alias("fraction"),
    )
    ordered = global_running(mixed, [F.col("fraction"), F.col("turn"), *unique], rank="place")
    place = (F.col("place") - 1).cast("long")
    cut = ordered.withColumn("shard", F.floor(place * shards / F.lit(max(total, 1))).cast("int"))
    first = F.ceil(F.col("shard") * F.lit(total) / F.lit(shards)).cast("long")
    return cut.select("doc_id", "size", "text_crc32", "source", "shard", (place - first).alias("slot"))
