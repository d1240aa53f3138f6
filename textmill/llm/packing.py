"""Best-fit packing under conflicts.

Documents are cut into pieces of at most one bin. In each shard of pieces, largest first, a piece goes to the bin with the smallest residual that
holds it and does not conflict: bins stand in the order of their residuals, and the search goes on from the successor of the size to
the next larger residuals until a compatible bin is found, or a new one is opened. A bin carries a bitmap of its sources and one
of its duplicate clusters; it takes no second piece of a source and none of a cluster that it holds.

Shards are dealt by a hash of row positions and have `shard_rows` pieces on average, whatever the sources and clusters are, so a hot
source or cluster never meets in one task. No bin spans shards.

Without a column of clusters, equal texts are one; with the table of `near_copies`, near copies too.

Cases: a null source or cluster conflicts with nothing; texts without words are pieces of size 0; repeated rows are packed
like others and, having one cluster, never share a bin; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import minhash
from textmill.llm.common import stored, word_count

CAPACITY = 2048
SHARD_ROWS = 2000


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of every piece; -1 as a source or cluster stands for none."""
    placed = [0] * len(sizes)
    order: list[tuple[int, int]] = []  # residual and bin, ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        source = 1 << sources[i] if sources[i] >= 0 else 0
        cluster = 1 << clusters[i] if clusters[i] >= 0 else 0
        at = bisect_left(order, (sizes[i], -1))
        while at < len(order) and (held_sources[order[at][1]] & source or held_clusters[order[at][1]] & cluster):
            at += 1
        if at < len(order):
            residual, bin_ = order.pop(at)
            held_sources[bin_] |= source
            held_clusters[bin_] |= cluster
        else:
            residual, bin_ = capacity, len(held_sources)
            held_sources.append(source)
            held_clusters.append(cluster)
        insort(order, (residual - sizes[i], bin_))
        placed[i] = bin_
    return placed


def _packer(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "part", "row"], kind="stable", na_position="last")
        codes = [pd.factorize(rows[c])[0].tolist() for c in ("source", "cluster")]
        placed = best_fit(rows["size"].tolist(), *codes, capacity)
        bins = rows["shard"].astype("int64") * (1 << 24) + np.array(placed, "int64")
        return rows[["doc_id", "part", "size", "source", "cluster"]].assign(bin=bins)

    return run


def near_copies(docs: DataFrame, size: int = 5, parts: int = 80, whole: int = 100) -> DataFrame:
    """(cluster, component) of the lower-cased texts that are near copies of another: shingles of `size` words, similarity of parts / whole.

    Digests stand for ids, so that rows without an id and texts that share one are compared too.
    """
    texts = docs.select(F.lower("text").alias("text")).filter("text != ''").select(F.xxhash64("text").alias("doc_id"), "text")
    groups = minhash.duplicate_groups(texts, size, parts, whole).filter(F.col("doc_id") != F.col("component_id"))
    return stored(groups.groupBy(F.col("doc_id").alias("cluster")).agg(F.min("component_id").alias("component")), "near_copies")


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    cluster: str | None = None,
    shard_rows: int = SHARD_ROWS,
    near: DataFrame | None = None,
) -> DataFrame:
    """doc_id, part, size, source, cluster and bin of every piece; part p of a document starts at word p * capacity.

    The cluster is the given column or, without one, the lower-cased text: equal texts conflict, and with the table `near` (see `near_copies`)
    near copies do. Texts are read once for their sizes and digests; only slim rows are shuffled.
    """
    label = F.col(f"`{cluster}`").cast("string") if cluster else F.lower("text")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.when(label != "", F.xxhash64(label)).alias("cluster"),
        word_count(F.col("text")).alias("words"),
    )
    if near is not None:
        sized = sized.join(near, "cluster", "left").withColumn("cluster", F.coalesce("component", "cluster"))
    last = F.greatest(F.ceil(F.col("words") / capacity).cast("int") - 1, F.lit(0))
    parts = sized.select("*", F.explode(F.sequence(F.lit(0), last)).alias("part")).select(
        "doc_id", "source", "cluster", "part", F.least(F.lit(capacity), F.col("words") - F.col("part") * capacity).alias("size")
    )
    pieces = stored(parts, "pieces")
    shards = max(1, round(pieces.count() / shard_rows))
    dealt = pieces.withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    schema = "doc_id long, part int, size long, source string, cluster long, bin long"
    return dealt.groupBy("shard").applyInPandas(_packer(capacity), schema)
