"""Connected components by alternating large-star and small-star operations over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") > F.col("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def components(edges: DataFrame, one: str, other: str) -> DataFrame:
    """(id, component) of every node of the edges; the component is its smallest node.

    Each round is written below the shared folder, and only a count and a checksum reach the driver. Nodes pass on minima,
    never whole neighbour lists, so a node of any degree is reduced before the shuffle; joins of a hub with its neighbours are
    left to the skew handling of the adaptive plan. Loops and repeated edges are allowed; an edge with a null end goes.
    """
    held = edges.select(F.col(one).alias("u"), F.col(other).alias("v")).filter(F.col("u") != F.col("v"))
    before = None
    while True:
        held = stored(_small_star(_large_star(held)), "stars")
        now = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    roots = held.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return held.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
