"""Mixing sources to target weights by repetition rates.

Words are summed per source; targets share the total by weight, stop at a multiple of the source's words, and the excess is
shared again among the others. The rate of a source is target / words. A document is taken floor(rate) times, plus once more if
its seeded hash, uniform in [0, 1), lies below the fraction of the rate: an independent Bernoulli copy that every rerun repeats.

Cases: a null source is a source of its own and comes last; null and empty texts have size 0 and take no words; a source without
words has target and rate 0; an empty table gives an empty result; rows with equal ids are decided alike; a null id is hashed
as the word null; other columns are kept by `mixed` and ignored by `decisions`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import seeded_unit, source_key, stored, word_count
from textmill.operators.ordering import global_running

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"


def targets(words: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """stratum, source_size and target of each source, from rows (stratum, size).

    With the sources in the order of limit / weight, the shared level is the first quotient of what is left of the total and of
    the weights that no limit below it exceeds. Ranks and running sums are spread over range partitions; two numbers reach
    the driver.
    """
    sources = stored(words.groupBy("stratum").agg(F.sum("size").alias("source_size")), "sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    ranked = global_running(sources, [F.col("stratum")], rank="place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    weighed = stored(
        ranked.select("stratum", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("limit")),
        "weights",
    )
    whole = weighed.agg(F.sum("weight").alias("n")).first()["n"] or 1
    running = global_running(
        weighed.withColumn("ratio", F.col("limit") / F.col("weight")),
        [F.col("ratio"), F.col("stratum")],
        sums={"limits": "limit", "weighed": "weight"},
        rank="place",
    )
    left = F.lit(total) - (F.col("limits") - F.col("limit"))
    level = left / (F.lit(whole) - (F.col("weighed") - F.col("weight")))
    reached = running.withColumn("level", level).filter(F.col("ratio") >= F.col("level"))
    shared = reached.agg(F.min_by("level", "place").alias("level")).first()["level"]
    target = F.least(F.col("limit").cast("double"), F.lit(float(shared or 0.0)) * F.col("weight"))
    return weighed.select("stratum", "source_size", target.alias("target"))


def copies(rate: Column, unit: Column) -> Column:
    """floor(rate) copies, and one more with probability of the fraction."""
    whole = F.floor(rate)
    return (whole + (unit < rate - whole).cast("long")).cast("int")


def _rated(rows: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.join(sources, "stratum").withColumn("copies", copies(rate, seeded_unit(seed, F.col("doc_id"))))


def decisions(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target and copies of every row. Texts are read once and only slim rows are shuffled."""
    rows = docs.select("doc_id", source_key(F.col("source")).alias("stratum"), word_count(F.col("text")).alias("size"))
    rows = stored(rows, "sizes")
    return _rated(rows, targets(rows, weights, most), seed).select("doc_id", "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The rows of the mixture: each input row as often as it is taken, with its own columns only."""
    words = docs.select(source_key(F.col("source")).alias("stratum"), word_count(F.col("text")).alias("size"))
    sources = targets(words, weights, most)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id"),
        source_key(F.col("source")).alias("stratum"),
    )
    taken = _rated(rows, sources, seed).filter(F.col("copies") > 0)
    return taken.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
