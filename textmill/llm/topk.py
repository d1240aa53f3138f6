"""Exact top-k by inner product with the three-phase uniform threshold.

A score is the sum of two lists of partial scores, one for each half of the components. Queries and candidates meet in blocks.

1. Each block gathers, for each query, the k highest entries of either list; their totals are exact. The k-th highest
   total gathered for a query, over all blocks, is a lower bound t of its k-th best score.
2. The bound goes back to the blocks. A candidate with a total of t or more has t / 2 or more in one of the two lists,
   so the entries that reach t / 2 in a list are sufficient.
3. For these entries the other list is resolved, and the exact totals that reach t are ranked.

Cases: vectors that are null, empty or hold null or non-finite components take no part; vectors of different lengths are not scored with each other; of
rows with equal ids the one with the greatest vector counts; null ids take no part; a query with fewer than k candidates gets them all; ties go to
the smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import stored
from textmill.llm.links import runs_of
from textmill.llm.vectors import finite, matrix

QUERIES, CANDIDATES = 256, 4096  # rows of a block
KEYS = ["length", "left", "right"]
EXACT = 2.0**53


def _whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(64.0) * x.cast("double")).cast("long"))


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where they are exact, else in 64-bit integers."""
    if np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(queries.shape[1], 1) < EXACT:
        return (queries @ candidates.T).astype(np.int64)
    return queries.astype(np.int64) @ candidates.astype(np.int64).T


class _Scores:
    """Both lists of partial scores of a block; a query's own row never scores."""

    def __init__(self, group: pa.Table) -> None:
        side = group["side"].to_numpy()
        ids = group["id"].to_numpy()
        rows = matrix(group["vector"])
        self.queries, self.candidates = ids[side == 0], ids[side == 1]
        half = (rows.shape[1] + 1) // 2
        one, other = rows[side == 0], rows[side == 1]
        self.lists = [_products(one[:, :half], other[:, :half]), _products(one[:, half:], other[:, half:])]
        self.totals = self.lists[0] + self.lists[1]
        self.others = self.queries[:, None] != self.candidates[None, :]

    def entries(self, query: np.ndarray, candidate: np.ndarray) -> pa.RecordBatch:
        columns = [self.queries[query], self.candidates[candidate], self.totals[query, candidate]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def _gathered(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, KEYS):
            scores = _Scores(group)
            if not len(scores.queries) or not len(scores.candidates):
                continue
            lowest = np.iinfo(np.int64).min
            taken = np.zeros(scores.totals.shape, bool)
            for partial in scores.lists:
                held = np.where(scores.others, partial, lowest)
                top = np.argpartition(-held, min(k, held.shape[1]) - 1, axis=1)[:, :k] if held.shape[1] > k else None
                if top is None:
                    taken[:] = True
                else:
                    np.put_along_axis(taken, top, True, axis=1)
            taken &= scores.others
            totals = np.where(taken, scores.totals, lowest)
            if totals.shape[1] > k:  # the k highest totals gathered here suffice for the bound
                cut = -np.partition(-totals, k - 1, axis=1)[:, k - 1 : k]
                taken &= totals >= cut
            yield scores.entries(*np.nonzero(taken))

    return run


def _sufficient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in runs_of(batches, KEYS):
        scores = _Scores(group)
        side = group["side"].to_numpy()
        bound = group["bound"].to_numpy()[side == 0][:, None]
        reached = (2 * scores.lists[0] >= bound) | (2 * scores.lists[1] >= bound)
        query, candidate = np.nonzero(reached & scores.others)
        resolved = scores.totals[query, candidate] >= bound[query, 0]
        yield scores.entries(query[resolved], candidate[resolved])


def top_scores(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query row; is_query is an expression over vec_id."""
    usable = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"), is_query.alias("asks"))
    usable = usable.filter(finite(F.col("vector")) & F.col("id").isNotNull()).groupBy("id", "asks").agg(F.max("vector").alias("vector"))
    whole = stored(usable.select("id", "asks", _whole(F.col("vector")).alias("vector"), F.size("vector").alias("length")), "whole")
    sizes = stored(whole.groupBy("length").agg(
        F.ceil(F.count(F.when(F.col("asks"), 1)) / QUERIES).cast("int").alias("lefts"),
        F.ceil(F.count(F.lit(1)) / CANDIDATES).cast("int").alias("rights"),
    ), "sizes")
    placed = whole.join(sizes, "length").filter(F.col("lefts") > 0)
    steps = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = F.pmod(F.xxhash64("id"), F.col("lefts")).cast("int")
    right = F.pmod(F.xxhash64("id"), F.col("rights")).cast("int")
    columns = ["length", "left", "right", "side", "id", "vector"]
    queries = placed.filter("asks").select("*", left.alias("left"), steps(F.col("rights")).alias("right"), F.lit(0).alias("side"))
    candidates = placed.select("*", steps(F.col("lefts")).alias("left"), right.alias("right"), F.lit(1).alias("side"))
    queries, candidates = queries.select(columns), candidates.select(columns)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(*KEYS).sortWithinPartitions(*KEYS)

    schema = "query_id long, vec_id long, score long"
    first = dealt(queries.unionByName(candidates)).mapInArrow(_gathered(k), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
    bounds = ranked.groupBy("query_id").agg(F.min("score").alias("lowest"), F.count(F.lit(1)).alias("found"))
    # with fewer than k candidates in all, every one of them is wanted
    bound = F.when(F.col("found") >= k, F.col("lowest")).otherwise(F.lit(-(2**62)))
    bounds = stored(bounds.select(F.col("query_id").alias("id"), bound.alias("bound")), "bounds")
    asked = queries.join(bounds, "id").select(*columns, "bound")
    answers = candidates.withColumn("bound", F.lit(0).cast("long"))
    second = dealt(asked.unionByName(answers)).mapInArrow(_sufficient, schema)
    final = second.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return final.select("query_id", "rank", "vec_id", "score")
