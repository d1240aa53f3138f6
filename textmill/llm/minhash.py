"""Near-duplicate documents by MinHash.

Each text becomes the set of its word shingles (64-bit hashes). Equal sets are collapsed by size and a 128-bit digest. The others
get the minima of 125 universal hashes in 25 bands of 5: at a similarity of 0.85 a pair shares no band with a probability of
4e-7, at 0.8 of 5e-5. Pairs are drawn from bands by rounds (see `links`), estimated on signatures, confirmed on full sets, and joined by
alternating large-star and small-star.

Cases: null and empty texts and texts without words have no shingles, link with nothing and are kept; fewer words than a
shingle make one shingle of the whole sequence; very long texts are hashed piece by piece; an id names one text, so of several texts
with one id only one is compared beyond equality; a null id links with nothing and is kept; an empty table gives an empty result;
other columns are ignored by `duplicate_groups` and kept by `deduplicated`, which drops repeated rows of a kept document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import shingles
from textmill.llm.common import stored
from textmill.llm.links import Threshold, similar_components

BANDS, ROWS = 25, 5


def _signed(size: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = shingles.Minima(bands, rows)
        for batch in batches:
            ids, texts = batch["doc_id"], shingles.text_bytes(batch["text"])
            for first, last in shingles.slices(texts):
                sets = list(shingles.word_sets(texts[first:last], size))
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                keys, _ = minima.of([sets[i] for i in full])
                all_keys: list = [None] * len(sets)
                for at, i in enumerate(full):
                    all_keys[i] = keys[at]
                digests = np.array([[s.sum(), shingles.mix(s * shingles.U(5)).sum()] for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(sizes),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        pa.array(all_keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "d1", "d2", "keys"],
                )

    return run


def duplicate_groups(docs: DataFrame, size: int = 5, parts: int = 80, whole: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row: links are pairs of sets with a similarity of parts / whole."""
    threshold = Threshold(parts, whole)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n long, d1 long, d2 long, keys array<long>"
    signed = stored(texts.mapInArrow(_signed(size, BANDS, ROWS), schema), "minhash")
    same = ["n", "d1", "d2"]
    linked = signed.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    firsts = stored(linked.groupBy(*same).agg(F.min("doc_id").alias("first")), "firsts")
    members = stored(signed.select("doc_id", *same).join(firsts, same, "left"), "equal_sets")
    chosen = members.filter(F.col("doc_id") == F.col("first")).select("doc_id", *same).distinct()
    chosen = linked.join(chosen, ["doc_id", *same], "left_semi").withColumnRenamed("doc_id", "id")
    wanted = texts.withColumnRenamed("doc_id", "id")
    labels = similar_components(
        chosen.select("id", "keys"),
        lambda ids: wanted.join(ids, "id", "left_semi").dropDuplicates(["id"]),
        threshold,
        partial(shingles.word_sets, size=size),
    )
    joined = F.coalesce("component", "first", "doc_id") if labels is not None else F.coalesce("first", "doc_id")
    if labels is not None:
        members = members.join(labels.withColumnRenamed("id", "first"), "first", "left")
    rows = members.select("doc_id", F.col("n").alias("n_shingles"), joined.alias("component_id"))
    linkable = F.col("doc_id").isNotNull()
    rows = rows.withColumn("component_id", F.when(linkable, F.col("component_id")))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, size: int = 5, parts: int = 80, whole: int = 100) -> DataFrame:
    """The rows of one document of each group, the one with the smallest id, with their own columns."""
    groups = stored(duplicate_groups(docs, size, parts, whole), "groups")
    gone = groups.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    twice = groups.filter("kept").groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL")
    if twice.isEmpty():
        return left
    again = twice.select(F.col("doc_id").alias("_again"))
    once = left.join(again, left["doc_id"] == again["_again"], "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, left["doc_id"] == again["_again"], "left_anti").unionByName(once)
