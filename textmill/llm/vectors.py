"""Near-duplicate vectors by spherical k-means cells.

Centroids are fitted on a bounded sample with cosine distance. Every vector has a home cell, that of the nearest centroid, and visits the
cells with smaller numbers that a vector at the threshold can lie in: those whose border is at most the threshold's angle away. No link is
lost, in whatever direction the vectors differ. Cosine products are computed block by block between a cell's own vectors and
between them and its visitors, so each pair is compared once at most. A block puts out counts and a spanning set of links, never
pairs; links are joined by star operations, and the vector with the smallest id of a group is kept.

Vectors spread evenly in many dimensions are near all borders, so nearly all pairs are compared. Cells are therefore as large as blocks
allow: the copies of a vector that are shuffled are one for each cell that it visits and one for each block that it is compared with.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different lengths do not link with each
other; equal vectors are collapsed first and count as linked with each other, repeated rows included; a null id links like any
other vector but has no component by itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import stored
from textmill.llm.components import components
from textmill.llm.links import runs_of

SAMPLE = 50_000  # vectors that the centroids are fitted on, at most
CELLS = 4096  # cells at most; otherwise as many as two cells to a block need
FEWEST = 16  # cells at least, if there are so many vectors
BLOCK = 8192  # vectors on either side of a block at most
NUMBERS = 1 << 22  # components on either side of a block at most
TILE = 512  # rows at a time
SLACK = 1e-9  # for rounding
KEYS = ["cell", "visiting", "left", "right"]


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _fitted(vectors: DataFrame, count: int, cells: int) -> np.ndarray:
    share = min(1.0, SAMPLE / count)
    chosen = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    rows = vectors.filter(chosen).select(array_to_vector(F.transform("vector", lambda x: x.cast("double") / largest)).alias("features"))
    model = KMeans(k=cells, distanceMeasure="cosine", initMode="random", maxIter=8, seed=3).fit(rows)
    centres = np.array(model.clusterCenters())
    return centres / np.linalg.norm(centres, axis=1, keepdims=True)


def _celled(centres: np.ndarray, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every vector with its home cell and the cells that it visits.

    A vector lies asin((best - near) / apart) from the border with another cell, and none of that cell is nearer to it.
    """
    reach = sqrt(1 - least * least) if least > 0 else 2.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                near = unit(matrix(part["vector"])) @ centres.T
                home = near.argmax(axis=1)
                best = near[np.arange(len(home)), home]
                visits = (best[:, None] - near <= reach * apart[home] + SLACK) & (np.arange(len(centres)) < home[:, None])
                ends = np.concatenate([[0], visits.sum(axis=1).cumsum()]).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(visits)[1].astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home.astype(np.int32)), cells, *(part[c] for c in ("id", "weight", "vector"))],
                    ["home", "visits", "id", "weight", "vector"],
                )

    return run


def _dealt(celled: DataFrame, block: int) -> DataFrame:
    """Rows of each pair of blocks: a cell's blocks with each other, and blocks of visitors with them."""
    place = lambda cell, v: F.struct(cell.alias("cell"), F.lit(v).alias("visiting"))
    places = F.concat(F.array(place(F.col("home"), 0)), F.transform("visits", lambda c: place(c, 1)))
    count = lambda v: F.count(F.when(F.col("visiting") == v, 1))
    sizes = celled.select(F.explode(places).alias("place")).select("place.*").groupBy("cell")
    sizes = sizes.agg(F.ceil(count(0) / block).cast("int").alias("homes"), F.ceil(count(1) / block).cast("int").alias("guests"))
    rows = celled.select("id", "weight", "vector", F.explode(places).alias("place")).select("place.*", "id", "weight", "vector")
    rows = rows.join(F.broadcast(sizes), "cell")
    steps = lambda a, b: F.filter(F.sequence(a, F.greatest(a, b)), lambda i: i <= b)
    own = F.pmod(F.xxhash64("id"), F.when(F.col("visiting") == 0, F.col("homes")).otherwise(F.col("guests"))).cast("int")
    rows = rows.withColumn("own", own)
    pair = lambda v, left, right, side: F.struct(
        F.lit(v).alias("visiting"), left.alias("left"), right.alias("right"), F.lit(side).alias("side")
    )
    me, zero = F.col("own"), F.lit(0)
    home = F.concat(
        F.transform(steps(me, F.col("homes") - 1), lambda j: pair(0, me, j, 0)),
        F.transform(steps(zero, me - 1), lambda i: pair(0, i, me, 1)),
        F.transform(steps(zero, F.col("guests") - 1), lambda i: pair(1, i, me, 1)),
    )
    guest = F.transform(steps(zero, F.col("homes") - 1), lambda j: pair(1, me, j, 0))
    pairs = F.when(F.col("visiting") == 0, home).otherwise(guest)
    return rows.select("cell", "id", "weight", "vector", F.explode(pairs).alias("pair")).select(
        "cell", "pair.*", "id", "weight", "vector"
    )


def _linked(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each pair of blocks: how many vectors each one links with, and the smallest id that links inside the pair reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, KEYS):
            side = group["side"].to_numpy()
            ids, weights = group["id"].to_numpy(), group["weight"].to_numpy()
            rows = unit(matrix(group["vector"]))
            same = group["visiting"][0].as_py() == 0 and group["left"][0].as_py() == group["right"][0].as_py()
            left = np.flatnonzero(side == 0)
            right = left if same else np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            links = np.empty((len(left), len(right)), bool)
            for at in range(0, len(left), TILE):
                links[at : at + TILE] = rows[left[at : at + TILE]] @ rows[right].T >= least
            if same:
                np.fill_diagonal(links, False)
            some, others = links.any(axis=1), links.any(axis=0)
            if not some.any():
                continue
            left, right, links = left[some], right[others], links[np.ix_(some, others)]
            counts = np.zeros(len(ids), np.int64)
            tiles = [slice(at, at + TILE) for at in range(0, len(left), TILE)]
            for t in tiles:
                counts[left[t]] += links[t] @ weights[right]
                if not same:
                    counts[right] += weights[left[t]] @ links[t]
            roots = ids.copy()
            most = np.iinfo(np.int64).max
            while True:
                now = roots.copy()
                for t in tiles:
                    low = np.where(links[t], now[right][None, :], most).min(axis=1)
                    now[left[t]] = np.minimum(now[left[t]], low)
                    low = np.where(links[t], now[left[t]][:, None], most).min(axis=0)
                    now[right] = np.minimum(now[right], low)
                if (now == roots).all():
                    break
                roots = now
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(counts[some]), pa.array(roots[some])], ["id", "links", "root"]
            )

    return run


def _links(vectors: DataFrame, least: float) -> DataFrame:
    """(id, links, root) of the linked vectors of one length, several rows for an id."""
    count, length = vectors.count(), vectors.first()["length"]
    most = max(1, min(BLOCK, NUMBERS // length))
    cells = min(CELLS, max(ceil(2 * count / most), FEWEST), ceil(sqrt(count)))
    centres = _fitted(vectors, count, cells) if cells > 1 else np.eye(1, length)
    schema = "home int, visits array<int>, id long, weight long, vector array<float>"
    celled = stored(vectors.select("id", "weight", "vector").mapInArrow(_celled(centres, least), schema), "cells")
    block = min(most, ceil(2 * count / cells))
    dealt = _dealt(celled, block).repartition(*KEYS).sortWithinPartitions(*KEYS)
    return dealt.mapInArrow(_linked(least), "id long, links long, root long")


def duplicate_groups(rows: DataFrame, least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row: links are pairs with a cosine of `least` or more."""
    every = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vector"))
    usable = finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    same = every.filter(usable).groupBy("vector")
    groups = stored(
        same.agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight")).filter("first IS NOT NULL").select(
            F.col("first").alias("id"), "weight", "vector", F.size("vector").alias("length")
        ),
        "vectors",
    )
    lengths = [r["length"] for r in groups.select("length").distinct().collect()]
    found = [_links(groups.filter(F.col("length") == n), least) for n in lengths]
    out = groups.select("vector", "id", "weight")
    linked = None
    if found:
        all_links = found[0]
        for more in found[1:]:
            all_links = all_links.union(more)
        linked = stored(all_links, "vector_links")
        counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
        labels = components(linked.select("id", "root"), "id", "root")
        out = out.join(counts, "id", "left").join(labels, "id", "left")
    else:
        out = out.withColumns({"links": F.lit(None).cast("long"), "component": F.lit(None).cast("long")})
    out = out.select(
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("links"),
        F.coalesce("component", "id").alias("component"),
    )
    joined = every.join(out, "vector", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )


def deduplicated(rows: DataFrame, least: float = 0.9) -> DataFrame:
    """The rows of one vector of each group, with their own columns."""
    gone = duplicate_groups(rows, least).filter(~F.col("kept")).select(F.col("vec_id").alias("_gone")).distinct()
    return rows.join(gone, rows["vec_id"] == gone["_gone"], "left_anti")
