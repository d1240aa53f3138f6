"""Hard-negative mining with a GNAT-style multiway tree over integer vectors.

For every anchor, its positives are the first `positives` other rows of its label by score (the integer inner product with
the anchor; higher first, ties to the smaller id, then the row). For each positive with score p, the negatives are the first
`negatives` rows of another label whose score n satisfies `low * p <= 100 * n <= high * p` (in percent, 30 and 90 by default).

Method (GNAT top level, exact leaves):

1. Split points: `SPLITS` rows chosen by farthest-first traversal from a sample of at most `SAMPLE` rows (a documented bound;
   every row is indexed all the same). Each row goes to the cell of its nearest split point.
2. Ranges: for every cell j and every split point i, the range [lo_ij, hi_ij] of the distances from split point i to the rows
   of cell j, summed from partial ranges of each task.
3. Bounds: for an anchor q, every row x of cell j scores within q.c_i +- |q| hi_ij for every i, so within
   [max_i (q.c_i - |q| hi_ij), min_i (q.c_i + |q| hi_ij)].
4. Positives: the cells of the highest upper bounds until they hold 6 rows of the anchor's label give an exact 5th score t; the
   other cells are visited only if their upper bound reaches t. Negatives: a cell is visited only if its range of bounds meets
   the union of the anchor's windows [low * p / 100, high * p / 100]; the other siblings are eliminated by that intersection.
5. Exact leaves: visited cells meet their anchors in blocks of at most `BLOCK` rows and `ANCHORS` anchors (a hot cell is cut
   into more blocks); scores are exact integer products, each block puts out its local first rows only, and the final order
   is taken over them.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part; vectors score only with vectors
of their own length; rows are rows (a repeated vec_id is another row, which may be a positive); a null vec_id sorts after every
id and is never an anchor; an anchor with fewer positives or a positive with fewer negatives gets all it has; a positive with a
negative score has no window; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import stored

SPLITS = 32  # split points of the top level
SAMPLE = 4096  # rows the split points are chosen from
BLOCK = 2048  # rows of a cell that meet anchors together
ANCHORS = 1024  # anchors that meet a block together
LAST_ID = 2**63 - 1  # where a null id sorts
EXACT = 2.0**53


def prepared(embeddings: DataFrame, scale: float = 256.0) -> DataFrame:
    """Valid rows with a row number, their label after the shift of every 7th id, floor(scale * x) components and whether
    the row is an anchor (column `_anchor`, if given)."""
    is_anchor = F.coalesce(F.col("_anchor"), F.lit(False)) if "_anchor" in embeddings.columns else F.lit(False)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("vid"),
        label.cast("long").alias("label"),
        F.size("embedding").alias("dim"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("vec"),
        is_anchor.alias("is_anchor"),
    )
    return stored(rows, "negatives-rows")


def _split_points(rows: DataFrame, splits: int, sample: int) -> dict[int, np.ndarray]:
    """Farthest-first split points for each length found in a bounded sample of rows chosen by hash."""
    picked = rows.orderBy(F.xxhash64("row", F.lit(7))).limit(sample).select("dim", "vec").toPandas()
    points = {}
    for dim, group in picked.groupby("dim"):
        data = np.stack([np.asarray(v, dtype=np.float64) for v in group["vec"]]) if dim else np.zeros((len(group), 0))
        chosen = [0]
        far = ((data - data[0]) ** 2).sum(axis=1)
        while len(chosen) < min(splits, len(data)):
            nxt = int(np.argmax(far))
            if far[nxt] == 0:
                break
            chosen.append(nxt)
            far = np.minimum(far, ((data - data[nxt]) ** 2).sum(axis=1))
        points[int(dim)] = data[chosen]
    return points


def _matrix(values: pd.Series, dim: int) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values]) if len(values) and dim else np.zeros((len(values), dim))


def _distances(data: np.ndarray, centres: np.ndarray) -> np.ndarray:
    sq = (data**2).sum(axis=1)[:, None] - 2 * data @ centres.T + (centres**2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(sq, 0.0))


def _products(left: np.ndarray, right: np.ndarray):
    """Exact integer inner products: in doubles where exact, in 64-bit integers where they fit, else in Python integers."""
    top = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    if top < EXACT:
        return np.rint(left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if top < 2.0**62 / 100:
        return left.astype(np.int64) @ right.astype(np.int64).T
    return left.astype(object) @ right.astype(object).T


def _vectors(values: pd.Series, dim: int) -> np.ndarray:
    if not len(values) or not dim:
        return np.zeros((len(values), dim), dtype=np.int64)
    return np.stack([np.asarray(v, dtype=np.int64) for v in values])


class _Index:
    """Split points, cells of every row and the distance ranges of every cell to every split point."""

    def __init__(self, rows: DataFrame, splits: int, sample: int) -> None:
        self.points = _split_points(rows, splits, sample)
        points = self.points

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                cell = np.full(len(batch), -1, dtype=np.int64)
                for dim, idx in batch.groupby("dim").indices.items():
                    if int(dim) in points:
                        cell[idx] = np.argmin(_distances(_matrix(batch["vec"].iloc[idx], int(dim)), points[int(dim)]), axis=1)
                batch["cell"] = cell
                yield batch

        schema = T.StructType(rows.schema.fields + [T.StructField("cell", T.LongType())])
        assigned = stored(rows.mapInPandas(assign, schema), "negatives-cells")
        counts = assigned.groupBy("dim", "cell", "label").agg(F.count(F.lit(1)).alias("n"))
        sizes = counts.groupBy("dim", "cell").agg(F.sum("n").alias("size"))
        self.counts = stored(counts.join(sizes, ["dim", "cell"]), "negatives-counts")
        blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(BLOCK))).cast("long")
        self.rows = stored(
            assigned.join(self.counts.select("dim", "cell", blocks.alias("blocks")).distinct(), ["dim", "cell"])
            .withColumn("rblock", F.pmod(F.xxhash64("row"), F.col("blocks")))
            .drop("blocks"),
            "negatives-blocks",
        )

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for (dim, cell), idx in batch.groupby(["dim", "cell"]).indices.items():
                    if int(dim) not in points:
                        continue
                    dist = _distances(_matrix(batch["vec"].iloc[idx], int(dim)), points[int(dim)])
                    lo, hi = dist.min(axis=0), dist.max(axis=0)
                    out += [(int(dim), int(cell), i, float(lo[i]), float(hi[i])) for i in range(len(lo))]
                yield pd.DataFrame(out, columns=["dim", "cell", "point", "lo", "hi"])

        ranges = (
            self.rows.select("dim", "cell", "vec")
            .mapInPandas(partial, "dim int, cell long, point int, lo double, hi double")
            .groupBy("dim", "cell", "point")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .collect()  # at most (lengths in the sample) x SPLITS x SPLITS rows
        )
        self.ranges: dict[int, dict[int, np.ndarray]] = {}
        for r in ranges:
            hi = self.ranges.setdefault(r.dim, {}).setdefault(r.cell, np.full(len(points[r.dim]), np.inf))
            hi[r.point] = r.hi

    def visits(self, anchors: DataFrame) -> DataFrame:
        """(anchor_row, dim, cell, lo, hi): every non-empty cell of an anchor's length with the bounds of its scores."""
        points, ranges = self.points, self.ranges

        def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for anchor_row, dim, vec in zip(batch["anchor_row"], batch["dim"], batch["avec"]):
                    dim = int(dim)
                    if dim not in points:
                        out.append((anchor_row, dim, -1, -np.inf, np.inf))
                        continue
                    q = np.asarray(vec, dtype=np.float64)
                    qc, norm = points[dim] @ q, float(np.sqrt(q @ q))
                    slack = 1.0 + 1e-9 * (np.abs(qc).max(initial=0) + norm * norm)
                    for cell, hi in ranges[dim].items():
                        lo_b = float(np.max(qc - norm * hi)) - slack
                        hi_b = float(np.min(qc + norm * hi)) + slack
                        out.append((anchor_row, dim, cell, lo_b, hi_b))
                yield pd.DataFrame(out, columns=["anchor_row", "dim", "cell", "lo", "hi"])

        schema = "anchor_row long, dim int, cell long, lo double, hi double"
        return stored(anchors.select("anchor_row", "dim", "avec").mapInPandas(bound, schema), "negatives-visits")

    def meet(self, visits: DataFrame, anchors: DataFrame, local, schema: str) -> DataFrame:
        """Run `local(rows, anchors)` on every block of a visited cell with the block of anchors that visit it."""
        visits = visits.select("anchor_row", "dim", "cell")
        per_cell = visits.groupBy("dim", "cell").agg(
            F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(ANCHORS))).cast("long").alias("ablocks")
        )
        blocks = self.counts.select(
            "dim", "cell", F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(BLOCK))).cast("long").alias("blocks")
        ).distinct()
        side = (
            visits.join(per_cell, ["dim", "cell"])
            .join(blocks, ["dim", "cell"])
            .join(anchors, ["anchor_row", "dim"])
            .withColumn("ablock", F.pmod(F.xxhash64("anchor_row"), F.col("ablocks")))
            .withColumn("rblock", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .drop("ablocks", "blocks")
        )
        rows = (
            self.rows.join(per_cell, ["dim", "cell"])
            .withColumn("ablock", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ablocks") - 1)))
            .select("dim", "cell", "rblock", "ablock", "row", "vid", "label", "vec")
        )
        keys = ["dim", "cell", "rblock", "ablock"]

        def run(block: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
            if block.empty or met.empty:
                return pd.DataFrame(columns=[f.split()[0] for f in schema.split(",")])
            dim = int(block["dim"].iloc[0])
            scores = _products(_vectors(met["avec"], dim), _vectors(block["vec"], dim))
            return local(block, met, scores)

        return rows.groupBy(*keys).cogroup(side.groupBy(*keys)).applyInPandas(run, schema)


def _first(scores, vids, rows, mask, count):
    """Indices of the first `count` entries under the mask by score (higher first), id, row."""
    picked = np.flatnonzero(mask)
    if scores.dtype == object:
        return np.asarray(sorted(picked, key=lambda j: (-scores[j], vids[j], rows[j]))[:count], dtype=np.int64)
    order = np.lexsort((rows[picked], vids[picked], -scores[picked]))
    return picked[order[:count]]


def mined(
    embeddings: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    splits: int = SPLITS,
    sample: int = SAMPLE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors chosen by a condition on
    the table's columns (see the module)."""
    rows = prepared(embeddings.withColumn("_anchor", anchors), scale)
    index = _Index(rows, splits, sample)
    anchor_table = stored(
        index.rows.where("is_anchor").select(
            F.col("row").alias("anchor_row"),
            F.col("vec_id").alias("anchor_id"),
            F.col("label").alias("anchor_label"),
            "dim",
            F.col("vec").alias("avec"),
        ),
        "negatives-anchors",
    )
    visits = index.visits(anchor_table).join(anchor_table.select("anchor_row", "anchor_label"), "anchor_row")
    same = index.counts.select("dim", "cell", F.col("label").alias("anchor_label"), F.col("n").alias("same"))
    totals = index.counts.select("dim", "cell", "size").distinct()
    visits = stored(
        visits.join(same, ["dim", "cell", "anchor_label"], "left").join(totals, ["dim", "cell"]).fillna(0, ["same"]),
        "negatives-visits-counted",
    )
    anchor_side = anchor_table.select("anchor_row", "anchor_label", "dim", "avec")

    def best_same(block: pd.DataFrame, met: pd.DataFrame, scores) -> pd.DataFrame:
        labels, vids, rws = block["label"].to_numpy(), block["vid"].to_numpy(), block["row"].to_numpy()
        out = []
        for a, (anchor_row, anchor_label) in enumerate(zip(met["anchor_row"], met["anchor_label"])):
            for j in _first(scores[a], vids, rws, (labels == anchor_label) & (rws != anchor_row), positives):
                out.append((anchor_row, int(rws[j]), int(vids[j]), int(scores[a][j])))
        return pd.DataFrame(out, columns=["anchor_row", "row", "vid", "score"])

    found_schema = "anchor_row long, row long, vid long, score long"
    # phase 1: cells of the highest upper bounds until they hold positives + 1 rows of the label
    ahead = Window.partitionBy("anchor_row").orderBy(F.desc("hi"), "cell").rowsBetween(Window.unboundedPreceding, -1)
    first_cells = visits.where(F.col("same") > 0).withColumn("before", F.coalesce(F.sum("same").over(ahead), F.lit(0)))
    first_cells = stored(first_cells.where(F.col("before") < positives + 1).drop("before"), "negatives-first")
    found = stored(index.meet(first_cells, anchor_side, best_same, found_schema), "negatives-found")
    kth = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vid", "row")
    bound = (
        found.withColumn("k", F.row_number().over(kth))
        .where(F.col("k") == positives)
        .select("anchor_row", F.col("score").alias("least"))
    )
    # phase 2: the other cells whose upper bound reaches the 5th score found (all of them if fewer were found)
    rest = (
        visits.where(F.col("same") > 0)
        .join(first_cells.select("anchor_row", "cell", F.lit(True).alias("done")), ["anchor_row", "cell"], "left")
        .join(bound, "anchor_row", "left")
        .where(F.col("done").isNull() & (F.col("least").isNull() | (F.col("hi") >= F.col("least"))))
        .drop("done", "least")
    )
    more = index.meet(rest, anchor_side, best_same, found_schema)
    pos = stored(
        found.unionByName(more)
        .withColumn("k", F.row_number().over(kth))
        .where(F.col("k") <= positives)
        .select("anchor_row", F.col("row").alias("positive_row"), F.col("score").alias("positive_score")),
        "negatives-positives",
    )

    # negatives: cells whose bounds meet the union of the anchor's windows
    windows = (
        pos.where(F.col("positive_score") >= 0)
        .groupBy("anchor_row")
        .agg(
            (F.min("positive_score") * F.lit(low / 100.0)).alias("wlo"),
            (F.max("positive_score") * F.lit(high / 100.0)).alias("whi"),
            F.collect_list(F.struct("positive_row", "positive_score")).alias("pos"),  # at most `positives` entries
        )
    )
    neg_cells = (
        visits.where(F.col("size") > F.col("same"))
        .join(windows, "anchor_row")
        .where((F.col("hi") >= F.col("wlo")) & (F.col("lo") <= F.col("whi")))
        .select("anchor_row", "dim", "cell", "lo", "hi")
    )
    neg_side = anchor_side.join(windows.select("anchor_row", "pos"), "anchor_row")

    def best_other(block: pd.DataFrame, met: pd.DataFrame, scores) -> pd.DataFrame:
        labels, vids, rws = block["label"].to_numpy(), block["vid"].to_numpy(), block["row"].to_numpy()
        out = []
        for a, (anchor_row, anchor_label, plist) in enumerate(zip(met["anchor_row"], met["anchor_label"], met["pos"])):
            other = labels != anchor_label
            s = scores[a]
            for p in plist:
                ps = int(p["positive_score"])
                mask = other & (low * ps <= 100 * s) & (100 * s <= high * ps)
                for j in _first(s, vids, rws, mask, negatives):
                    out.append((anchor_row, int(p["positive_row"]), ps, int(rws[j]), int(vids[j]), int(s[j])))
        return pd.DataFrame(
            out, columns=["anchor_row", "positive_row", "positive_score", "negative_row", "nvid", "negative_score"]
        )

    neg_schema = (
        "anchor_row long, positive_row long, positive_score long, negative_row long, nvid long, negative_score long"
    )
    negs = index.meet(neg_cells, neg_side, best_other, neg_schema)
    order = Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("negative_score"), "nvid", "negative_row")
    ranked = negs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    ids = rows.select("row", "vec_id")
    return (
        ranked.join(ids.toDF("anchor_row", "anchor_id"), "anchor_row")
        .join(ids.toDF("positive_row", "positive_id"), "positive_row")
        .join(ids.toDF("negative_row", "negative_id"), "negative_row")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            "negative_id",
            "positive_score",
            "negative_score",
        )
    )
