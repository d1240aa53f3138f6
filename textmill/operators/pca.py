"""Principal components of sparse rows by subspace iteration, with the basis as a table.

The basis is a table (place, b0 .. b{k-1}) of k = 8 columns: only k x k matrices reach the driver. One round:

1. s = X B per row, X^T s per place: the rows lie in blocks (`operators/blocks.py`), gathered once; a block meets the basis once per
   place of its own, and one pass gives its rows' s and its sum of x s per place, which are then summed over the blocks.
2. M = Xc^T Xc B = X^T s - n mu (mu^T B): centring is the same correction for every place, from the mean table and k sums.
3. G = B^T M and C = M^T M, both k x k, are aggregates. The Ritz values (eigenvalues of G) estimate the variances; M is
   orthonormalised by Cholesky-QR (B' = M L^-T with C = L L^T), a k x k product done in column expressions.
4. Stop when the leading Ritz values change by less than `tolerance` (relative); raise after `max_rounds` rounds without that.

Cases: rows without entries count as zero vectors (they move the mean); a basis wider than the rank of the data drops the
directions that vanish; fewer places than axes gives zero axes for the rest; an empty table raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators import blocks
from textmill.operators.blocks import Blocks, Chunk, Met
from textmill.session import discard, materialise


def _gaussian(seed: int, place: Column, i: int) -> Column:
    """A standard normal draw from a hash of (seed, place, i), by Box-Muller over two hashed uniforms."""

    def unit(salt: str) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), place, F.lit(i), F.lit(salt))), 1, 13), 16, 10)
        return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))

    return F.sqrt(F.lit(-2.0) * F.log(unit("a"))) * F.cos(F.lit(2 * np.pi) * unit("b"))


def _combined(table: DataFrame, source: list[str], matrix: np.ndarray, target: str) -> DataFrame:
    """(place, target0 ..): each row's source columns times a small matrix held as literals."""
    columns = [
        sum((F.col(c) * F.lit(float(matrix[a, j])) for a, c in enumerate(source)), F.lit(0.0)).alias(f"{target}{j}")
        for j in range(matrix.shape[1])
    ]
    return table.select("place", *columns)


def _orthonormal(gram: np.ndarray, floor: float = 1e-12) -> np.ndarray:
    """T with (M T)^T (M T) = I for C = M^T M: Cholesky where C is well conditioned, else its eigenvectors above the floor."""
    try:
        lower = np.linalg.cholesky(gram)
        if np.min(np.diag(lower)) > floor * max(np.max(np.diag(lower)), 1.0):
            return np.linalg.inv(lower).T
    except np.linalg.LinAlgError:
        pass
    values, vectors = np.linalg.eigh(gram)
    kept = values > floor * max(values.max(initial=0.0), 1e-300)
    return vectors[:, kept] / np.sqrt(values[kept])


def _products(left: DataFrame, lp: list[str], right: DataFrame, rp: list[str]) -> np.ndarray:
    """sum over places of left[a] * right[b], a small matrix."""
    sums = [F.sum(F.col(f"l.{a}") * F.col(f"r.{b}")) for a in lp for b in rp]
    row = left.alias("l").join(right.alias("r"), "place").agg(*sums).first()
    return np.array([0.0 if v is None else v for v in row], dtype=np.float64).reshape(len(lp), len(rp))


def _multiplied(held: Blocks, basis: DataFrame, width: int) -> DataFrame:
    """(place, r0 .. r{width-1}): X^T (X B) of the rows X and the basis (place, w array<double>)."""

    def local(chunks: Iterator[Chunk], met: Met) -> pa.Table:
        size = met.weights.shape[1]
        out = np.zeros_like(met.weights)
        for chunk in chunks:
            row = chunk.rows()
            for i in range(width):
                scores = np.bincount(row, chunk.value * met.weights[i, chunk.at], len(chunk.sizes))
                out[i] += np.bincount(chunk.at, chunk.value * scores[row], size)
        return pa.table({"place": met.place} | {f"r{i}": out[i, met.at] for i in range(width)})

    partial = held.each(basis, width, local, "place long, " + ", ".join(f"r{i} double" for i in range(width)))
    return partial.groupBy("place").agg(*[F.sum(f"r{i}").alias(f"r{i}") for i in range(width)])


def principal_axes(
    entries: DataFrame,
    n_rows: int,
    n_axes: int = 2,
    block: int = 8,
    seed: int = 0,
    tolerance: float = 1e-9,
    max_rounds: int = 300,
) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(axes (place, a0 .. a{n_axes-1}), mean (place, mean), variances) of the rows given as (doc, place, value) entries;
    n_rows counts every row, those without entries too. The entries are read twice: hand in stored ones."""
    if n_rows == 0:
        raise ValueError("no rows")
    entries = entries.select("doc", F.col("place").cast("long").alias("place"), F.col("value").cast("double"))
    mean = materialise(entries.groupBy("place").agg((F.sum("value") / F.lit(float(n_rows))).alias("mean")))
    n_places = mean.count()
    k = max(min(block, n_places), 0)
    if k == 0:
        raise ValueError("no entries")
    basis_cols = [f"b{i}" for i in range(k)]
    raw = mean.select("place", *[_gaussian(seed, F.col("place"), i).alias(f"b{i}") for i in range(k)])
    turn = _orthonormal(_products(raw, basis_cols, raw, basis_cols))
    basis = materialise(_combined(raw, basis_cols, turn, "b"))
    before = None
    held = blocks.deal(entries.where(F.col("doc").isNotNull()))
    for _ in range(max_rounds):
        width = len([c for c in basis.columns if c != "place"])
        basis_cols = [f"b{i}" for i in range(width)]
        centre = mean.join(basis, "place").agg(*[F.sum(F.col("mean") * F.col(c)) for c in basis_cols]).first()
        moved = _multiplied(held, basis.select("place", F.array(*basis_cols).alias("w")), width)
        moved = materialise(
            mean.join(moved, "place", "left").select(
                "place",
                *[
                    (F.coalesce(F.col(f"r{i}"), F.lit(0.0)) - F.lit(float(n_rows * (centre[i] or 0.0))) * F.col("mean")).alias(
                        f"m{i}"
                    )
                    for i in range(width)
                ],
            )
        )
        moved_cols = [f"m{i}" for i in range(width)]
        ritz, rotation = np.linalg.eigh(_products(basis, basis_cols, moved, moved_cols))
        order = np.argsort(ritz)[::-1]
        ritz, rotation = ritz[order], rotation[:, order]
        leading = ritz[: min(n_axes, width)]
        if before is not None and len(before) == len(leading) and np.all(
            np.abs(leading - before) <= tolerance * np.maximum(np.abs(leading), 1e-300)
        ):
            axes = _combined(basis, basis_cols, rotation[:, : min(n_axes, width)], "a")
            missing = [F.lit(0.0).alias(f"a{j}") for j in range(min(n_axes, width), n_axes)]
            held.release()
            axes = materialise(axes.select("*", *missing))
            discard(basis)
            discard(moved)
            return axes, mean, np.concatenate([leading, np.zeros(n_axes - len(leading))]) / n_rows
        before, last = leading, basis
        basis = materialise(_combined(moved, moved_cols, _orthonormal(_products(moved, moved_cols, moved, moved_cols)), "b"))
        discard(last)
        discard(moved)
    held.release()
    raise RuntimeError(f"principal axes did not converge in {max_rounds} rounds")


def projected(entries: DataFrame, keys: DataFrame, axes: DataFrame, mean: DataFrame, n_axes: int = 2) -> DataFrame:
    """(doc, p0 .. p{n_axes-1}): every row's coordinates on the axes, centred; rows without entries too."""
    names = [f"a{j}" for j in range(n_axes)]
    shift = mean.join(axes, "place").agg(*[F.sum(F.col("mean") * F.col(a)) for a in names]).first()
    sums = entries.join(axes, "place").groupBy("doc").agg(
        *[F.sum(F.col("value") * F.col(a)).alias(f"p{j}") for j, a in enumerate(names)]
    )
    return keys.select("doc").join(sums, "doc", "left").select(
        "doc", *[(F.coalesce(f"p{j}", F.lit(0.0)) - F.lit(float(shift[j] or 0.0))).alias(f"p{j}") for j in range(n_axes)]
    )
