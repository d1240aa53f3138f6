"""Principal axes with the basis as a table against numpy's eigenvectors of the covariance."""

import random

import numpy as np
import pytest

from textmill.operators import pca


def fixture(n=150, v=25, seed=6):
    rng = random.Random(seed)
    x = np.zeros((n, v))
    for i in range(n):
        a, b = rng.gauss(0, 3), rng.gauss(0, 1.5)
        for j in range(v):
            if rng.random() < 0.4:
                x[i, j] = abs(a * (j % 5 == 0) + b * (j % 3 == 0) + rng.gauss(0, 0.3))
    x[7] = 0
    return x


def test_axes_and_projection_equal_numpy(spark):
    x = fixture()
    rows = [(i, j, float(x[i, j])) for i in range(len(x)) for j in range(x.shape[1]) if x[i, j]]
    entries = spark.createDataFrame(rows, "doc long, place long, value double")
    keys = spark.createDataFrame([(i,) for i in range(len(x))], "doc long")
    axes, mean, variances = pca.principal_axes(entries, len(x))
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    want = vectors[:, ::-1][:, :2]
    got = np.zeros((x.shape[1], 2))
    for r in axes.collect():
        got[r.place] = [r.a0, r.a1]
    for j in range(2):
        assert min(np.abs(got[:, j] - want[:, j]).max(), np.abs(got[:, j] + want[:, j]).max()) < 1e-6
    assert np.allclose(variances, values[::-1][:2], rtol=1e-8)
    coords = {r.doc: (r.p0, r.p1) for r in pca.projected(entries, keys, axes, mean).collect()}
    assert len(coords) == len(x)
    assert np.allclose([coords[i] for i in range(len(x))], centred @ got, atol=1e-8)


def test_empty_raises(spark):
    entries = spark.createDataFrame([], "doc long, place long, value double")
    with pytest.raises(ValueError):
        pca.principal_axes(entries, 0)


def test_rounds_do_not_shuffle_entries(spark):
    rows = [(d, p, 1.0 + (d * 7 + p) % 5) for d in range(300) for p in range(12)]
    x = np.zeros((300, 12))
    for d, p, v in rows:
        x[d, p] = v
    basis = np.random.default_rng(2).normal(size=(12, 3))
    held = pca.blocks.deal(spark.createDataFrame(rows, "doc long, place long, value double"))
    table = spark.createDataFrame([(p, [float(b) for b in basis[p]]) for p in range(12)], "place long, w array<double>")
    made = pca._multiplied(held, table, 3)
    above = made._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
    assert "CoGroups" in above and "REPARTITION" not in above
    got = {r.place: (r.r0, r.r1, r.r2) for r in made.collect()}
    assert np.allclose([got[p] for p in range(12)], x.T @ (x @ basis))
    held.release()
