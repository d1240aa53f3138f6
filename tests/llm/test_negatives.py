"""Hard negatives against a brute-force version over all pairs, on a table with awkward rows."""

import math
import random

from pyspark.sql import functions as F

from textmill.llm import negatives


def brute(rows):
    valid = []
    for i, (vec_id, vec, label, _) in enumerate(rows):
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        lab = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        valid.append((i, vec_id, lab, [math.floor(256 * x) for x in vec]))
    key = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    out = set()
    for ai, aid, alab, aq in valid:
        if aid is None or aid % 100 != 0:
            continue
        scored = [(sum(a * b for a, b in zip(aq, q)), vid, i, lab) for i, vid, lab, q in valid if len(q) == len(aq)]
        pos = sorted([s for s in scored if s[3] == alab and s[2] != ai], key=key)[:5]
        for ps, pid, _, _ in pos:
            negs = sorted([s for s in scored if s[3] != alab and 30 * ps <= 100 * s[0] <= 90 * ps], key=key)[:10]
            for rank, (ns, nid, _, _) in enumerate(negs, 1):
                out.add((aid, pid, rank, nid, ps, ns))
    return out


def table(n=700, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centres[i % 6]
        vec = [x + rng.gauss(0, 0.4) for x in c]
        rows.append((i, vec, rng.randrange(10), "x"))
    rows += [
        (1000, [float("nan")] + [0.1] * 7, 1, "x"),
        (1100, None, 1, "x"),
        (1200, [0.5] * 8, None, "x"),
        (1300, [0.5, None] + [0.5] * 6, 2, "x"),
        (1400, [0.3] * 4, 3, "x"),  # another length: scores with nothing of length 8
        (1500, [0.3] * 4, 3, "x"),
        (None, [0.2] * 8, 4, "x"),
        (200, rows[200][1], rows[200][2], "x"),  # a repeated id is another row
        (2000, [0.0] * 8, 5, "x"),
    ]
    return rows


def test_equals_brute_force(spark):
    rows = table()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, cell string").withColumn(
        "row", F.lit("clash")
    )
    got = {tuple(r) for r in negatives.mined(df, F.col("vec_id") % 100 == 0, splits=6, sample=300).collect()}
    assert got == brute(rows) and len(got) > 100


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mined(df, F.col("vec_id") % 100 == 0).count() == 0
