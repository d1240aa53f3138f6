"""Sharding, mixing, packing and exact search against brute force."""

import random
import zlib
from collections import Counter, defaultdict
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import mixing, packing, queries, sharding, topk

SCHEMA = "doc_id long, text string, source string, place string, size string, shard string"


def documents(spark, n=500, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 4 + ["b", "c", "Zé", None, ""])
        text = rng.choice([None, "", " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(1, 60))), "same text"])
        rows.append((i, text, source, "p", "q", "r"))
    rows += [rows[0], rows[0], (None, "null id", "b", "p", "q", "r"), (n, "x " * 5000, "long", "p", "q", "r")]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_shards_are_even_and_carry_the_mixture(spark):
    docs, rows = documents(spark)
    got = sharding.interleaved_shards(docs, shards=7).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    sizes = [len(v) for v in by_shard.values()]
    assert len(by_shard) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by_shard.values())
    share = Counter(r[2] for r in rows)
    for members in by_shard.values():
        for source, count in Counter(r.source for r in members).items():
            assert abs(count - share[source] * len(members) / len(rows)) <= len(share)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        raw = texts[r.doc_id]
        assert r.size == 16 + len((raw or "").encode())
        assert r.text_crc32 == (None if raw is None else zlib.crc32(raw.encode()))
    again = sharding.interleaved_shards(docs.repartition(5), shards=7).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert sharding.interleaved_shards(docs.limit(0)).count() == 0
    assert sharding.interleaved_shards(docs.limit(3), shards=40).count() == 3


def filled(sizes, weights, most):
    """Targets by raising the shared level source after source."""
    total, open_, target = sum(sizes.values()), dict(weights), {}
    while open_:
        level = (total - sum(target.values())) / sum(open_.values())
        over = [s for s in open_ if most * sizes[s] < level * open_[s]]
        if not over:
            return target | {s: level * w for s, w in open_.items()}
        for s in over:
            target[s] = most * sizes[s]
            del open_[s]
    return target


def test_targets_and_copies(spark):
    docs, rows = documents(spark)
    got = mixing.decisions(docs).collect()
    words = lambda t: len((t or "").split())
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += words(r[1])
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = filled(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    source = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        rate = r.target / r.source_size
        assert r.copies in (floor(rate), floor(rate) + 1) and r.copies <= 3
    taken = Counter()
    for r in mixing.mixed(docs).collect():
        taken[r.doc_id] += 1
    copies = Counter()
    for r in got:
        copies[r.doc_id] += r.copies
    assert taken == +copies
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.decisions(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_a_source_without_words_has_no_target(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.target, r.copies) for r in mixing.decisions(docs).collect()] == [(0.0, 0)] * 2


def brute_fit(sizes, sources, clusters, capacity):
    bins = []
    placed = [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = [
            b
            for b in range(len(bins))
            if bins[b][0] >= sizes[i] and sources[i] not in bins[b][1] - {-1} and clusters[i] not in bins[b][2] - {-1}
        ]
        best = min(fit, key=lambda b: (bins[b][0], b), default=None)
        if best is None:
            bins.append([capacity, set(), set()])
            best = len(bins) - 1
        bins[best][0] -= sizes[i]
        bins[best][1].add(sources[i])
        bins[best][2].add(clusters[i])
        placed[i] = best
    return placed


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_brute_force(seed):
    rng = random.Random(seed)
    n = 200
    sizes = [rng.choice([0, 1, 5, 50, 100, rng.randrange(100)]) for _ in range(n)]
    sources = [rng.choice([-1, 0, 0, 1, 2, 3]) for _ in range(n)]
    clusters = [rng.choice([-1, rng.randrange(40)]) for _ in range(n)]
    assert packing.best_fit(sizes, sources, clusters, 100) == brute_fit(sizes, sources, clusters, 100)


def test_bins_hold_whole_documents_without_conflicts(spark):
    docs, rows = documents(spark)
    got = packing.packed(docs, capacity=64, shard_rows=100).collect()
    words = Counter()
    for r in got:
        words[r.doc_id] += r.size
    want = Counter()
    for r in rows:
        want[r[0]] += len((r[1] or "").split())
    assert +words == +want and {r.doc_id for r in got} == {r[0] for r in rows}
    bins = defaultdict(list)
    for r in got:
        bins[r.bin].append(r)
    for members in bins.values():
        assert sum(r.size for r in members) <= 64
        for name in ("source", "cluster"):
            held = [r[name] for r in members if r[name] is not None]
            assert len(held) == len(set(held))
    assert packing.packed(docs.limit(0)).count() == 0


def test_near_copies_from_different_sources_never_share_a_bin(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    copies = [text, text.replace("w30 ", "other "), text.replace(" ", "  ", 1), text + ".", text.upper(), text + " more"]
    rows = [(None if i == 2 else i, t, None if i % 2 else f"s{i}", "en", 9) for i, t in enumerate(copies)]
    rows += [(7, "É une deux", "a", "fr", 9), (7, "é UNE deux", "b", "fr", 9), (8, "  ", "c", "fr", 9), (9, None, "d", "fr", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op6_packing(spark, str(tmp_path)).collect()
    long = [r for r in got if r["size"] >= 60]
    assert len(got) == len(rows) and len(long) == len(copies)
    assert len({r.bin for r in long}) == len(long) and len({r.cluster for r in long}) == 1
    short = [r for r in got if r["size"] == 3]
    assert len({r.bin for r in short}) == 2 and len({r.cluster for r in short}) == 1
    assert [r.cluster for r in got if r.doc_id == 9] == [None]


def test_top_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=7).round(1).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300, None), (320, [None] * 7), (340, [float("nan")] * 7), (360, [1.0, 2.0]), (380, [3.0, 4.0]), (400, []), (None, rows[0][1])]
    rows += [rows[20], rows[21]]
    df = spark.createDataFrame([(i, v, 5) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in topk.top_scores(df, F.col("vec_id") % 20 == 0, k=20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    usable = {i: np.floor(64 * np.array(v, float)).astype(int) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for q, x in usable.items():
        if q % 20 == 0:
            scores = sorted((-int(x @ y), i) for i, y in usable.items() if i != q and len(x) == len(y))[:20]
            want[q] = [(n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert {q: sorted(v) for q, v in got.items()} == {q: v for q, v in want.items() if v}
    assert topk.top_scores(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_huge_components_are_scored_in_integers(spark):
    df = spark.createDataFrame([(0, [2.0**30, 1.0]), (1, [2.0**20, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = topk.top_scores(df, F.col("vec_id") == 0, k=5).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 1, 2**36 * 2**26 + 4096), (2, 2, 2**36 * 64 + 4096)]
