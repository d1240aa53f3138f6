"""Buckets of similar items: which rows meet, and how often they are shuffled."""

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import links, shingles


@pytest.mark.parametrize("share, ids", [(256, 16), (1, 3)])
def test_shared_buckets_are_the_distinct_rows_of_keys_with_several_ids(spark, monkeypatch, share, ids):
    monkeypatch.setattr(links, "HOT_SHARE", share)
    monkeypatch.setattr(links, "HOT_IDS", ids)
    rows = [(1, 5), (1, 5), (2, 7), (2, 8), (2, 7), (3, 9), (-4, -1), (-4, 6), (None, 1), (None, 2), (6, None)]
    rows += [(50, i % 20_500) for i in range(21_000)] + [(60 + i, i) for i in range(300)]
    made = spark.createDataFrame(rows, "key long, id long")
    wanted = sorted([(2, 7), (2, 8), (-4, -1), (-4, 6)] + [(50, i) for i in range(20_500)])
    assert sorted(tuple(r) for r in links._shared(made).collect()) == wanted
    assert links._shared(made.limit(0)).collect() == []


def test_buckets_are_shuffled_once(spark):
    made = spark.createDataFrame([(i % 900, i) for i in range(1000)], "key long, id long")
    plan = links._shared(made)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "HashAggregate" not in plan


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_runs_that_cross_batches(size):
    rows = sorted([(1, 5), (1, 5), (2, 7), (2, 8), (2, 7), (2, 9), (3, 1), (4, 4), (4, 4), (4, 4), (5, 1), (5, 2)], key=lambda r: r[0])
    batches = [
        pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[at : at + size]], pa.int64()) for i in (0, 1)], ["key", "id"])
        for at in range(0, len(rows), size)
    ]
    found = [tuple(r.values()) for b in links._met(iter(batches)) for r in b.to_pylist()]
    assert sorted(found) == [(2, 7), (2, 8), (2, 9), (5, 1), (5, 2)]


def test_lists_of_keys_are_dealt_without_a_row_for_each_key(spark, monkeypatch):
    lists = [(i, [i % 40, 1000 + i, 1000 + i]) for i in range(600)] + [(700, [5000, None]), (701, None), (None, [5000]), (702, []), (703, [5001])]
    made = spark.createDataFrame(lists * 2, "id long, keys array<long>")
    wanted = sorted((i % 40, i) for i in range(600))
    for share, gathered in ((256, 1 << 20), (256, 50), (1, 70)):
        monkeypatch.setattr(links, "HOT_SHARE", share)
        monkeypatch.setattr(links, "GATHERED", gathered)
        assert sorted(tuple(r) for r in links._shared(made).collect()) == wanted
    monkeypatch.setattr(links, "HOT_SHARE", 256)
    plan = links._shared(made)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Generate" not in plan


@pytest.mark.parametrize("size", [1, 2, 5, 100])
@pytest.mark.parametrize("gathered", [4, 16, 1 << 20])
def test_parts_that_cross_batches(monkeypatch, size, gathered):
    monkeypatch.setattr(links, "GATHERED", gathered)
    rows = [(0, [1, 2], [5, 6]), (0, [2], [7]), (3, [8, 8], [1, 1]), (3, [9], [1]), (3, [9], [2]), (4, [11], [1]), (7, [12, 12, 13], [3, 4, 5])]
    schema = pa.schema([("part", pa.int32()), ("keys", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))])
    table = pa.Table.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
    found = [tuple(r.values()) for b in links._met_parts(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    assert sorted(found) == [(2, 6), (2, 7), (9, 1), (9, 2), (12, 3), (12, 4)]


@pytest.mark.parametrize("values", [[], [3], [5, 5], [2**64 - 1, 0, 7, 0, 2**64 - 1]])
def test_distinct_values_are_sorted(values):
    assert shingles.distinct(np.array(values, np.uint64)).tolist() == sorted(set(values))
