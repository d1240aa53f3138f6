"""Filtered dictionary and bag of words as long tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from textmill.functions import fixed
from textmill.functions.expressions import inline_rows, item_counts
from textmill.operators.ordering import global_running
from textmill.session import materialise

BOW = ArrayType(StructType([StructField("id", LongType()), StructField("cnt", LongType())]))


def token_statistics(df: DataFrame, tokens: str) -> DataFrame:
    """(token, df, cf) with one shuffle: tokens are counted inside the row first."""
    return _statistics(df, item_counts(F.col(tokens)))


def _statistics(df: DataFrame, counts: Column) -> DataFrame:
    rows = inline_rows(df, [], counts)
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("cnt").alias("cf"))


def filter_extremes(
    statistics: DataFrame,
    n_docs: int,
    no_below: int = 5,
    no_above: float = 0.5,
    keep_n: int | None = None,
    keep_tokens: Sequence[str] = (fixed.KEPT_TOKEN,),
) -> DataFrame:
    """Tokens in at least `no_below` and at most `no_above` * n_docs documents; `keep_n`, if given, keeps the most frequent."""
    kept = statistics.filter(
        F.col("df").between(no_below, int(no_above * n_docs)) | F.col("token").isin(list(keep_tokens))
    )
    return kept if keep_n is None else most_frequent(kept, keep_n)


def most_frequent(kept: DataFrame, keep_n: int) -> DataFrame:
    """The `keep_n` tokens with the highest document frequency, ties by token, ranked by range partitions."""
    ranked = global_running(kept, [F.desc("df"), F.asc("token")], rank="_rank")
    return ranked.filter(F.col("_rank") <= keep_n).drop("_rank")


def with_ids(kept: DataFrame) -> DataFrame:
    """Dense 0-based ids in token order."""
    ranked = global_running(kept, [F.asc("token")], rank="token_id")
    return ranked.withColumn("token_id", (F.col("token_id") - 1).cast("long"))


def build_dictionary(
    df: DataFrame,
    tokens: str,
    no_below: int = 0,
    no_above: float = 1.0,
    keep_n: int | None = None,
    keep_tokens: Sequence[str] = (fixed.KEPT_TOKEN,),
    n_docs: int | None = None,
) -> DataFrame:
    """(token_id, token, df, cf), stored, since every user of a dictionary reads it again. All documents count, empty ones too."""
    total = df.count() if n_docs is None else n_docs
    kept = filter_extremes(token_statistics(df, tokens), total, no_below, no_above, keep_n, keep_tokens)
    return materialise(with_ids(kept).select("token_id", "token", "df", "cf"))


def _counted(df: DataFrame, key: str, tokens: str, dictionary: DataFrame) -> DataFrame:
    """(key, cnt, columns of the dictionary): tokens are counted inside the row before the join, which the adaptive plan broadcasts by
    size. Rows with equal keys stay apart."""
    return inline_rows(df, [key], item_counts(F.col(tokens))).join(dictionary, "token")


def doc2bow(df: DataFrame, key: str, tokens: str, dictionary: DataFrame) -> DataFrame:
    """(key, token_id, cnt); unknown tokens drop out."""
    rows = _counted(df, key, tokens, dictionary.select("token", "token_id"))
    return rows.groupBy(key, "token_id").agg(F.sum("cnt").alias("cnt"))


def _changes(values: pa.Array) -> np.ndarray:
    """Where a run of equal values starts."""
    codes = values.dictionary_encode("encode").indices.to_numpy()
    return np.flatnonzero(np.concatenate(([len(codes) > 0], codes[1:] != codes[:-1])))


def _whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of a stream sorted by key that end where a key ends, with the start of every run of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        piece = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
        starts = _changes(piece[key])
        if len(starts) > 1:
            yield piece.slice(0, starts[-1]), starts[:-1]
        held = [piece.slice(starts[-1])]
    if held:
        yield held[0], np.zeros(1, np.int64)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def _summed(batch: pa.RecordBatch, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, run numbers and sums of the entries, sorted by run and id: equal ids of a run are one entry."""
    ids, counts = (batch[c].to_numpy() for c in ("token_id", "cnt"))
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
    firsts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (run[1:] != run[:-1]))))
    return firsts, run[firsts], np.add.reduceat(counts, firsts)


def _bows(key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, bow) from rows (key, token_id, cnt) sorted by key and id. Rows with equal keys are merged batch by batch, so that what is held of
    one key is no more than a few batches."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                firsts, _, sums = _summed(batch, _changes(batch[key]))
                kept = batch.take(pa.array(firsts))
                yield pa.RecordBatch.from_arrays([kept[key], kept["token_id"], pa.array(sums)], [key, "token_id", "cnt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, starts in _whole_runs(merged(batches), key):
            firsts, runs, sums = _summed(piece, starts)
            pairs = pa.StructArray.from_arrays([piece["token_id"].take(pa.array(firsts)), pa.array(sums)], ["id", "cnt"])
            listed = _lists(np.bincount(runs, minlength=len(starts)), pairs)
            yield pa.RecordBatch.from_arrays([piece[key].take(pa.array(starts)), listed], [key, "bow"])

    return run


def with_bow(df: DataFrame, key: str, tokens: str, dictionary: DataFrame) -> DataFrame:
    """Add `bow`, the array of (id, cnt) sorted by id; documents without known tokens get an empty one.

    Entries are shuffled once by key as numbers, sorted, and cut into arrays where the key changes.
    """
    rows = _counted(df, key, tokens, dictionary.select("token", "token_id")).filter(F.col(key).isNotNull())
    listed = rows.select(key, "token_id", "cnt").repartition(key).sortWithinPartitions(key, "token_id").mapInArrow(
        _bows(key), StructType([df.schema[key], StructField("bow", BOW)])
    )
    return df.join(listed, key, "left").withColumn("bow", F.coalesce("bow", F.array().cast(BOW)))


#: the place of the row itself behind its entries
_LAST = 2**31 - 1


def _sparse(size: int, others: list[str], output: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with their vector from (_row, _at, _value, _others) sorted by row and place; the last of a run is the row itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, starts in _whole_runs(batches, "_row"):
            ends = np.append(starts[1:], piece.num_rows) - 1
            at, value = (piece[c].to_numpy() for c in ("_at", "_value"))
            entry = at != _LAST
            sizes, n = ends - starts, len(starts)
            vector = pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(n, np.int8)),
                    pa.array(np.full(n, size, np.int32)),
                    _lists(sizes, pa.array(at[entry], pa.int32())),
                    _lists(sizes, pa.array(value[entry])),
                ],
                ["type", "size", "indices", "values"],
            )
            rows = piece["_others"].take(pa.array(ends))
            yield pa.RecordBatch.from_arrays([*[rows.field(f"c{i}") for i in range(len(others))], vector], [*others, output])

    return run


def with_vectors(
    df: DataFrame,
    tokens: str,
    dictionary: DataFrame,
    value: Column | None = None,
    output: str = "features",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add sparse vectors over the whole dictionary: the count of each token, or `value`, an expression over cnt, df and cf.

    `keep` names the columns that stay (all, if not given); leave out the tokens where nobody reads them again. Rows are
    stored with a number of their own, so rows with equal columns stay apart. The entries of the bag of words and the row itself meet in
    one shuffle by that number, and an Arrow step cuts the sorted entries into vectors. No list of tokens reaches the driver.
    """
    return vectors_of(counted_rows(df, tokens, keep), dictionary, value, output)


@dataclass(frozen=True)
class CountedRows:
    """Stored rows (_row, _others, _counts): their number, the columns that stay and the counts of their tokens."""

    held: DataFrame
    fields: tuple[StructField, ...]

    def statistics(self) -> DataFrame:
        """(token, df, cf), as `token_statistics` of the rows."""
        return _statistics(self.held, F.col("_counts"))


def counted_rows(df: DataFrame, tokens: str, keep: Sequence[str] | None = None) -> CountedRows:
    """The rows with their tokens counted once, for the statistics and the vectors."""
    others = df.columns if keep is None else list(keep)
    row = F.struct(F.lit(True).alias("held"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    held = materialise(
        df.select(F.monotonically_increasing_id().alias("_row"), row.alias("_others"), item_counts(F.col(tokens)).alias("_counts"))
    )
    return CountedRows(held, tuple(StructField(f.name, f.dataType) for f in df.select(*others).schema.fields))


def vectors_of(rows: CountedRows, dictionary: DataFrame, value: Column | None = None, output: str = "features") -> DataFrame:
    """The vectors of counted rows (see `with_vectors`)."""
    held, fields = rows.held, rows.fields
    size = dictionary.agg(F.coalesce(F.max("token_id") + 1, F.lit(0)).alias("n")).first()["n"]
    cells = inline_rows(held, ["_row"], F.col("_counts")).join(dictionary.select("token", "token_id", "df", "cf"), "token")
    entries = cells.select(
        "_row",
        F.col("token_id").cast("int").alias("_at"),
        (F.col("cnt") if value is None else value).cast("double").alias("_value"),
        F.lit(None).cast(held.schema["_others"].dataType).alias("_others"),
    )
    entered = entries.union(held.select("_row", F.lit(_LAST).alias("_at"), F.lit(0.0).alias("_value"), "_others"))
    others = [f.name for f in fields]
    return entered.repartition("_row").sortWithinPartitions("_row", "_at").mapInArrow(
        _sparse(int(size), others, output), StructType([*fields, StructField(output, VectorUDT())])
    )


def only_top_words(
    df: DataFrame, key: str, tokens: str, listed: DataFrame, output: str, how: str = "left_semi"
) -> DataFrame:
    """Keep only listed tokens, in order, for a list of any size: semi join and re-collection per row."""
    numbered = F.transform(tokens, lambda t, i: F.struct(i.alias("_pos"), t.alias("token")))
    placed = inline_rows(df, [key], numbered)
    kept = placed.join(listed.select("token"), "token", how)
    again = kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_pos", "token"))).alias("_kept"))
    joined = df.join(again, key, "left")
    values = F.coalesce(F.transform("_kept", lambda x: x["token"]), F.array().cast("array<string>"))
    return joined.withColumn(output, values).drop("_kept")


def without_listed(df: DataFrame, key: str, tokens: str, listed: DataFrame, output: str) -> DataFrame:
    """Drop listed tokens, such as stop words, for a list of any size."""
    return only_top_words(df, key, tokens, listed, output, "left_anti")
