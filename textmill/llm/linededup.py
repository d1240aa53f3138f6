"""Fuzzy line deduplication: of each group of similar lines of the corpus one stays.

A line is what stands between line feeds; blank lines are left alone. Its set holds the hashes of all runs of 12 bytes, A-Z in lower
case; a shorter line has one hash of the whole. Minima of 40 universal hashes in 10 bands of 4 find 99.5 % of the pairs with a
similarity of 0.8 and 99.9 % at 0.85. Equal lines share one digest and are one node. Pairs are drawn by rounds (see `links`) and confirmed by exact
Jaccard similarity; components come from a distributed union-find of star operations. The first line of a component, by
document id and line number, stays.

Cases: a null text has no lines, an empty one has one blank line; a text of which no line stays becomes empty, and its row stays; rows with
equal ids are taken for one document, so equal rows are decided alike; null ids count as one document and come first; an empty table gives
an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.expressions import let
from textmill.llm import shingles
from textmill.llm.common import stored
from textmill.llm.links import Threshold, similar_components

RUN = 12
BANDS, ROWS = 10, 4
SLICE = 1 << 17
#: digests that a task remembers, so as not to repeat the bands of a common line
SEEN = 200_000


def _units(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Slices of (place of the text, number of its first line, lines); long texts are cut at line feeds."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for place, text in enumerate(texts):
        at, line = 0, 0
        while at <= len(text):
            cut = len(text) if len(text) - at <= SLICE else text.find(b"\n", at + SLICE)
            cut = len(text) if cut < 0 else cut
            piece = text[at:cut]
            held.append((place, line, piece))
            size += len(piece) + 1
            line += piece.count(b"\n") + 1
            at = cut + 1
            if size > SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _lines(minima: shingles.Minima, units: list[tuple[int, int, bytes]], seen: dict[int, int] | None = None) -> tuple[np.ndarray, ...]:
    """Places, line numbers, digests, second digests of the lines that are not blank, which of them are new to `seen`, and band keys of these.

    seen: second digests by digest; new ones are added.
    """
    joined = b"\n".join(u[2] for u in units)
    raw = np.frombuffer(joined, np.uint8)
    feeds = np.flatnonzero(raw == np.uint8(10))
    starts, ends = np.concatenate(([0], feeds + 1)), np.concatenate((feeds, [len(raw)]))
    sizes = np.fromiter((len(u[2]) + 1 for u in units), np.int64, len(units))
    begins = np.cumsum(sizes) - sizes
    unit = np.searchsorted(begins, starts, "right") - 1
    firsts = np.searchsorted(starts, begins)
    numbers = np.arange(len(starts)) - firsts[unit] + np.array([u[1] for u in units])[unit]
    places = np.array([u[0] for u in units])[unit]
    some = ends > starts
    starts, ends, places, numbers = starts[some], ends[some], places[some], numbers[some]
    if len(starts):
        marks = (raw != np.uint8(32)) & ((raw < np.uint8(9)) | (raw > np.uint8(13)))
        bounds = np.stack([starts, ends], axis=1).ravel()
        full = np.logical_or.reduceat(np.append(marks, False), bounds)[::2]
        starts, ends, places, numbers = starts[full], ends[full], places[full], numbers[full]
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty.astype(bool), np.zeros((0, BANDS), np.int64)
    runs, stops, digest = shingles.char_windows(raw, starts, ends, RUN)
    digest = digest.view(np.int64)
    seen = {} if seen is None else seen
    names, firsts, which = np.unique(digest, return_index=True, return_inverse=True)
    firsts = np.sort(firsts[[name not in seen for name in names.tolist()]])  # in the order of the text, as the minima need them
    keys = minima.of_windows(runs, starts[firsts], stops[firsts]) if len(firsts) else np.zeros((0, BANDS), np.int64)
    marks = shingles.mix(keys.view(np.uint64).sum(axis=1, dtype=np.uint64)).view(np.int64)
    seen.update(zip(digest[firsts].tolist(), marks.tolist(), strict=True))
    second = np.array([seen[name] for name in names.tolist()], np.int64)[which]
    fresh = np.zeros(len(digest), bool)
    fresh[firsts] = True
    return places, numbers, digest, second, fresh, keys


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    minima = shingles.Minima(BANDS, ROWS)
    seen: dict[int, int] = {}
    for batch in batches:
        ids = batch["doc_id"]
        for units in _units(shingles.text_bytes(batch["text"])):
            places, numbers, digest, second, fresh, keys = _lines(minima, units, seen)
            if len(seen) > SEEN:
                seen.clear()
            counts = np.concatenate(([0], np.cumsum(fresh * BANDS))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(places)),
                    pa.array(numbers.astype(np.int32)),
                    pa.array(digest),
                    pa.array(second),
                    pa.ListArray.from_arrays(pa.array(counts), pa.array(keys.ravel())),
                ],
                ["doc_id", "line", "id", "mark", "keys"],
            )


def _texts(docs: DataFrame, lines: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """From digests to one text each, cut out of the document where the line comes first."""

    def of(ids: DataFrame) -> DataFrame:
        first = lines.join(ids, "id").groupBy("id").agg(F.min(F.struct("doc_id", "line")).alias("at"))
        wanted = first.groupBy(F.col("at.doc_id").alias("owner")).agg(
            F.collect_list(F.struct("id", F.col("at.line").alias("line"))).alias("wanted")
        )
        held = docs.dropDuplicates(["doc_id"]) if docs.columns != ["doc_id", "text"] else docs
        found = held.join(wanted, F.col("doc_id").eqNullSafe(F.col("owner")))
        cut = let(
            F.split("text", "\n", -1),
            lambda parts: F.transform("wanted", lambda w: F.struct(w["id"].alias("id"), F.get(parts, w["line"]).alias("text"))),
        )
        return found.select(F.explode(cut).alias("row")).select("row.*").dropDuplicates(["id"])

    return of


def removed_lines(docs: DataFrame, parts: int = 80, whole: int = 100) -> DataFrame:
    """(doc_id, removed): the numbers, from 0, of the lines that go from a document; documents that keep all are absent."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, line int, id long, mark long, keys array<long>"
    signed = stored(texts.filter(F.col("text").isNotNull()).mapInArrow(_signed, schema), "lines")
    lines = signed.select("doc_id", "line", "id", "mark")
    fresh = signed.filter(F.size("keys") > 0)
    labels = similar_components(
        fresh.select("id", "keys"),
        _texts(texts, lines),
        Threshold(parts, whole),
        partial(shingles.char_sets, size=RUN),
    )
    if labels is None:
        grouped = lines.withColumns({"group": F.col("id"), "same": F.col("mark")})
    else:
        grouped = lines.join(labels, "id", "left").withColumns(
            {"group": F.coalesce("component", "id"), "same": F.when(F.col("component").isNull(), F.col("mark")).otherwise(0)}
        )
    grouped = grouped.select("doc_id", "line", "group", "same")
    firsts = grouped.groupBy("group", "same").agg(
        F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("count")
    )
    firsts = stored(firsts.filter(F.col("count") > 1), "firsts")
    gone = grouped.join(firsts, ["group", "same"]).filter(~F.struct("doc_id", "line").eqNullSafe(F.col("first")))
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def decisions(docs: DataFrame, parts: int = 80, whole: int = 100) -> DataFrame:
    """doc_id, n_lines, n_kept and the numbers of the removed lines of every row."""
    gone = removed_lines(docs, parts, whole).withColumnRenamed("doc_id", "owner")
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    rows = docs.select("doc_id", F.coalesce(feeds + 1, F.lit(0)).cast("long").alias("n_lines"))
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("owner")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.select("doc_id", "n_lines", (F.col("n_lines") - F.size(removed)).alias("n_kept"), removed.alias("removed"))


def deduplicated(docs: DataFrame, parts: int = 80, whole: int = 100) -> DataFrame:
    """The documents without the removed lines; n_chars, where there is such a column, follows the text."""
    gone = removed_lines(docs, parts, whole).select(F.col("doc_id").alias("_owner"), F.col("removed").alias("_removed"))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_owner"]), "left")
    left = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains("_removed", i))
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    rows = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
