"""Components of similar items from hash buckets, without pairing the members of a bucket with each other.

Items that share a bucket are candidates. A bucket of m members has m^2 / 2 pairs, so the search goes in two rounds and never asks
about two items that are already in one component:

1. Each bucket is compared with its hub, the member with the largest buckets altogether. The text that others were edited from
   collides with most of them and so becomes the hub. This costs at most one pair for a member and bucket.
2. In buckets that still hold several components, the members outside their largest component are compared with the others, block by
   block: on signatures first, then, within the same block, on full sets. A pair is looked at in the first band that it shares,
   and a member asks another component only until it finds one link to it. Blocks put out links, not candidates, and a text goes
   to a block, not to a pair.

So no link between components is missed among items that share a bucket, up to the error of the estimate, which is allowed
4 standard deviations (one link in 30,000 at the threshold). Rounds work on tables below the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import shingles
from textmill.llm.common import stored
from textmill.llm.components import components

#: members of one bucket on either side of a block
BLOCK = 512
KEYS = ["key", "part", "other_part"]
#: rows that are turned into arrays at a time
PIECE = 2048
#: a key is hot that has this many ids among the ids of which one in `HOT_SHARE` is taken: 4,096 ids or so, so hot keys are few
HOT_SHARE, HOT_IDS = 256, 16
#: parts that the bucket rows are dealt to by key, and the rows that a task gathers before it deals them
PARTS, GATHERED = 4096, 1 << 20
#: minima of the signatures that candidates are compared on; they are made for candidates only
CHECKS = 192


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least `parts` / `whole`, estimated on `minima` hashes."""

    parts: int
    whole: int
    minima: int = CHECKS

    @property
    def least_agreeing(self) -> int:
        """Equal minima below which a link is excluded."""
        t = self.parts / self.whole
        return int(self.minima * (t - 4 * sqrt(t * (1 - t) / self.minima)))

    def met(self, one: np.ndarray, other: np.ndarray) -> bool:
        if min(len(one), len(other)) * self.whole < self.parts * max(len(one), len(other)):
            return False
        common = shingles.shared(one, other)
        return common * self.whole >= self.parts * (len(one) + len(other) - common)


def _matrix(column) -> np.ndarray:
    """Equal-sized binary values as rows."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _described(sets: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The exact size of each candidate's set, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = shingles.Minima(1, CHECKS, seed=71)
        for batch in batches:
            texts = shingles.text_bytes(batch["text"])
            for first, last in shingles.slices(texts):
                found = list(sets(texts[first:last]))
                sizes = np.array([len(s) for s in found], np.int64)
                full = np.flatnonzero(sizes)
                if not len(full):
                    continue
                _, sigs = minima.of([found[i] for i in full])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(first, last - first).take(pa.array(full)),
                        pa.array(sizes[full]),
                        pa.array([row.tobytes() for row in sigs], pa.binary()),
                    ],
                    ["id", "n", "sig"],
                )

    return run


def _likely(threshold: Threshold) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                agreeing = (_matrix(batch["hub_sig"]) == _matrix(batch["sig"])).sum(axis=1)
                yield batch.filter(pa.array(agreeing >= threshold.least_agreeing)).select(["hub", "id"])

    return run


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys of a sorted stream; a run is held whole, so it must be bounded."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch[k].to_numpy(zero_copy_only=False) for k in keys])
        cuts = np.concatenate(([0], np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(columns[:, start])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _aligned(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Pieces of a sorted stream that end where a key ends, with the bounds of the runs of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in (b.slice(at, PIECE) for b in batches for at in range(0, b.num_rows, PIECE)):
        piece = pa.Table.from_batches([*held, batch]).combine_chunks()
        columns = np.stack([piece[k].to_numpy() for k in keys])
        starts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        if not len(starts):
            held = piece.to_batches()
            continue
        yield piece.slice(0, starts[-1]), np.concatenate(([0], starts))
        held = piece.slice(starts[-1]).to_batches()
    if held:
        piece = pa.Table.from_batches(held).combine_chunks()
        yield piece, np.array([0, piece.num_rows])


class _Members:
    """The columns of a piece as arrays, and the likely pairs of its runs."""

    def __init__(self, threshold: Threshold, rows: pa.Table) -> None:
        self.threshold = threshold
        self.key, self.ids, self.labels, self.sizes, self.main = (rows[c].to_numpy() for c in ("key", "id", "label", "n", "main"))
        self.outside = rows["outside"].to_numpy().astype(bool)
        self.minima = _matrix(rows["sig"])
        self.keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(len(self.ids), -1)

    def sides(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a run that ask, and rows that are asked."""
        outside = self.outside[start:end]
        return np.flatnonzero(outside) + start, np.flatnonzero(~outside) + start

    def likely(self, i: int, others: np.ndarray) -> np.ndarray:
        """Rows among the others that row i may have a link with, best estimates first."""
        t = self.threshold
        size = self.sizes[others]
        fit = others[
            (self.labels[others] != self.labels[i])
            & ((self.labels[others] == self.main[i]) | (self.ids[others] > self.ids[i]))
            & (np.minimum(size, self.sizes[i]) * t.whole >= t.parts * np.maximum(size, self.sizes[i]))
        ]
        if not len(fit):
            return fit
        agreeing = (self.minima[fit] == self.minima[i]).sum(axis=1)
        likely = agreeing >= t.least_agreeing
        fit, agreeing = fit[likely], agreeing[likely]
        common = self.keys[fit] == self.keys[i]
        first = self.keys[i][common.argmax(axis=1)] == self.key[i]  # the first band that both share is this bucket's
        return fit[first][np.argsort(-agreeing[first], kind="stable")]


def _asked(threshold: Threshold) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each block the rows that take part in any likely pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, bounds in _aligned(batches, KEYS):
            members = _Members(threshold, piece)
            keep = np.zeros(piece.num_rows, bool)
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                asking, others = members.sides(start, end)
                for i in asking if len(others) else ():
                    found = members.likely(i, others)
                    if len(found):
                        keep[i] = True
                        keep[found] = True
            yield from piece.filter(pa.array(keep)).combine_chunks().to_batches()

    return run


def _block_links(threshold: Threshold, sets: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Exact links of each block; the sets of small blocks are made together, of large ones those that are asked are held, the others go by."""

    def linked(members: _Members, asking: Iterator[tuple[int, np.ndarray]], held: dict[int, np.ndarray], others: np.ndarray, out: tuple) -> None:
        for i, own in asking:
            joined = set()
            for j in members.likely(i, others).tolist():
                if members.labels[j] not in joined and threshold.met(held[j], own):
                    joined.add(members.labels[j])
                    out[0].append(int(members.ids[j]))
                    out[1].append(int(members.ids[i]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, bounds in _aligned(batches, KEYS):
            members = _Members(threshold, piece)
            texts = piece["text"]
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
            out: tuple[list[int], list[int]] = ([], [])
            made: dict[int, np.ndarray] = {}
            upto = 0
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                asking, others = members.sides(start, end)
                if not len(asking) or not len(others):
                    continue
                before = sizes[start - 1] if start else 0
                if end > upto:  # sets of the runs that begin here, as far as they are no longer than a slice together
                    whole = bounds[np.searchsorted(bounds, np.searchsorted(sizes, before + shingles.SLICE, "right"), "right") - 1]
                    made, upto = {}, max(upto, int(whole))
                    if end <= upto:
                        names, firsts = np.unique(members.ids[start:upto], return_index=True)
                        made = dict(zip(names.tolist(), sets(shingles.text_bytes(texts.take(firsts + start))), strict=True))
                if end <= upto:
                    ids = members.ids
                    linked(members, ((i, made[ids[i]]) for i in asking.tolist()), {j: made[ids[j]] for j in others.tolist()}, others, out)
                else:
                    held = dict(zip(others.tolist(), sets(shingles.text_bytes(texts.take(others))), strict=True))
                    linked(members, zip(asking.tolist(), sets(shingles.text_bytes(texts.take(asking))), strict=True), held, others, out)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["hub", "id"])

    return run


def _confirmed(threshold: Threshold, sets: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = ([], [])
            names, ids, roles = (batch[c].to_numpy() for c in ("hub", "id", "role"))
            for i, found in enumerate(sets(shingles.text_bytes(batch["text"]))):
                if roles[i] == 0:
                    hub, held = names[i], found
                elif names[i] == hub and threshold.met(held, found):
                    out[0].append(int(hub))
                    out[1].append(int(ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["hub", "id"])

    return run


def exact_links(pairs: DataFrame, texts: DataFrame, threshold: Threshold, sets: Callable) -> DataFrame:
    """The pairs (hub, id) whose full sets meet the threshold, from texts (id, text).

    Rows stream in the order of the hubs; a task holds one hub's set. A hub with many partners is dealt over as many salts as
    there are shuffle partitions.
    """
    salts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    members = pairs.join(texts, "id").select("hub", "salt", "id", "text", F.lit(1).alias("role"))
    hubs = pairs.select(F.col("hub").alias("id"), "salt").distinct().join(texts, "id")
    rows = members.union(hubs.select(F.col("id").alias("hub"), "salt", "id", "text", F.lit(0).alias("role")))
    placed = rows.repartition(salts, "hub", "salt").sortWithinPartitions("hub", "salt", "role")
    return placed.mapInArrow(_confirmed(threshold, sets), "hub long, id long")


def _several(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """The distinct rows of keys with several ids, from rows sorted by key."""
    again = keys[1:] == keys[:-1]
    some = (np.append(False, again) | np.append(again, False))[: len(keys)]
    keys, ids = keys[some], ids[some]
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))[: len(keys)]
    keys, ids = keys[new], ids[new]
    again = keys[1:] == keys[:-1]
    some = (np.append(False, again) | np.append(again, False))[: len(keys)]
    return pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(ids[some])], ["key", "id"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct rows of keys with several ids, from a stream sorted by key; the distinct ids of one key are held between batches."""
    last, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate((last, batch["key"].to_numpy()))
        ids = np.concatenate((held, batch["id"].to_numpy()))
        end = len(keys) - int((keys[::-1] != keys[-1]).argmax()) if keys[0] != keys[-1] else 0
        held = np.unique(ids[end:])
        last = np.full(len(held), keys[-1])
        if end:
            yield _several(keys[:end], ids[:end])
    if len(held):
        yield _several(last, held)


def _dealt(hot: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(part, keys, ids): the rows of (id, keys) but those of the hot keys (sorted), gathered by parts that the key decides."""

    def deal(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        parts = (shingles.mix(keys.view(np.uint64)) % shingles.U(PARTS)).astype(np.uint16)
        order = np.argsort(parts, kind="stable")
        sizes = np.bincount(parts, minlength=PARTS)
        some = np.flatnonzero(sizes)
        bounds = pa.array(np.concatenate(([0], np.cumsum(sizes[some]))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(bounds, pa.array(x[order])) for x in (keys, ids)]
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *lists], ["part", "keys", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0
        for batch in batches:
            lists = batch["keys"]
            ids = batch["id"].take(pc.list_parent_indices(lists))
            flat = pc.list_flatten(lists)
            if flat.null_count or ids.null_count:
                whole = pa.Table.from_arrays([flat, ids], ["keys", "ids"]).drop_null()
                flat, ids = whole["keys"].combine_chunks(), whole["ids"].combine_chunks()
            keys, ids = flat.to_numpy(zero_copy_only=False), ids.to_numpy(zero_copy_only=False)
            if len(hot):
                cold = hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] != keys
                keys, ids = keys[cold], ids[cold]
            gathered.append((keys, ids))
            count += len(keys)
            if count >= GATHERED:
                yield deal(*(np.concatenate(x) for x in zip(*gathered, strict=True)))
                gathered, count = [], 0
        if count:
            yield deal(*(np.concatenate(x) for x in zip(*gathered, strict=True)))

    return run


def _met_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`_met` of (part, keys, ids), from a stream sorted by part; the rows of one part are held."""

    def several(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        keys, ids = (np.concatenate([p[c].flatten().to_numpy() for p in pieces]) for c in ("keys", "ids"))
        order = np.argsort(keys)
        return _several(keys[order], ids[order])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch["part"].to_numpy()
        for start, end in _spans(parts, batch["keys"].value_lengths().to_numpy()):
            if held and held[-1]["part"][-1].as_py() != parts[start]:
                yield several(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield several(held)


def _spans(parts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that end where a part ends, of about `GATHERED` / 4 keys if the parts are smaller."""
    ends = np.append(np.flatnonzero(parts[1:] != parts[:-1]) + 1, len(parts))
    sums = np.cumsum(sizes)
    start = 0
    while start < len(parts):
        before = sums[start - 1] if start else 0
        full = int(np.searchsorted(sums, before + GATHERED // 4)) + 1
        end = int(ends[min(np.searchsorted(ends, full), len(ends) - 1)])
        # what is left of the last part may go on in the next batch, so it is a range of its own
        if end == len(parts) and len(ends) > 1 and start < ends[-2]:
            end = int(ends[-2])
        yield start, end
        start = end


def _shared(buckets: DataFrame) -> DataFrame:
    """The distinct (key, id) of all keys with several ids; buckets: (key, id), or (id, keys) with lists of keys.

    Rows are gathered in each task by parts of the keys, so that lists are shuffled, once, and not each row. Keys that stand out among the rows
    of one id in `HOT_SHARE` have several ids anyhow: their rows stay where they are, so that no task gets all rows of a hot key.
    """
    lists = buckets.select("id", "keys" if "keys" in buckets.columns else F.array("key").alias("keys")).filter(F.col("id").isNotNull())
    rows = lists.select("id", F.explode("keys").alias("key")).filter(F.col("key").isNotNull())
    some = rows.filter(F.pmod(F.xxhash64("id"), F.lit(HOT_SHARE)) == 0).distinct()
    hot = stored(some.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= HOT_IDS).select("key"), "hot")
    known = np.array(sorted(r.key for r in hot.collect()), np.int64)  # few, and broadcast anyhow
    dealt = lists.mapInArrow(_dealt(known), "part int, keys array<long>, ids array<long>")
    met = dealt.repartition("part").sortWithinPartitions("part").mapInArrow(_met_parts, "key long, id long")
    if not len(known):
        return met
    return met.union(rows.select("key", "id").join(F.broadcast(hot), "key", "left_semi").distinct())


def _labelled(table: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return table.withColumn("label", F.col("id"))
    return table.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")


def _open_blocks(shared: DataFrame, labels: DataFrame | None, sigs: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt to blocks of bounded size on both sides."""
    rows = _labelled(shared, labels)
    sizes = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"))
    main = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("all"), F.count(F.lit(1)).alias("labels"))
        .filter(F.col("labels") > 1)
        .select("key", F.col("top.label").alias("main"), "all", (F.col("all") - F.col("top.m")).alias("rest"))
    )
    rows = rows.join(stored(main, "open"), "key").join(sigs, "id")
    parts = F.ceil(F.col("rest") / BLOCK)
    other_parts = F.ceil(F.col("all") / BLOCK)
    own = F.xxhash64("id")
    steps = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
    keep = ["key", "id", "label", "main", "n", "sig", "keys"]
    outside = rows.filter(F.col("label") != F.col("main")).select(
        *keep, F.lit(1).alias("outside"), F.pmod(own, parts).cast("int").alias("part"), steps(other_parts).alias("other_part")
    )
    others = rows.select(
        *keep, F.lit(0).alias("outside"), steps(parts).alias("part"), F.pmod(own, other_parts).cast("int").alias("other_part")
    )
    return outside.union(others)


def _placed(rows: DataFrame) -> DataFrame:
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS)


def similar_components(
    keys: DataFrame, texts: Callable[[DataFrame], DataFrame], threshold: Threshold, sets: Callable
) -> DataFrame | None:
    """(id, component) of all items with a link; None if there is none.

    keys: (id, keys), the keys of all bands of an item in order; it may repeat an item. texts: from a table of ids to (id, text).
    """
    # what is joined with a hot key's rows is stored first, so that the join alone deals them and its skew can be split
    shared = stored(_shared(keys), "shared")
    ids = stored(shared.select("id").distinct(), "candidates")
    texts = stored(texts(ids), "texts")
    described = texts.mapInArrow(_described(sets), "id long, n long, sig binary")
    sigs = stored(described.join(keys.join(ids, "id").dropDuplicates(["id"]), "id"), "signatures")
    sizes = stored(shared.groupBy("key").agg(F.count(F.lit(1)).alias("m")), "sizes")
    degrees = shared.join(sizes, "key").groupBy("id").agg(F.sum("m").alias("degree"))
    hubs = shared.join(degrees, "id").groupBy("key").agg(F.max(F.struct("degree", -F.col("id"), "id")).getField("id").alias("hub"))
    hubs = stored(hubs, "hubs")
    pairs = shared.join(hubs, "key").filter(F.col("hub") != F.col("id")).select("hub", "id").distinct()
    both = pairs.join(sigs.select("id", "sig", "n"), "id").join(
        sigs.select(F.col("id").alias("hub"), F.col("sig").alias("hub_sig"), F.col("n").alias("hub_n")), "hub"
    )
    fitting = both.filter(F.least("n", "hub_n") * threshold.whole >= F.greatest("n", "hub_n") * threshold.parts)
    likely = fitting.select("hub", "id", "hub_sig", "sig").mapInArrow(_likely(threshold), "hub long, id long")
    labels = _merged(None, exact_links(stored(likely, "asked"), texts, threshold, sets))
    rows = _open_blocks(shared, labels, sigs)
    asked = stored(_placed(rows).mapInArrow(_asked(threshold), rows.schema), "blocks")
    found = _placed(asked.join(texts, "id")).mapInArrow(_block_links(threshold, sets), "hub long, id long")
    return _merged(labels, found.distinct())


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The components so far, joined by more links."""
    links = stored(links, "links")
    if links.isEmpty():
        return labels
    if labels is not None:
        links = links.union(labels.select("component", "id"))
    return stored(components(links, "hub", "id"), "labels")
