"""Vectorised shingle sets and universal hash minima for Arrow batches.

Everything works on 64-bit hashes in numpy. Texts are taken in slices of a few megabytes, and a longer text in pieces cut at
white space, so that a task's memory holds one slice and the shingle hashes of one text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

U = np.uint64
SLICE = 1 << 20
_BASE = 0x2545F4914F6CDD1D  # odd, 5 modulo 8: its powers do not repeat early
_powers: dict[str, np.ndarray] = {}


def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers that depend on the seed only."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, count, dtype=U) | U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole word."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2^64 and of its inverse."""
    if "up" not in _powers or len(_powers["up"]) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(max(size, SLICE + 1), base, U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case, byte by byte."""
    return raw | ((raw - np.uint8(65) < np.uint8(26)).view(np.uint8) << np.uint8(5))


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * base^position up to every position."""
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum((raw.astype(U) + U(1)) * powers(len(raw))[0][: len(raw)], out=sums[1:])
    return sums


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the start of every word of a buffer, A-Z in lower case."""
    raw = np.frombuffer(text, np.uint8)
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = (raw == np.uint8(32)) | (raw - np.uint8(9) < np.uint8(5))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = prefix_hashes(lowered(raw))
    return mix((sums[ends] - sums[starts]) * powers(len(raw) + 1)[1][starts]), starts


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces cut at white space."""
    at = 0
    while len(text) - at > SLICE:
        end = at + SLICE
        cut = max(text.rfind(space, at, end) for space in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:  # a word longer than a slice stays whole
            cuts = [c for space in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (c := text.find(space, end)) >= 0]
            cut = min(cuts, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def slices(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about one slice together."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > SLICE:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _words_of(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts in order, and the number of words up to each text."""
    if len(texts) == 1:
        found = np.concatenate([word_hashes(p)[0] for p in pieces(texts[0])])
        return found, np.array([0, len(found)])
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    found, starts = word_hashes(b"\n".join(texts))
    return found, np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; a sort is several times faster here than the hash table of `np.unique`."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def word_sets(texts: Sequence[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than `size` make one shingle, no words none."""
    factors = constants(2 * size + 1, 3)
    for first, last in slices(texts):
        words, bounds = _words_of(texts[first:last])
        whole = len(words) - size + 1
        sums = np.zeros(max(whole, 0), U)
        for i in range(size):
            sums += words[i : i + len(sums)] * factors[i]
        sums = mix(sums)
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - start >= size:
                yield distinct(sums[start : end - size + 1])
            elif end > start:
                few = words[start:end]
                yield mix((few * factors[: len(few)]).sum(keepdims=True) + factors[size + len(few) :][:1])
            else:
                yield np.zeros(0, U)


def _spread(x: np.ndarray) -> np.ndarray:
    """A cheaper bijection than `mix`, for hashes of short runs."""
    return (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)


def char_windows(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of runs of `size` bytes, A-Z in lower case; for each non-empty part the end of its window of hashes, and its own hash.

    A window starts at its part's start. A part shorter than a run has one hash, of the whole.
    """
    sums = prefix_hashes(lowered(raw))
    down = powers(len(raw) + 1)[1]
    runs = np.zeros(len(raw) + 1, U)
    whole = max(len(raw) - size + 1, 0)
    runs[:whole] = _spread((sums[size : size + whole] - sums[:whole]) * down[:whole])
    few = ends - starts < size
    if few.any():
        first, last = starts[few], ends[few]
        runs[first] = _spread((sums[last] - sums[first]) * down[first] + constants(size, 5)[last - first - 1])
    whole_parts = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
    return runs, np.maximum(ends - size + 1, starts + 1), whole_parts


def char_sets(lines: Sequence[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of runs of `size` bytes of each line; an empty line has none."""
    for first, last in slices(lines):
        part = lines[first:last]
        bounds = np.concatenate(([0], np.cumsum(np.fromiter((len(x) for x in part), np.int64, len(part)))))
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        runs, stops, _ = char_windows(np.frombuffer(b"".join(part), np.uint8), bounds[full], bounds[full + 1], size)
        at = dict(zip(full.tolist(), stops.tolist(), strict=True))
        for i in range(len(part)):
            yield distinct(runs[bounds[i] : at[i]]) if i in at else runs[:0]


class Minima:
    """Signatures: the minima of `bands * rows` universal hashes (a * x + b modulo 2^32, a odd) of the upper halves of a set."""

    def __init__(self, bands: int, rows: int, seed: int = 11) -> None:
        self.bands, self.rows = bands, rows
        self.factors, self.shifts = (
            (constants(bands * rows, s) >> U(31)).astype(np.uint32) | np.uint32(1) for s in (seed, seed + 1)
        )
        self.keys = constants(bands * rows, seed + 2).reshape(bands, rows)
        self.names = constants(bands, seed + 3)

    def of(self, sets: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of non-empty sets: a 64-bit key for each band, and one byte of each minimum as a signature."""
        least = np.empty((len(sets), len(self.factors)), np.uint32)
        start = 0
        while start < len(sets):
            end, held = start, 0
            while end < len(sets) and (end == start or held + len(sets[end]) <= 1 << 15):
                held += len(sets[end])
                end += 1
            bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets[start : end - 1]], dtype=np.int64)))
            self._least(np.concatenate(sets[start:end]), bounds, least[start:end])
            start = end
        return self._banded(least)

    def of_windows(self, values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The keys of windows of an array that ends with a spare value."""
        bounds = np.stack([starts, stops], axis=1).ravel()
        least = np.empty((len(bounds), len(self.factors)), np.uint32)
        self._least(values, bounds, least)
        return self._banded(least[::2])[0]

    def _least(self, values: np.ndarray, bounds: np.ndarray, out: np.ndarray) -> None:
        upper = (values >> U(32)).astype(np.uint32)
        work = np.empty_like(upper)
        for i in range(len(self.factors)):
            np.multiply(upper, self.factors[i], out=work)
            np.add(work, self.shifts[i], out=work)
            out[:, i] = np.minimum.reduceat(work, bounds)

    def _banded(self, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = mix(least.astype(U))
        keys = mix((least.reshape(len(least), self.bands, self.rows) * self.keys).sum(axis=2, dtype=U) + self.names)
        return keys.view(np.int64), (least & U(0xFF)).astype(np.uint8)


def shared(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(one) > len(other):
        one, other = other, one
    if not len(one):
        return 0
    at = np.searchsorted(other, one)
    at[at == len(other)] = 0
    return int((other[at] == one).sum())


def text_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
