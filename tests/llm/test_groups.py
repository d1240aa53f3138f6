"""MinHash, line and vector groups against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import components, linededup, links, minhash, shingles, vectors

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def word_set(text, size):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def joined(sets, parts, whole):
    """The smallest id of each component; sets by id."""
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and whole * common >= parts * (len(sets[a]) + len(sets[b]) - common):
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    return {i: find(i) for i in ids}


def edited(text, rng, share):
    return " ".join(w if rng.random() > share else f"edit{rng.randrange(10**6)}" for w in text.split())


def corpus(seed=1):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 150))) for _ in range(25)]
    texts = base + [edited(rng.choice(base), rng, rng.choice([0.005, 0.02, 0.05])) for _ in range(120)]
    texts += [base[3]] * 15 + [base[4].upper(), base[4].replace(" ", "\n\t "), None, "", "  \n ", "two words", "Two  words", "one"]
    texts += [f"{base[5]} {i}" for i in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("size,parts", [(3, 85), (5, 80)])
def test_document_groups_equal_brute_force(spark, size, parts):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, kept string, n int")
    got = {r.doc_id: r for r in minhash.duplicate_groups(docs, size, parts, 100).collect()}
    sets = {i: word_set(t, size) for i, t in rows}
    want = joined(sets, parts, 100)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (want[i] == i) for i, r in got.items())


def test_document_groups_keep_one_row_each(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a"), (2, text, "b"), (1, text, "a"), (None, text, "c"), (3, None, "d"), (4, "", "e"), (5, "other words here", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.component_id) for r in kept.collect()) == [(0, "c"), (1, "a"), (3, "d"), (4, "e"), (5, "f")]
    assert minhash.duplicate_groups(docs.limit(0)).count() == 0


def test_very_long_text_is_hashed_in_pieces(monkeypatch):
    text = " ".join(f"Word{i % 997}" for i in range(3000)).encode()
    whole = list(shingles.word_sets([text, b"", b"a b"], 3))
    monkeypatch.setattr(shingles, "SLICE", 100)
    cut = list(shingles.word_sets([text, b"", b"a b"], 3))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, cut, strict=True))
    assert len(whole[0]) == len(word_set(text.decode(), 3))


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 200), (101, 100)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.id: r.component for r in got} == {i: 1 for i in range(1, 21)} | {100 + i: 100 for i in range(30)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def char_set(line, size=linededup.RUN):
    raw = line.translate(LOWER).encode()
    return frozenset(raw[i : i + size] for i in range(max(1, len(raw) - size + 1))) if raw else frozenset()


def test_lines_equal_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ijklm") for _ in range(rng.randrange(5, 160))) for _ in range(20)]
    vary = lambda s: s[: len(s) // 2] + rng.choice("xyz") + s[len(s) // 2 :]
    texts = []
    for _ in range(40):
        lines = [rng.choice([rng.choice(base), vary(rng.choice(base)), rng.choice(base).upper(), "", "  "]) for _ in range(rng.randrange(0, 7))]
        texts.append("\n".join(lines))
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "\n\n"), (None, base[0])]
    docs = spark.createDataFrame([(i, t, "z", len(t or "")) for i, t in rows], "doc_id long, text string, line string, n_chars long")
    sets = {}
    for doc, text in rows:
        for at, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" \t\r\x0b\x0c"):
                sets[(-1 if doc is None else doc, at)] = char_set(line)
    want = joined(sets, 80, 100)
    gone = {}
    for (doc, at), first in want.items():
        gone.setdefault(doc, [])
        if (doc, at) != first:
            gone[doc].append(at)
    got = {-1 if r.doc_id is None else r.doc_id: r for r in linededup.decisions(docs).collect()}
    assert {i: sorted(r.removed) for i, r in got.items()} == {i: sorted(gone.get(i, [])) for i in got}
    left = {-1 if r.doc_id is None else r.doc_id: r for r in linededup.deduplicated(docs).collect()}
    for doc, text in rows:
        key = -1 if doc is None else doc
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get(key, []))
        assert left[key].text == kept and left[key].line == "z"
        assert gone.get(key, []) == [] or left[key].n_chars == len(kept)
    assert linededup.deduplicated(docs.limit(0)).count() == 0


def test_long_texts_are_cut_at_line_feeds(monkeypatch):
    text = "\n".join(f"line number {i} of many" for i in range(300)).encode()
    minima = shingles.Minima(linededup.BANDS, linededup.ROWS)

    def rows():
        out = []
        for units in linededup._units([b"", text, b"\n\nx"]):
            places, numbers, digest, *_ = linededup._lines(minima, units)
            out += list(zip(places.tolist(), numbers.tolist(), digest.tolist(), strict=True))
        return out

    whole = rows()
    monkeypatch.setattr(linededup, "SLICE", 64)
    assert rows() == whole and len(whole) == 301 and whole[-1][:2] == (2, 2)


def test_minima_are_made_once_for_each_line():
    minima = shingles.Minima(linededup.BANDS, linededup.ROWS)
    lines = [f"line number {i * 7 % 5} of several" for i in range(12)] + ["a line that is new"]
    units = [(0, 0, "\n".join(lines).encode())]
    seen = {}
    *_, digest, second, fresh, keys = linededup._lines(minima, units, seen)
    assert fresh.tolist() == [True] * 5 + [False] * 7 + [True] and len(keys) == 6
    assert len(set(zip(digest.tolist(), second.tolist(), strict=True))) == 6
    for at, line in zip(np.flatnonzero(fresh), keys, strict=True):
        alone = linededup._lines(minima, [(0, 0, lines[at].encode())])
        assert alone[-1].tolist() == [line.tolist()] and (alone[2][0], alone[3][0]) == (digest[at], second[at])
    *_, again, fresh, keys = linededup._lines(minima, units, seen)
    assert not fresh.any() and not len(keys) and again.tolist() == second.tolist()


@pytest.mark.parametrize("size", [1, 200, 1 << 20])
def test_links_of_blocks_do_not_depend_on_the_slice(monkeypatch, size):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghij") * 6 for _ in range(12)) for _ in range(4)]
    rows = []
    for key in range(30):
        for i in range(rng.randrange(2, 6)):
            at = rng.randrange(16)
            text = texts[at % 4] + " tail" * (at // 4 % 2)
            rows.append({"key": key, "part": 0, "other_part": 0, "id": at, "label": at, "main": 0, "n": 60, "sig": b"x" * links.CHECKS,
                         "keys": [key], "outside": i % 2, "text": text})
    table = pa.Table.from_pylist(rows)
    batches = lambda: iter(table.to_batches(max_chunksize=17))
    put = lambda: [tuple(r.values()) for b in links._block_links(t, sets)(batches()) for r in b.to_pylist()]
    t, sets = links.Threshold(80, 100), lambda x: shingles.char_sets(x, linededup.RUN)
    wanted = set()
    for key in range(30):
        own = [r for r in rows if r["key"] == key]
        for a, b in itertools.product([r for r in own if r["outside"]], [r for r in own if not r["outside"]]):
            if a["id"] != b["id"] and (b["label"] == 0 or b["id"] > a["id"]):
                one, other = (char_set(r["text"]) for r in (a, b))
                if 100 * len(one & other) >= 80 * len(one | other):
                    wanted.add((b["id"], a["id"]))
    monkeypatch.setattr(links.shingles, "SLICE", size)
    assert wanted and set(put()) == wanted


def brute_vectors(rows, least=0.9):
    usable = {
        i: np.array(v, float)
        for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    }
    links_of = {i: set() for i, _ in rows}
    for a, x in usable.items():
        for b, y in usable.items():
            if a != b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links_of[a].add(b)
    return links_of


def vector_rows(seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + rng.normal(size=16) * rng.choice([0.05, 0.3, 2.0])).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(50)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] + [1.0] * 15), (2005, [1.0, 2.0])]
    return rows + [(2006, [2.0, 4.0]), (2007, [float("inf")] * 16)]


def test_vector_groups_against_brute_force(spark, monkeypatch):
    rows = vector_rows()
    monkeypatch.setattr(vectors, "BLOCK", 64)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cell int")
    got = {r.vec_id: r for r in vectors.duplicate_groups(df).collect()}
    links_of = brute_vectors(rows)
    assert len(got) == len(rows)
    assert all(got[i].n_links <= len(links_of[i]) for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(map(len, links_of.values()))
    for i in (2000, 2001, 2002, 2003, 2004, 2007):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[2006].component_id == 2005 and not got[2006].kept
    assert all(got[1000 + i].component_id == got[3].component_id for i in range(50))
    kept = vectors.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got.values())
    assert vectors.duplicate_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["isotropic", "low rank", "long axes"])
def test_every_vector_link_is_found(spark, shape):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(1500, 8)) @ rng.normal(size=(8, 64)) if shape == "low rank" else rng.normal(size=(1500, 64))
    near = base[:500] + (rng.normal(size=(500, 8)) @ rng.normal(size=(8, 64)) if shape == "low rank" else rng.normal(size=(500, 64))) * 0.4
    made = np.concatenate([base, near]) / (np.arange(1, 65) if shape == "long axes" else 1)
    made = made.astype(np.float32)
    unit = made.astype(float) / np.linalg.norm(made.astype(float), axis=1, keepdims=True)
    links_of = unit @ unit.T >= 0.9
    np.fill_diagonal(links_of, False)
    assert links_of.sum() > 500
    sets = {i: i for i in range(len(made))}

    def root(i):
        while sets[i] != i:
            i = sets[i]
        return i

    for a, b in np.argwhere(links_of).tolist():
        one, other = root(a), root(b)
        sets[max(one, other)] = min(one, other)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.duplicate_groups(df).collect()}
    assert got == {i: (int(n), root(i)) for i, n in enumerate(links_of.sum(axis=1))}


def test_threshold_is_exact():
    t = links.Threshold(85, 100)
    one = np.arange(200, dtype=np.uint64)
    assert t.met(one, one[30:]) and not t.met(one, one[31:])
