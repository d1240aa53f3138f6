"""Toxicity by a weighted finite-state pattern grammar.

The grammar is a composition of small transducers over the tokens of a clause:

* insult and threat: one automaton over all symbols of the lexicon (whole words and word beginnings), each arc with a weight;
* target: words for the person spoken to or about raise the clause to a targeted one;
* negation: reaches over the next few tokens and turns an insult into a negated one;
* reported speech: a verb of saying or an opening quotation mark turns what follows in the clause into a reported one.

Each matched clause yields a weight for one of these readings; a document's features are the heaviest clause of each reading, the number of
matched clauses and their total, and a logistic model over them gives the score. Isolated words never score by themselves, only the clause that
they stand in.

Learning: the lexicon's symbols and weights and the coefficients are fitted on at most `sample` labelled rows (those with the smallest
hash of the id), none of which is held out. A symbol is learned if the toxic texts that hold it are too many for chance; copies of a text, which
share a hash minimum, count once, so the other words of a copied toxic text are not learned. Scoring covers every text whole.

Cases: null and empty texts get the score of a text without matches; labels that are null or of unknown documents are not used; without any
label of either kind the fixed seeds and default coefficients apply; equal rows get equal scores; an empty table gives an
empty result; other columns are ignored by `scored` and kept by `accepted`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import stored

# Words of the grammar in English, German, French and Spanish.
INSULTS = (
    "idiot idiots idiotic moron morons stupid scum loser worthless pathetic disgusting imbecile "
    "dummkopf arschloch trottel abschaum connard connasse imbécile ordure idiota estúpido imbécil escoria"
).split()
THREATS = (
    "kill murder hurt destroy beat töten umbringen vernichten verprügeln tuer tuerai frapper détruire matar mataré golpear destruir"
).split()
TARGETS = (
    "you your you're u he she they them him her his their du dich dir dein deine sie ihr euch er ihn ihm "
    "tu toi te vous votre ton ta tes il elle ils elles lui leur tú ti usted ustedes eres él ella ellos ellas"
).split()
NEGATIONS = "not no never neither nor cannot nicht kein keine nie niemals ohne ne pas jamais sans ni nunca jamás sin".split()
REPORTS = (
    "said says say wrote writes claimed quoted according sagte sagt schrieb laut zitiert dit écrit selon cité dijo dice escribió según citó"
).split()
QUOTES = "\"“”„«»"

SAMPLE = 20_000
HELD_OUT = 5
PREFIXES = (3, 4, 5, 6, 7, 8)
FEW = 5  # toxic rows that a symbol must be found in
PRECISE = 0.8  # share of toxic rows among its rows
NATS = 12.0  # evidence against the symbol being spread by chance
CANDIDATES = 20_000  # symbols, of the most toxic rows, that are looked at
REACH = 3  # tokens that a negation reaches over
FLUSH = 300_000

TOKEN = re.compile(r"[\"“”„«»]|[\w'’]+")
CLAUSE = re.compile(r"[.!?;\n]")
READINGS = ("asserted", "targeted", "negated", "reported", "threat", "clauses", "total")


@dataclass(frozen=True)
class Symbol:
    """An arc of the lexicon: a whole word, or the beginning of one."""

    text: str
    whole: bool
    weight: float
    threat: bool = False


@dataclass(frozen=True)
class Model:
    symbols: tuple[Symbol, ...]
    coefficients: tuple[float, ...]  # of the readings, then the constant


DEFAULT = (4.0, 1.0, 2.0, 2.0, 5.0, 0.5, 0.5, -4.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def _seeds() -> list[Symbol]:
    return [Symbol(w, True, 1.0) for w in INSULTS] + [Symbol(w, True, 0.5, threat=True) for w in THREATS]


class Grammar:
    """The composed automaton of a lexicon."""

    def __init__(self, symbols: tuple[Symbol, ...]) -> None:
        import ahocorasick

        self.lexicon = ahocorasick.Automaton()
        arcs: dict[str, list[Symbol]] = {}
        for symbol in symbols:
            arcs.setdefault(symbol.text, []).append(symbol)
        for text, own in arcs.items():
            self.lexicon.add_word(text, (len(text), own))
        self.lexicon.make_automaton()
        self.classes = {w: "target" for w in TARGETS} | {w: "negation" for w in NEGATIONS} | {w: "report" for w in REPORTS}
        self.classes |= {q: "quote" for q in QUOTES}

    def matches(self, text: str) -> Iterator[tuple[int, Symbol]]:
        """Starts of words that a symbol accepts."""
        if not len(self.lexicon):
            return
        for last, (length, own) in self.lexicon.iter(text):
            start = last - length + 1
            if start and _letter(text[start - 1]):
                continue
            ends = last + 1 == len(text) or not _letter(text[last + 1])
            for symbol in own:
                if ends or not symbol.whole:
                    yield start, symbol

    def features(self, text: str) -> list[float]:
        out = dict.fromkeys(READINGS, 0.0)
        heaviest: dict[int, Symbol] = {}
        for start, symbol in self.matches(text):
            if start not in heaviest or heaviest[start].weight < symbol.weight:
                heaviest[start] = symbol
        if not heaviest:
            return [0.0] * len(READINGS)
        ends = [m.start() for m in CLAUSE.finditer(text)]
        bounds = np.array([-1, *ends, len(text)])
        places = np.array(sorted(heaviest))
        clause_of = np.searchsorted(bounds, places, "right") - 1
        for clause in np.unique(clause_of):
            start, end = int(bounds[clause]) + 1, int(bounds[clause + 1])
            found = self.read(text, start, end, heaviest)
            for reading, weight in found.items():
                out[reading] = max(out[reading], min(weight, 3.0))
            out["clauses"] += 1
            out["total"] = min(out["total"] + found["asserted"], 5.0)
        out["clauses"] = float(np.log1p(out["clauses"]))
        return [out[r] for r in READINGS]

    def read(self, text: str, start: int, end: int, heaviest: dict[int, Symbol]) -> dict[str, float]:
        """Run the composed transducer over one clause: the weight of each reading."""
        sums = dict.fromkeys(("asserted", "negated", "reported", "threat"), 0.0)
        negated, reported, target = 0, False, False
        for token in TOKEN.finditer(text, start, end):
            kind = self.classes.get(token.group())
            negated = max(negated - 1, 0)
            if kind == "negation":
                negated = REACH + 1
            elif kind in ("report", "quote"):
                reported = kind == "report" or not reported
            elif kind == "target":
                target = True
            symbol = heaviest.get(token.start())
            if symbol:
                reading = "reported" if reported else "negated" if negated else "threat" if symbol.threat else "asserted"
                sums[reading] += symbol.weight
        if not target:
            sums["threat"] = 0.0  # a threat needs someone threatened
        return sums | {"targeted": sums["asserted"] if target else 0.0}


def _letter(char: str) -> bool:
    return char.isalnum() or char in "'’_"


def _symbols(text: str) -> set[str]:
    """The candidate symbols of a text: its words, marked, and beginnings of them."""
    found = set()
    for word in {t.group() for t in TOKEN.finditer(text)}:
        if len(word) > 2:
            found.add("=" + word)
        found.update(word[:n] for n in PREFIXES if len(word) > n)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other texts of each candidate symbol, summed as far as a task's memory allows."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        columns = [[c[n] for n in names] for c in (counts[1], counts[0])]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array(c, pa.int64()) for c in columns)], ["symbol", "toxic", "clean"]
        )

    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            counts[toxic].update(_symbols((text or "").lower()))
            if len(counts[0]) + len(counts[1]) > FLUSH:
                yield out()
    yield out()


def _carried(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The candidates in each text, and four hash minima of its runs of five words, of which copies share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {n: i for i, n in enumerate(names)}
        factors = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)
        for batch in batches:
            found, minima = [], []
            for text in batch["text"].to_pylist():
                symbols = _symbols((text or "").lower())
                words = (text or "").lower().split()
                runs = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
                hashes = np.array([crc32(r.encode()) for r in runs], np.uint64)
                found.append(sorted(places[s] for s in symbols if s in places))
                minima.append((((hashes[:, None] * factors) & np.uint64(0xFFFFFFFF)).min(axis=0)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), pa.array(minima, pa.list_(pa.int64()))], ["carried", "minima"]
            )

    return run


def _featured(symbols: tuple[Symbol, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(symbols)
        for batch in batches:
            rows = [grammar.features((text or "").lower()) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch["toxic"]], ["features", "toxic"])

    return run


def _texts_of(minima: list[list[int]]) -> list[int]:
    """One number for the rows that are copies of each other: they share one of their minima."""
    root = list(range(len(minima)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[tuple[int, int], int] = {}
    for row, own in enumerate(minima):
        for key in enumerate(own):
            root[find(row)] = find(first.setdefault(key, row))
    return [find(i) for i in range(len(minima))]


def _specific(found: dict[int, tuple[str, set[int]]]) -> list[int]:
    """Without the beginnings whose texts a single longer symbol has nearly all."""
    longer: dict[str, int] = {}
    for name, texts in found.values():
        word = name.removeprefix("=")
        for size in range(min(PREFIXES), len(word) + name.startswith("=")):
            longer[word[:size]] = max(longer.get(word[:size], 0), len(texts))
    return [p for p, (name, texts) in sorted(found.items()) if name.startswith("=") or longer.get(name, 0) < 0.9 * len(texts)]


def _evidence(toxic: int, clean: int, base: float) -> float:
    """How far, in nats, the share of toxic rows exceeds what chance gives at the base rate."""
    share = toxic / (toxic + clean)
    if share <= base:
        return 0.0
    clean_part = clean * np.log((1 - share) / (1 - base)) if clean else 0.0
    return float(toxic * np.log(share / base) + clean_part)


def _logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, ...]:
    """Newton steps for a logistic model with a small ridge; the last coefficient is the constant."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.array(DEFAULT)
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (p - labels) + penalty @ w)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit lexicon and coefficients on at most `sample` labelled rows that are not held out.

    The driver receives rows of the sample's size at most: ids and labels, symbols, and seven features a row.
    """
    spark = docs.sparkSession
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    taken = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stored(texts.join(F.broadcast(taken), "doc_id").select("text", "toxic"), "labelled")
    share = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < share[1] < share[0]:
        return Model(tuple(_seeds()), DEFAULT)
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = rows.mapInArrow(_counted, "symbol string, toxic long, clean long").groupBy("symbol")
    counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    precise = F.col("toxic") >= PRECISE * (F.col("toxic") + F.col("clean"))
    top = counted.filter((F.col("toxic") >= FEW) & precise).orderBy(F.desc("toxic"), "symbol").limit(CANDIDATES).collect()
    candidates = [(r["symbol"], r["toxic"], r["clean"]) for r in top]
    toxic_rows = rows.filter("toxic = 1").select("text")
    names = [c[0] for c in candidates]
    carried = toxic_rows.mapInArrow(_carried(names), "carried array<int>, minima array<long>").collect()
    holders: dict[int, set[int]] = {}
    for text, row in zip(_texts_of([r["minima"] for r in carried]), carried, strict=True):
        for place in row["carried"]:
            holders.setdefault(place, set()).add(text)
    base = share[1] / share[0]
    learned = []
    for place in _specific({p: (names[p], found) for p, found in holders.items()}):
        name, _, clean = candidates[place]
        toxic = len(holders[place])
        if toxic >= FEW and toxic >= PRECISE * (toxic + clean) and _evidence(toxic, clean, base) >= NATS:
            weight = float(np.log((toxic + 0.5) / (clean + 0.5) * (1 - base) / base) / 5)
            learned.append(Symbol(name.removeprefix("="), name.startswith("="), min(max(weight, 0.2), 1.5)))
    symbols = (*learned, *(s for s in _seeds() if s.text not in {x.text for x in learned}))
    fitted = rows.mapInArrow(_featured(symbols), "features array<double>, toxic int").collect()
    features, marks = np.array([r["features"] for r in fitted]), np.array([r["toxic"] for r in fitted], float)
    return Model(symbols, _logistic(features, marks))


def _scores(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, w = Grammar(model.symbols), np.array(model.coefficients)
        for batch in batches:
            rows = [grammar.features((text or "").lower()) for text in batch["text"].to_pylist()]
            x = np.array(rows, float).reshape(len(rows), len(READINGS))
            score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; one pass over the texts without a shuffle."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_scores(model), "doc_id long, score double")
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _verdicts(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, w = Grammar(model.symbols), np.array(model.coefficients)
        for batch in batches:
            texts = batch["text"].to_pylist()
            keep = [float(np.dot(grammar.features((t or "").lower()), w[:-1]) + w[-1]) < 0 for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not predicted toxic, with their own columns."""
    return docs.mapInArrow(_verdicts(model), docs.schema)
