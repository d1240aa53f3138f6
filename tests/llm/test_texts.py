"""Toxicity, pseudonyms, licences and the pipeline."""

import datetime
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textmill.llm import licences, pii, toxicity

PLAIN = "the of and hand water stone river table green light under over walk cloud paper".split()


def labelled(spark, n=600, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(PLAIN) + rng.choice(["", "", ".", ","]) for _ in range(rng.randrange(5, 80))]
        toxic = i % 8 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["zorgle", "kwimpfheit", "kwimpflos", "kwimpfen", "blatter"]))
        docs.append((i, " ".join(words), "hidden"))
        labels.append((i, 1, int(toxic)))
    docs += [(n, None, "x"), (n + 1, "", "y"), (None, "plain words", "z")]
    labels += [(n + 5, 1, 1), (None, 0, 1), (1, None, None)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_is_learned_from_rows_that_are_not_held_out(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert len(got) == 603
    held = {i for i in got if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    assert {i for i, r in got.items() if r.held_out} == held
    wrong = [i for i in held if i < 600 and got[i].predicted != int(i % 8 == 0)]
    assert len(held) > 80 and not wrong
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[600].predicted == got[601].predicted == 0
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_labels_of_held_out_rows_are_never_used(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)


def test_without_labels_the_seeds_apply(spark):
    docs, labels = labelled(spark, 20)
    model = toxicity.train(docs, labels.limit(0))
    texts = spark.createDataFrame([(1, "You are an idiot."), (2, "A calm day.")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.scored(texts, model).collect()} == {1: 1, 2: 0}


def test_clauses_are_read_by_the_grammar():
    grammar = toxicity.Grammar(tuple(toxicity._seeds()))
    read = lambda text: dict(zip(toxicity.READINGS, grammar.features(text.lower()), strict=True))
    assert read("such a stupid thing")["asserted"] == 1 and read("such a stupid thing")["targeted"] == 0
    assert read("you are stupid, moron")["targeted"] == 2
    assert read("she is not a moron")["negated"] == 1 and read("she is not a moron")["asserted"] == 0
    assert read("not now. what a moron")["asserted"] == 1
    assert read("he said the man was a moron")["reported"] == 1
    assert read('"moron" was the word')["reported"] == 1 and read('"so" you moron')["targeted"] == 1
    assert read("i will kill you")["threat"] == 0.5 and read("they kill")["threat"] == 0.5 and read("kill time")["threat"] == 0
    assert not any(read("stupidity of idiotically").values())


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if luhn(body + d))


def iban(rng):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    return "DE" + f"{98 - int(body + '131400') % 97:02d}" + body


def values(rng):
    day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73000))
    number = card(rng)
    return {
        "email": f"{rng.choice(['anna', 'Bo.Li', 'x'])}.{rng.randrange(100)}@mail{rng.randrange(9)}.example.com",
        "ip": ".".join(str(rng.randrange(256)) for _ in range(4)),
        "iban": iban(rng),
        "card": rng.choice([number, "-".join(number[i : i + 4] for i in (0, 4, 8, 12))]),
        "ssn": f"{rng.choice([1, 665, 667, 899, rng.randrange(1, 600)]):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}",
        "date": rng.choice([day.strftime("%Y-%m-%d"), day.strftime("%m/%d/%Y"), day.strftime("%d.%m.%Y"), day.strftime("%d/%m/%Y")]),
        "phone": f"+1 ({rng.randrange(200, 1000)}) {rng.randrange(200, 1000)}-{rng.randrange(10000):04d}",
        "abroad": f"+45 {rng.randrange(10, 100)} {rng.randrange(10, 100)} {rng.randrange(10, 100)} {rng.randrange(10, 100)}",
        "secret": f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"',
    }


@pytest.fixture(scope="module")
def private(spark):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        for kind, value in values(rng).items():
            rows.append((len(rows), f"see {value}, {kind} {value}.", kind, value))
    rows += [(len(rows), f"on {d}.", "date", d) for d in ("2000-02-29", "02/29/2004", "29.02.1996", "31.12.1999", "2099-12-31", "1900-01-01")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, value string")
    return docs, {r.doc_id: r for r in pii.pseudonymised(docs).collect()}


def test_values_change_within_their_format_and_stay_linked(private):
    docs, got = private
    for row in docs.collect():
        text = got[row.doc_id].text
        shape = lambda s: re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
        prefix, rest = text.split(" ", 1)
        if row.kind == "secret":
            old, new = row.value[9:-1], re.findall('"([0-9a-f]{40})"', text)
        elif row.kind == "ip":
            old, new = row.value, re.findall(r"\d+\.\d+\.\d+\.\d+", text)
            assert all(int(x) < 256 for n in new for x in n.split("."))
        elif row.text.startswith("on "):
            old, new = row.value, [rest[:-1]]
        else:
            old, new = row.value, [rest[: len(row.value)], rest[-len(row.value) - 1 : -1]]
            assert shape(new[0]) == shape(old)
        assert len(set(new)) == 1 and got[row.doc_id].n_values == len(new) or new[0] == old, (row.text, text)
        if row.kind == "card":
            assert luhn(re.sub("[^0-9]", "", new[0])) and new[0][0] == "4"
        if row.kind == "iban":
            assert int(new[0][4:] + "1314" + new[0][2:4]) % 97 == 1
        if row.kind == "date":
            parts = [int(x) for x in re.split("[-/.]", new[0])]
            assert 1900 <= max(parts) <= 2099
            datetime.date.fromisoformat(new[0]) if "-" in new[0] else None
        if row.kind == "ssn":
            assert not re.match("000|666|9", new[0])
    changed = sum(r.n_values > 0 for r in got.values())
    assert changed >= len(got) - 3


def test_pseudonyms_are_permutations_that_the_key_reverses(spark, private):
    docs, got = private
    made = spark.createDataFrame([(i, r.text) for i, r in got.items()], "doc_id long, text string")
    back = {r.doc_id: r.text for r in pii.restored(made).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}
    other = {r.doc_id: r.text for r in pii.pseudonymised(docs, key="another").collect()}
    assert sum(other[i] != got[i].text for i in got) > 0.95 * len(got)


def test_secrets_in_capitals_keep_them(spark):
    secret = "0A1B2C3D4E5F60718293A4B5C6D7E8F9"
    docs = spark.createDataFrame([(1, f'TOKEN = "{secret}"')], "doc_id long, text string")
    made = pii.pseudonymised(docs)
    new = made.first().text
    assert re.fullmatch('TOKEN = "[0-9A-F]{32}"', new) and secret not in new
    assert pii.restored(made).first().text == f'TOKEN = "{secret}"'


def test_small_domains_are_permuted_without_collisions(spark):
    df = spark.range(7 * 11).select(F.expr("id div 11").alias("a"), (F.col("id") % 11).alias("b"))
    pair = pii.feistel_pair(F.col("a"), F.col("b"), 7, 11, "test", "key", False)
    rows = df.select("a", "b", pair.alias("p"))
    assert rows.select("p.*").distinct().count() == 77
    back = rows.select("a", "b", pii.feistel_pair(F.col("p.l"), F.col("p.r"), 7, 11, "test", "key", True).alias("q"))
    assert back.filter((F.col("q.l") != F.col("a")) | (F.col("q.r") != F.col("b"))).count() == 0


def test_clean_texts_and_invalid_values_are_left_alone(spark):
    texts = [None, "", "nothing here", "card 1234567890123456", "000-12-3456", "999.1.1.1", "2001-02-30", "DE00123456789012345678", "a@b", "v1.2.3", "5" * 400]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_values int")
    got = pii.pseudonymised(docs).orderBy("doc_id").collect()
    assert [r.text for r in got] == texts and {r.n_values for r in got} == {0}
    assert pii.pseudonymised(docs.limit(0)).count() == 0


def test_licences_by_canonical_digests(spark):
    mit = dict((t[:10], t) for n, t in licences.KNOWN if n == "MIT")["Permission"]
    rows = [
        (1, "Copyright (c) 2020 A. Person\nAll rights reserved.\n\n" + mit.upper().replace(", ", " , "), "MIT", ["MIT"]),
        (2, "some text\nReleased under the MIT Licence\nmore", None, ["MIT"]),
        (3, "first paragraph\n\n" + mit + "\n\nthis work is licensed under the GNU general public license v3", None, ["GPL-3.0", "MIT"]),
        (4, "The MIT License is often chosen.", None, []),
        (5, None, None, []),
        (6, "", None, []),
        (7, "Copyright (c) 1999 nobody", None, []),
        (8, "Licensed under the Apache License,   version 2.0", "Apache-2.0", ["Apache-2.0"]),
        (None, "licensed under cc by-nc 4.0", "CC-BY-NC-4.0", ["CC-BY-NC-4.0"]),
        (2, "some text\nReleased under the MIT Licence\nmore", None, ["MIT"]),
        # repeated and null ids with different texts: each row keeps the answer of its own text
        (None, "Released under the MIT Licence", "MIT", ["MIT"]),
        (None, "no licence here", None, []),
        (8, "nothing to find", None, []),
    ]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _, _ in rows], "doc_id long, text string, license string, digest string")
    got = licences.scanned(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, w, n) for i, _, w, n in rows), key=key)
    assert licences.scanned(docs.limit(0)).count() == 0


def test_titles_list_marks_and_given_licences_are_found(spark):
    body = next(t for n, t in licences.KNOWN if n == "BSD-3-Clause" and t.startswith("Redistribution"))
    marked = re.sub(r"[123]\. ", "\n* ", body)
    rows = [
        (1, "BSD 3-Clause License\n\nCopyright (c) 2020, A. Person\nAll rights reserved.\n\n" + body, "BSD-3-Clause"),
        (2, marked, "BSD-3-Clause"),
        (3, "Released under the Apache License 2.0.", "Apache-2.0"),
        (4, "Own terms:\nuse it well", "Own"),
    ]
    more = spark.createDataFrame([("Own", "own terms use it WELL")], "license string, text string")
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert {r.doc_id: r.whole for r in licences.scanned(docs, more).collect()} == {r[0]: r[2] for r in rows}
    assert {r.doc_id: r.whole for r in licences.scanned(docs).collect()} == {1: "BSD-3-Clause", 2: "BSD-3-Clause", 3: "Apache-2.0", 4: None}


def test_every_known_licence_has_the_anchor_and_its_own_digest(spark):
    assert all(re.search(licences.ANCHOR.removeprefix("(?i)"), t, re.IGNORECASE) for _, t in licences.KNOWN)
    digests = licences.known_digests(spark).collect()
    assert len({r.digest for r in digests}) == len(digests) >= len(licences.KNOWN) - 1


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 1").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash", "mixing", "packing"]
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = held
        held = stage(spark, held, folder).cache()
        assert held.columns == docs.columns, name
        ids = {r.doc_id for r in held.select("doc_id").collect()}
        earlier = {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= earlier
        if name == "line_dedup":
            assert ids == earlier
    assert len(toxic & {r.doc_id for r in held.collect()}) <= 0.5 * len(toxic)
    packed = corpus_pipeline.STAGES[-1][1](spark, held, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in held.select("doc_id").collect()}
