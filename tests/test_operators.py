import itertools
import math
import os
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill import session
from textmill.catalog import all_queries
from textmill.functions.expressions import item_counts
from textmill.operators import audit, coherence, cosine, eda, ngrams, shape, tfidf, threads, topics, vocabulary
from textmill.operators.ordering import global_running
from textmill.plans import language
from textmill.sources import files, tables


def documents(seed=3, n=40, words="abcdefgh", longest=25):
    pick = random.Random(seed)
    return [(i, [pick.choice(words) for _ in range(pick.randint(0, longest))]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, t array<string>").repartition(3)


def test_global_running_equals_a_plain_loop(spark):
    rows = [(f"w{i}", (i * 7919) % 13 + 1) for i in range(500)]
    df = spark.createDataFrame(rows, "word string, n long").repartition(5)
    found = global_running(df, [F.desc("n"), F.asc("word")], sums={"run": "n"}, rank="pos").collect()
    total = 0
    for pos, (word, n) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        total += n
        row = next(r for r in found if r.word == word)
        assert (row.pos, row.run) == (pos, total)


def test_quantiles_with_a_hot_value(spark):
    values = [5.0] * 400 + [float(i) for i in range(600)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {r.share: r.value for r in eda.quantiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]).collect()}
    plain = [v for v in values if v is not None]
    assert found == {q: pytest.approx(float(np.quantile(plain, q))) for q in found}


def test_histogram_equals_numpy(spark):
    values = [0.0, 0.5, 1.0, 2.5, 9.9, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {r["bin"] - 1: r.n for r in eda.histogram(df, "v", 4).collect()}
    counts, _ = np.histogram(values, bins=4)
    assert found == {i: c for i, c in enumerate(counts) if c}


def chi_bigrams(tokens):
    n, pairs, single = len(tokens), Counter(zip(tokens, tokens[1:])), Counter(tokens)
    scored = []
    for (a, b), ii in pairs.items():
        oi, io = single[b] - ii, single[a] - ii
        oo = n - ii - oi - io
        below = (ii + io) * (ii + oi) * (io + oo) * (oi + oo)
        scored.append((-round(n * (ii * oo - io * oi) ** 2 / below, 6) if below else 0.0, a, b))
    return [f"{a} {b}" for _, a, b in sorted(scored)]


def chi_trigrams(tokens):
    n, one = len(tokens), Counter(tokens)
    two = Counter(zip(tokens, tokens[1:]))
    wild, three = Counter(zip(tokens, tokens[2:])), Counter(zip(tokens, tokens[1:], tokens[2:]))
    scored = []
    for (a, b, c), iii in three.items():
        cells = {(1, 1, 1): iii}
        cells[0, 1, 1], cells[1, 0, 1], cells[1, 1, 0] = two[b, c] - iii, wild[a, c] - iii, two[a, b] - iii
        cells[0, 0, 1] = one[c] - iii - cells[0, 1, 1] - cells[1, 0, 1]
        cells[0, 1, 0] = one[b] - iii - cells[0, 1, 1] - cells[1, 1, 0]
        cells[1, 0, 0] = one[a] - iii - cells[1, 0, 1] - cells[1, 1, 0]
        cells[0, 0, 0] = n - sum(cells.values())
        score = 0.0
        for cell, seen in cells.items():
            margin = [sum(v for k, v in cells.items() if k[i] == cell[i]) for i in range(3)]
            expected = margin[0] * margin[1] * margin[2] / n**2
            score += (seen - expected) ** 2 / (expected + 1e-20)
        scored.append((-round(score, 6), a, b, c))
    return [f"{a} {b} {c}" for _, a, b, c in sorted(scored)]


@pytest.mark.parametrize(
    "operator,plain", [(ngrams.bigram_collocations, chi_bigrams), (ngrams.trigram_collocations, chi_trigrams)]
)
def test_collocations_equal_brute_force(spark, operator, plain):
    rows = documents() + [(100, ["a", "a"]), (101, ["a"]), (102, []), (103, ["a", "b", "a", "b", "c"])]
    found = operator(frame(spark, rows), "id", "t", top=10).orderBy("id", "rank").collect()
    listed = {}
    for row in found:
        listed.setdefault(row.id, []).append(row.ngram)
    assert listed == {i: plain(t)[:10] for i, t in rows if plain(t)}


def test_collocations_are_added_to_every_row(spark):
    rows = [(1, ["a", "b", "c"]), (2, []), (3, ["a"])]
    made = {r.id: r for r in ngrams.with_collocations(frame(spark, rows), "id", "t").collect()}
    assert made[1].ngrams[:3] == ["a", "b", "c"] and "a b c" in made[1].trigrams and len(made[1].bigrams) == 2
    assert made[2].ngrams == [] and made[3].ngrams == ["a"]


def test_collocations_shuffle_nothing(spark):
    plan = ngrams.bigram_collocations(spark.range(10).select(F.col("id"), F.array(F.lit("a")).alias("t")), "id", "t")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


def test_dictionary_thresholds(spark):
    rows = [(d, [f"w{i:02d}" for i in range(1, 11) if d < i]) for d in range(10)]
    rows.append((10, ["?"]))
    df = frame(spark, rows)
    kept = vocabulary.build_dictionary(df, "t", no_below=3, no_above=0.5)
    assert [r.token for r in kept.orderBy("token_id").collect()] == ["?", "w03", "w04", "w05"]
    top = vocabulary.build_dictionary(df, "t", keep_n=2)
    assert {r.token for r in top.collect()} == {"w09", "w10"}
    free = vocabulary.build_dictionary(df, "t", no_below=3, no_above=0.5, keep_n=None)
    assert sorted(map(tuple, free.collect())) == sorted(map(tuple, kept.collect()))


def test_most_frequent_by_ranges(spark):
    rows = [(f"w{i:03d}", i % 7, i) for i in range(200)]
    df = spark.createDataFrame(rows, "token string, df long, cf long").repartition(4)
    expected = {r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))[:60]}
    assert {r.token for r in vocabulary.most_frequent(df, 60).collect()} == expected


def test_token_statistics(spark):
    rows = documents(4)
    found = {r.token: (r.df, r.cf) for r in vocabulary.token_statistics(frame(spark, rows), "t").collect()}
    df, cf = Counter(), Counter()
    for _, tokens in rows:
        df.update(set(tokens))
        cf.update(tokens)
    assert found == {t: (df[t], cf[t]) for t in cf}


def test_bag_of_words_and_vectors(spark):
    rows = documents(5)
    df = frame(spark, rows)
    ids = vocabulary.build_dictionary(df, "t", no_below=2, no_above=0.9).cache()
    counts = sorted(map(tuple, vocabulary.doc2bow(df, "id", "t", ids).collect()))
    known = {r.token for r in ids.collect()}
    assert sum(c for *_, c in counts) == sum(t in known for _, tokens in rows for t in tokens)
    bows = vocabulary.with_bow(df, "id", "t", ids).collect()
    assert len(bows) == len(rows) and all(b.bow == sorted(b.bow) for b in bows)
    made = vocabulary.with_vectors(df, "t", ids)
    assert made.columns == [*df.columns, "features"]
    found = [(r.id, int(i), int(v)) for r in made.collect() for i, v in zip(r.features.indices, r.features.values)]
    assert sorted(found) == counts and made.count() == len(rows)
    twice = vocabulary.with_vectors(df.union(df), "t", ids)
    assert sorted(str(r.features) for r in twice.collect()) == sorted(2 * [str(r.features) for r in made.collect()])


def shown(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_item_counts(spark):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["c"])]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    found = {r.id: r.n for r in df.select("id", item_counts(F.col("t")).alias("n")).collect()}
    assert found == {1: [("a", 1), ("b", 2)], 2: [], 3: None, 4: [("c", 1)]}


def test_bags_and_vectors_list_no_entries_by_group(spark):
    df = frame(spark, documents(5))
    ids = vocabulary.build_dictionary(df, "t", no_below=2, no_above=0.9)
    for made in (vocabulary.with_bow(df, "id", "t", ids), vocabulary.with_vectors(df, "t", ids)):
        assert "collect_list" not in shown(made) and "MapInArrow" in shown(made)
    assert vocabulary.with_vectors(df, "t", ids, keep=["id"]).columns == ["id", "features"]
    assert vocabulary.with_vectors(df, "t", ids, keep=()).count() == df.count()


def test_bags_of_repeated_and_null_keys(spark):
    rows = [(1, ["a", "b"]), (1, ["b"]), (None, ["a"]), (None, ["a"]), (2, ["z"]), (3, [])]
    df = spark.createDataFrame(rows * 3, "id int, t array<string>").repartition(3)
    ids = spark.createDataFrame([(0, "a", 1, 1), (1, "b", 1, 1)], "token_id long, token string, df long, cf long")
    found = Counter((r.id, tuple(map(tuple, r.bow))) for r in vocabulary.with_bow(df, "id", "t", ids).collect())
    assert found == {(1, ((0, 3), (1, 6))): 6, (None, ()): 6, (2, ()): 3, (3, ()): 3}
    counts = {(r.id, r.token_id): r.cnt for r in vocabulary.doc2bow(df, "id", "t", ids).collect()}
    assert counts == {(1, 0): 3, (1, 1): 6, (None, 0): 6}


def test_runs_of_keys_cross_batches():
    rows = [(key, at) for key in range(40) for at in range(1 + key % 7 * 5)]
    table = pa.table({"key": [k for k, _ in rows], "token_id": [at // 2 for _, at in rows], "cnt": [1] * len(rows)})
    made = [pa.Table.from_batches([b]) for b in vocabulary._bows("key")(iter(table.to_batches(max_chunksize=3)))]
    found = pa.concat_tables(made).to_pylist()
    assert [r["key"] for r in found] == list(range(40))
    for r in found:
        expected = Counter(at // 2 for k, at in rows if k == r["key"])
        assert [(x["id"], x["cnt"]) for x in r["bow"]] == sorted(expected.items())


def test_tfidf_shuffles_compact_rows_once(spark):
    plan = shown(tfidf.tfidf(frame(spark, documents(6, words=LONG_WORDS)), "id", "t", 3, 0.8).select("id", "term", "score"))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_tfidf_of_repeated_keys(spark):
    rows = documents(6, words=LONG_WORDS)
    split = [(i, part) for i, tokens in rows for part in (tokens[::2], tokens[1::2])]
    found = {(r.id, r.term): r.score for r in tfidf.tfidf(frame(spark, split), "id", "t", 3, 0.8, len(rows)).collect()}
    plain = plain_tfidf(rows, 3, 0.8)
    assert found.keys() == plain.keys() and all(found[k] == pytest.approx(plain[k]) for k in plain)


def test_top_words_only_reads_stored_tokens(spark, tmp_path):
    rows = [(i, "one two" if i % 2 else "three three four", "en", "a", 0) for i in range(12)] + [(12, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = all_queries()["top_words_only"](spark, str(tmp_path))
    assert "regexp_replace" not in shown(found)
    assert {r.doc_id: r.tokens for r in found.collect()} == {
        i: "one, two" if i % 2 else "three, three, four" for i in range(12)
    } | {12: ""}


def test_top_words_keep_order_and_empty_rows(spark):
    df = frame(spark, [(1, ["b", "x", "a", "b"]), (2, ["x"]), (3, [])])
    listed = spark.createDataFrame([("a",), ("b",)], "token string")
    found = {r.id: r.k for r in vocabulary.only_top_words(df, "id", "t", listed, "k").collect()}
    assert found == {1: ["b", "a", "b"], 2: [], 3: []}
    found = {r.id: r.k for r in vocabulary.without_listed(df, "id", "t", listed, "k").collect()}
    assert found == {1: ["x"], 2: ["x"], 3: []}


def plain_tfidf(rows, min_df, max_df):
    n = len(rows)
    df = Counter(t for _, tokens in rows for t in set(tokens))
    kept = {t for t, c in df.items() if min_df <= c <= max_df * n}
    result = {}
    for i, tokens in rows:
        raw = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(tokens).items() if t in kept}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for t, v in raw.items():
            result[i, t] = v / norm
    return result


LONG_WORDS = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "ii", "jj", "kk", "ll"]


def test_tfidf_equals_the_formula(spark):
    rows = documents(6, words=LONG_WORDS)
    found = {(r.id, r.term): r.score for r in tfidf.tfidf(frame(spark, rows), "id", "t", 3, 0.8).collect()}
    plain = plain_tfidf(rows, 3, 0.8)
    assert found.keys() == plain.keys() and all(found[k] == pytest.approx(plain[k]) for k in plain)


@pytest.mark.parametrize("block", [2048, 3])
@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 0.95])
def test_cosine_pairs_equal_brute_force(spark, threshold, block):
    rows = documents(8, n=60, words=LONG_WORDS, longest=9)
    plain = plain_tfidf(rows, 1, 1.0)
    by_doc = {}
    for (i, t), v in plain.items():
        by_doc.setdefault(i, {})[t] = v
    expected = {}
    for a, b in itertools.combinations(sorted(by_doc), 2):
        cosine = sum(v * by_doc[b].get(t, 0.0) for t, v in by_doc[a].items())
        if round(cosine, 6) >= threshold:
            expected[a, b] = round(cosine, 6)
    scores = tfidf.tfidf(frame(spark, rows), "id", "t", 1, 1.0)
    found = {(r.left, r.right): r.cosine for r in tfidf.cosine_pairs(scores, "id", threshold, block).collect()}
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k], abs=2e-6) for k in found)


def test_cosine_pairs_shuffle_vectors_not_matches(spark, capsys):
    rng = random.Random(5)
    texts = [[(f"t{w}", rng.random() + 0.1) for w in rng.sample(range(6000), 1500)] for _ in range(20)]
    texts += [[(t, s * 0.9) for t, s in text[:1200]] for text in texts[:10]] + [[("common", 0.5), (f"own{i}", 1.0)] for i in range(50)]
    rows = []
    for i, text in enumerate(texts):
        length = math.sqrt(sum(s * s for _, s in text))
        rows += [(None if i == 79 else f"d{i}", t, 1, s / length) for t, s in text]
    by_doc = {}
    for i, t, _, s in rows:
        by_doc.setdefault(i, {})[t] = s
    expected = {}
    for a, b in itertools.combinations(sorted(k for k in by_doc if k), 2):
        product = sum(v * by_doc[b].get(t, 0.0) for t, v in by_doc[a].items())
        if round(product, 6) >= 0.7:
            expected[a, b] = round(product, 6)
    scores = spark.createDataFrame(rows, "id string, term string, df long, score double")
    for block in (40, 7):
        pairs = tfidf.cosine_pairs(scores, "id", 0.7, block)
        found = {(r.left, r.right): r.cosine for r in pairs.collect()}
        assert len(found) == 10 and found.keys() == expected.keys()
        assert all(found[k] == pytest.approx(expected[k], abs=2e-6) for k in found)
        pairs.explain()
        assert "Join" not in capsys.readouterr().out  # no row for each match of a term


@pytest.mark.parametrize("block", [2048, 7])
@pytest.mark.parametrize("with_length", [True, False])
def test_cosine_pairs_of_copies(spark, block, with_length):
    rng = random.Random(11)
    texts = [[rng.choice(LONG_WORDS) for _ in range(rng.randint(1, 9))] for _ in range(12)]
    rows = [(i, texts[i % 12] if i < 30 else texts[0]) for i in range(45)]
    plain = plain_tfidf(rows, 1, 1.0)
    by_doc = {}
    for (i, t), v in plain.items():
        by_doc.setdefault(i, {})[t] = v
    expected = {}
    for a, b in itertools.combinations(sorted(by_doc), 2):
        similar = round(sum(v * by_doc[b].get(t, 0.0) for t, v in by_doc[a].items()), 6)
        if similar >= 0.8:
            expected[a, b] = similar
    scores = tfidf.tfidf(frame(spark, rows), "id", "t", 1, 1.0, with_length=with_length)
    found = tfidf.cosine_pairs(scores, "id", 0.8, block).collect()
    assert len(found) == len(expected) and sum(v == 1.0 for v in expected.values()) > 100
    assert all(r.cosine == pytest.approx(expected[r.left, r.right], abs=2e-6) for r in found)


def test_high_products_of_long_vectors_and_repeated_terms(spark):
    rng = random.Random(3)
    vectors = {f"v{i}": [(f"t{rng.randrange(30)}", rng.uniform(-20, 40)) for _ in range(rng.randint(1, 40))] for i in range(40)}
    sums = {}
    for key, entries in vectors.items():
        for t, s in entries:
            sums.setdefault(key, Counter())[t] += s
    expected = {}
    for a, b in itertools.combinations(sorted(vectors), 2):
        product = sum(s * sums[b][t] for t, s in sums[a].items())
        if product >= 4000:
            expected[a, b] = product
    rows = [(key, t, s) for key, entries in vectors.items() for t, s in entries] + [(None, "t1", 900.0), ("v1", "t1", None)]
    found = cosine.high_products(spark.createDataFrame(rows, "id string, term string, score double"), "id", 4000.0).collect()
    assert expected and {(r.left, r.right): pytest.approx(r.product) for r in found} == expected


def test_representatives(spark):
    df = frame(spark, [(3, ["a", "b"]), (1, ["b", "a"]), (2, ["a", "a", "b"])])
    pairs = [(r.representative, r.member) for r in tfidf.members(df, "id", "t").collect()]
    assert sorted(m for _, m in pairs) == sorted(r.id for r in df.collect())
    found = sorted((r.representative, r.copies) for r in tfidf.representatives(df, "id", "t").collect())
    assert found == sorted(Counter(r for r, _ in pairs).items())
    assert found == [(1, 2), (2, 1)]


def test_umass_and_windows(spark):
    rows = [(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["a"]), (4, [])]
    pairs = {(r.word, r.earlier): r for r in coherence.umass_pairs(frame(spark, rows), "t", [["a", "b", "z"]]).collect()}
    assert pairs["b", "a"].score == pytest.approx(math.log((2 / 4 + 1e-12) / (3 / 4)))
    assert pairs["z", "a"].joint == 0 and pairs["z", "b"].score == pytest.approx(math.log(1e-12 / (2 / 4)))
    tokens = ["a", "x", "b", "x", "x", "a"]
    found = {(r["first"], r["second"]): r.n for r in coherence.window_counts(frame(spark, [(1, tokens)]), "t", ["a", "b"], 3).collect()}
    windows = [set(tokens[i : i + 3]) for i in range(4)]
    assert found["", ""] == 4 and found["a", "b"] == sum({"a", "b"} <= w for w in windows)
    assert found["a", "a"] == sum("a" in w for w in windows)
    assert -1 <= coherence.c_v(frame(spark, rows), "t", [["a", "b"]]).first().coherence <= 1.0001


def test_audit_pairs(spark):
    rows = [(1, "5,28,18", "x~~y,z"), (2, "5,28", "x"), (3, "5", ""), (4, "5,", "a~b~")]
    df = spark.createDataFrame(rows, "id int, m string, d string")
    found = {(r.id, r.attribute): r.value for r in audit.unpivot_audit(df, "id", "m", "d").collect()}
    assert found == {(1, "5"): "x", (1, "28"): "", (1, "18"): "y,z", (2, "5"): "x", (3, "5"): "", (4, "5"): "a", (4, ""): "b"}
    values = {(r.id, r.entry): (r.value, r.identifier) for r in audit.changed_values(df, "id", "m", "d").collect()}
    assert values[1, "18"] == ("y", "z") and values[1, "5"] == ("x", None) and (3, "5") not in values
    assert spark.range(1).select(audit.trim_mask(F.lit(",5,28,"))).first()[0] == "5,28"


def test_threads(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (2, 0, "assistant", "n")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = {r.conv_id: r for r in threads.thread_summary(df).collect()}
    assert found[1].first_response_body == "a" and found[1].last_message_body == "r" and found[1].has_response_from_member
    assert not found[2].has_member_message and found[2].first_member_message_body is None


def test_samples_and_complements(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    sample = shape.sample_n(df, 100, "k", 7)
    rest = shape.without(df, sample, "k")
    order = F.md5(F.concat_ws("-", F.col("k").cast("string"), F.lit("7")))
    plain = {r.k for r in df.orderBy(order).limit(100).collect()}
    assert {r.k for r in sample.collect()} == plain
    for n in (1, 100, 999):
        cut = {r.k for r in shape.sample_n(df, n, "k", 7).collect()}
        assert cut == {r.k for r in df.orderBy(order).limit(n).collect()}
    assert sample.count() == 100 and rest.count() == 900 and sample.union(rest).distinct().count() == 1000
    assert shape.sample_n(df, 5000, "k").count() == 1000 == shape.sample_n(df, 0, "k").count()
    assert 150 < shape.sample_fraction(df, 0.2, "k").count() < 250
    assert shape.sample_fraction(df, 1.0, "k").count() == 1000


def test_scope(spark):
    df = spark.createDataFrame([("a", "Team One"), (None, "Team One"), ("b", None), ("c", "Two")], "t string, g string")
    assert shape.in_scope(df, "t", "g", "One").count() == 1
    assert shape.in_scope(df, "t", "g", "All").count() == 3 == shape.in_scope(df, "t").count()


def test_language_gate(spark):
    predictions = spark.createDataFrame(
        [(1, 0.7, 2), (1, 0.3, 5), (2, 0.5, 7), (2, 0.5, 5), (3, 0.9, 1), (4, 1.0, 7)],
        "id int, pred_probability double, pred_index int",
    )
    messages = spark.createDataFrame([(1, "Hej"), (2, "Dear x"), (3, "Hej"), (4, "Hej")], "id int, body string")
    foreign = F.col("body").like("Dear%")
    sides = {r.id: r.side for r in language.gate(messages, predictions, "id", [5, 7], foreign).collect()}
    assert sides == {1: "neither", 2: "out_of_scope", 3: "train", 4: "neither"}
    most = {r.id: r.side for r in language.gate(messages, predictions, "id", [5, 7], foreign, most_probable=True).collect()}
    assert most[1] == "train"
    named = spark.createDataFrame([(0, "da"), (0, "da"), (0, "en"), (1, "en")], "pred_index int, lang string")
    assert {r.pred_index: r.pred_label for r in language.languages_of_topics(named, "lang").collect()} == {0: "da", 1: "en"}


def test_labels_stay_null_for_unnamed_topics(spark):
    df = spark.createDataFrame([(1, 0), (2, 9), (3, None)], "id int, pred_index int")
    found = {r.id: r.pred_label for r in topics.with_label(df, topics.topic_names(spark, ["first"])).collect()}
    assert found == {1: "first", 2: None, 3: None}


def test_least_probable_breaks_ties_by_index(spark):
    df = spark.createDataFrame([(1, 0.5, 3), (1, 0.5, 2), (1, 0.9, 1)], "k int, p double, i int")
    assert eda.least_probable(df, "k", "p", "i").first().i == 2
    assert eda.least_probable(df, "k", "p", "i", most=True).first().i == 1


def test_csv_fails_on_bad_rows_and_wide_values(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text('ContentID;ContentUrl\r\n1;a "b"\r\n2;\r\n', encoding="utf-8")
    read = files.read_articles(spark, str(good), ["ContentID", "ContentUrl"])
    assert [(r.ContentID, r.ContentUrl) for r in read.orderBy("ContentID").collect()] == [("1", 'a "b"'), ("2", None)]
    bad = tmp_path / "bad.csv"
    bad.write_text("ContentID;ContentUrl\r\n1;a;b;c\r\n", encoding="utf-8")
    with pytest.raises(Exception):
        files.read_articles(spark, str(bad), ["ContentID", "ContentUrl"]).collect()
    wide = spark.createDataFrame([("x" * 501,)], "ContentID string")
    assert files.too_wide(wide, files.ARTICLE_WIDTHS).count() == 1
    with pytest.raises(Exception):
        files.checked_widths(wide).collect()


def test_word_list_drops_mark_and_line_ends(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_bytes("﻿!\ntak for\n\nhej\r\n".encode())
    assert files.words_of(files.word_list(spark, str(path))) == ["!", "hej", "tak for"]
    with pytest.raises(ValueError):
        files.words_of(files.word_list(spark, str(path)), most=2)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", [])], "id int, g string, t array<string>")
    files.write_groups(df, str(tmp_path / "groups"), "g")
    assert spark.read.parquet(str(tmp_path / "groups")).filter("g = 'a'").count() == 1
    for _ in range(2):
        files.append_table(df, str(tmp_path / "append"))
        files.replace_table(df, str(tmp_path / "replace"))
    assert spark.read.parquet(str(tmp_path / "append")).count() == 4
    assert spark.read.parquet(str(tmp_path / "replace")).count() == 2
    files.export_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).filter("id = 1").first().t == "x, y"


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x", query="select 1", partition_column="id", bounds=(0, 9), partitions=3)
    assert options["dbtable"] == "(select 1) AS source" and options["numPartitions"] == "3"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", table_name="t", partition_column="id")


def test_only_runs_that_can_be_ranked_leave_python(spark):
    scores = np.array([5.0, 1.0, 3.0, 3.0000004, 0.5, 3.0 - 4e-7, 2.9])
    assert list(np.flatnonzero(ngrams._highest(scores, 2))) == [0, 2, 3, 5]  # equal after rounding
    assert scores[ngrams._highest(scores, 7)].size == 7
    words = [f"w{i * i % 37}" for i in range(300)]
    df = spark.createDataFrame([(1, words), (2, None), (3, ["a"])], "id int, t array<string>")
    few = df.select("id", F.size(ngrams._scored(F.col("t"), 2, ngrams._pairs, 5)).alias("n")).where("id = 1").first().n
    whole = df.select("id", F.size(ngrams._scored(F.col("t"), 2, ngrams._pairs, 10**6)).alias("n")).where("id = 1").first().n
    assert 5 <= few < whole
    for make in (ngrams.bigram_collocations, ngrams.trigram_collocations):
        every = make(df, "id", "t", top=10**6).where("rank <= 5").collect()
        assert sorted(map(tuple, make(df, "id", "t", top=5).collect())) == sorted(map(tuple, every))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    rows = spark.range(2000).withColumn("k", F.col("id") % 97).groupBy("k").agg(F.count("*").alias("n"))
    before, kept = files(), spark.conf.get(session.DROP_SHUFFLES, None)
    stored = session.materialise(rows)
    for _ in range(50):  # files go in the background
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and spark.conf.get(session.DROP_SHUFFLES, None) == kept
    assert stored.agg(F.sum("n")).first()[0] == 2000 and os.path.isdir(stored._stored_at.removeprefix("file:"))
    session.discard(stored)
    assert not os.path.exists(stored._stored_at.removeprefix("file:"))
