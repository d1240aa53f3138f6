import random
import re

from pyspark.sql import functions as F

from textmill.functions import features, fixed, stem, vectors
from textmill.functions import tokens as tok
from textmill.operators import sentences, shape


def test_word_tokens(column):
    given = ["a-kasse 2020 _x_ hvad?! 12 b3", "", None, "bob's can't, 3,14 a:b 1:2 x...y u--v [q](r)", "før æble «ord»"]
    assert column(given, tok.word_tokens) == [
        ["akasse", "x", "hvad", "?", "!", "b"],
        [],
        None,
        ["bob", "s", "ca", "nt", "a", "b", "x", "y", "u", "v", "q", "r"],
        ["før", "æble", "ord"],
    ]


def test_whole_text_cleanup_equals_token_cleanup(column):
    pick = random.Random(7)
    signs = list("ab_1? !.-,;'æ \n") + ["n't", "'s ", "...", "--", "__", "12_"]
    given = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(500)]
    assert column(given, tok.word_tokens) == column(given, lambda c: tok.clean_tokens(tok.raw_tokens(c)))


def test_everygrams(column):
    assert column(["a b a", "a", ""], lambda c: tok.everygrams(tok.word_tokens(c), 2)) == [
        ["a", "b", "a", "a_b", "b_a"], ["a"], [],
    ]
    assert column(["a ! b"], lambda c: tok.tokenize(c, 2)) == [["a", "!", "b", "a", "b"]]


def test_skip_pairs(column):
    pairs = column(["a b c d", "a", ""], lambda c: tok.skip_pairs(tok.word_tokens(c)))
    assert [tuple(p) for p in pairs[0]] == [
        ("a", "b"), ("b", "c"), ("c", "d"), ("a", "c"), ("b", "d"), ("a", "c"),
    ]
    assert pairs[1] == [] and pairs[2] == []


def test_stopwords_match_whole_phrases(spark):
    df = spark.createDataFrame([(["tak", "tak for", "tak for alt", "hus", "hus", "hav en god"],)], "t array<string>")
    kept = df.select(tok.remove_stopwords(F.col("t"), tok.stopwords()).alias("t")).first().t
    assert kept == ["tak for alt", "hus", "hus"]
    assert "og" in tok.stopwords() and "nyt" in tok.stopwords(extra=["nyt"])


def test_danish_list_is_the_public_one(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert set(fixed.DANISH_STOPWORDS) == set(StopWordsRemover.loadDefaultStopWords("danish"))


def test_strings_and_lists_are_not_inverse(spark):
    df = spark.createDataFrame([(["a", "b"],)], "t array<string>")
    joined = df.select(tok.join_tokens(F.col("t")).alias("s"))
    assert joined.select(tok.split_tokens(F.col("s")).alias("t")).first().t == ["a", " b"]


def test_sentences(column):
    given = ["En. to\n\n ..tre.fire.. \n", "", None]
    assert column(given, tok.split_sentences) == [["En", "to", "tre", "fire"], [], None]


def test_normalised_sentences(column):
    def plain(text):
        for pattern, replacement in fixed.SENTENCE_NORMALISE:
            text = re.sub(pattern, replacement, text)
        return text

    given = ["senest 23. maj den 5. juni til 27.06 a??  b", "linje\r\nto tre den 12.", "x 3.4. y"]
    assert column(given, tok.normalise_sentences) == [plain(t) for t in given]


def test_tags_first_rule_wins_and_ending_stays(spark):
    text = "kære bo.\nkan i hjælpe?\nmvh bo\nps: mere"
    df = spark.createDataFrame([(1, text), (2, "Intet"), (3, None)], "id int, text string")
    rows = sentences.tagged_sentences(df, "id", "text").orderBy("id", "pos").collect()
    assert [(r.id, r.tag) for r in rows] == [
        (1, "GREETING"), (1, "QUESTION"), (1, "ENDING"), (1, "AFTER ENDING"), (2, "CONTENT"),
    ]
    older = sentences.tagged_sentences(df, "id", "text", fixed.SENTENCE_TAGS_OLDER, after_ending=False)
    assert [r.tag for r in older.filter("id = 1").orderBy("pos").collect()][-1] == "CONTENT"


def test_sentences_by_tag_spreads_a_large_tag(spark):
    rows = [(1, i, f"s{i % 500}", "CONTENT") for i in range(1000)] + [(1, 1000, "hej", "GREETING")]
    tagged = spark.createDataFrame(rows, "id int, pos int, sentence string, tag string")
    listed = sentences.sentences_by_tag(tagged, part_size=100).collect()
    content = [r for r in listed if r.tag == "CONTENT"]
    assert len(content) > 2 and sum(len(r.sentences) for r in content) == 500
    assert sum(r.occurrences for r in listed) == 1001


def test_danish_stems():
    table = {
        "kørende": "kør", "biler": "bil", "husenes": "hus", "menneskerne": "mennesk", "venlighed": "ven",
        "kortene": "kort", "indtagelse": "indtag", "undersåtternes": "undersåt", "arbejdsløst": "arbejdsløs",
        "lovligst": "lov", "og": "og", "frakke": "frak",
    }
    assert {w: stem.danish_stem(w) for w in table} == table


def test_english_stems():
    table = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
        "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
        "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss", "failing": "fail", "filing": "file",
        "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "digitizer": "digit",
        "triplicate": "triplic", "formalize": "formal", "hopefulness": "hope", "revival": "reviv",
        "adjustment": "adjust", "adoption": "adopt", "effective": "effect", "probate": "probat", "rate": "rate",
        "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die",
    }
    assert {w: stem.english_stem(w) for w in table} == table


def test_stems_keep_nulls(spark):
    df = spark.createDataFrame([(["biler", "cats"],), (None,)], "t array<string>")
    assert [r.s for r in df.select(stem.danish_stems(F.col("t")).alias("s")).collect()] == [["bil", "cat"], None]


def test_features(spark):
    words = ["", "a", "a b c d e", "a b c d e f", " ".join("abcdefghijkl"), " ".join("abcdefghijklm"), None]
    df = spark.createDataFrame([(w,) for w in words], "t string").coalesce(1)
    made = features.with_text_features(df, "t").collect()
    assert [r.t_WordCount_Bucket for r in made] == ["Empty", "Simple", "Simple", "Normal", "Normal", "Complex", "Empty"]
    assert made[0].t_CharCount == 0 and made[6].t_CharCount is None


def test_date_parts_keep_the_mixed_year_and_week(spark):
    df = spark.sql("SELECT timestamp '2024-12-30 10:00:00' AS at")
    row = features.with_date_parts(df, "at").first()
    assert (row.Week, row.Year_Week, row.Weekday, row.Month, row.Year_Month) == (1, "2024-W01", 0, 12, "2024-12")


def test_topword_features(spark):
    df = spark.createDataFrame([("a b a",), ("c",)], "t string").coalesce(1)
    rows = features.with_topword_features(df, "t", ["a", "b", "z"]).collect()
    assert [(r.topwords_count, r.topwords_found, r.a, r.z) for r in rows] == [(3, True, True, False), (0, False, False, False)]


def test_best_topic(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3],), ([0.4, 0.4, 0.2],), ([0.0, 0.0],), (None,)], "v array<double>").coalesce(1)
    found = [tuple(r.b) for r in df.select(vectors.best_topic(F.col("v")).alias("b")).collect()]
    assert found == [(0.5, 1), (0.4, 0), (0.0, None), (0.0, None)]
    scores = [r.s for r in df.select(vectors.topic_score(F.col("v"), 2, 0.25).alias("s")).collect()]
    assert scores == [0.3, None, None, None]


def test_subject_concat_is_null_with_null_parts(spark):
    df = spark.createDataFrame([("a", "s", 1), ("a", None, 1), ("a", None, 0)], "t string, s string, f int").coalesce(1)
    joined = shape.subject_in_first_message(F.col("t"), F.col("s"), F.col("f") == 1)
    assert [r.x for r in df.select(joined.alias("x")).collect()] == ["a s", None, "a"]


def test_stems_look_at_every_distinct_token_of_a_batch_once(spark):
    seen = []

    def numbered(token):
        seen.append(token)
        return f"{token}{len(seen)}"

    rows = [(1, ["a", "b", "a"]), (2, None), (3, []), (4, ["b", "c", "a"])]
    df = spark.createDataFrame(rows, "i int, t array<string>").coalesce(1)
    got = {r.i: r.s for r in df.select("i", stem._stems(F.col("t"), numbered).alias("s")).collect()}
    assert got == {1: ["a1", "b2", "a1"], 2: None, 3: [], 4: ["b2", "c3", "a1"]}
