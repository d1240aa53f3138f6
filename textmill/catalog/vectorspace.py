"""Queries on dictionaries, bags of words, tf-idf, topic vectors and coherence."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.registry import query
from textmill.catalog.relational import documents
from textmill.functions import tokens as tok
from textmill.catalog.sql import in_list, quoted, tokens
from textmill.catalog.text import LOWER_TOKENS, tokenized
from textmill.functions.expressions import explode_rows, inline_rows
from textmill.operators import coherence, eda, tfidf, topics, vocabulary
from textmill.plans import language
from textmill.session import materialise
from textmill.sources.tables import table

ROWS = f"t AS (SELECT doc_id, unnest({LOWER_TOKENS}) AS token FROM documents)"
STATISTICS = f"{ROWS}, s AS (SELECT token, count(DISTINCT doc_id) AS df, count(*) AS cf FROM t GROUP BY token)"
DICTIONARY = f"""{STATISTICS}, k AS (SELECT * FROM s WHERE (df >= 5 AND df <= floor(0.5 * (SELECT count(*) FROM documents)))
    OR token = '?' ORDER BY df DESC, token LIMIT 2000),
    d AS (SELECT row_number() OVER (ORDER BY token) - 1 AS token_id, token, df, cf FROM k)"""
#: the dictionary of the bags of words: the same filter, every word that passes it
WHOLE = f"""{STATISTICS}, k AS (SELECT * FROM s WHERE (df >= 5 AND df <= floor(0.5 * (SELECT count(*) FROM documents)))
    OR token = '?'),
    d AS (SELECT row_number() OVER (ORDER BY token) - 1 AS token_id, token, df, cf FROM k)"""


def dictionary(spark, sf):
    return vocabulary.build_dictionary(tokenized(spark, sf), "tokens", no_below=5, no_above=0.5, keep_n=2000)


def stored_tokens(spark, sf):
    """(doc_id, tokens), stored: the dictionary and the bags of words read the same tokens."""
    return materialise(tokenized(spark, sf))


def whole_dictionary(docs):
    """Every word within the document frequencies, as the bags of words of the original preparation use it."""
    return vocabulary.build_dictionary(docs, "tokens", no_below=5, no_above=0.5, keep_n=None)


@query("doc_frequency", f"WITH {STATISTICS} SELECT token, df FROM s")
def doc_frequency(spark, sf):
    return eda.document_frequency(tokenized(spark, sf), "tokens")


@query("dictionary_sizes", f"WITH {DICTIONARY} SELECT (SELECT count(*) FROM s) AS before, (SELECT count(*) FROM d) AS after")
def dictionary_sizes(spark, sf):
    docs = tokenized(spark, sf)
    statistics = vocabulary.token_statistics(docs, "tokens")
    kept = vocabulary.filter_extremes(statistics, docs.count(), 5, 0.5, 2000)
    sizes = statistics.select(F.lit("before").alias("what")).unionByName(kept.select(F.lit("after").alias("what")))
    return sizes.agg(F.count_if(F.col("what") == "before").alias("before"), F.count_if(F.col("what") == "after").alias("after"))


@query("dictionary_filtered", f"WITH {DICTIONARY} SELECT * FROM d")
def dictionary_filtered(spark, sf):
    return dictionary(spark, sf)


@query(
    "dictionary_unbounded",
    f"WITH {STATISTICS} SELECT row_number() OVER (ORDER BY token) - 1 AS token_id, token, df, cf FROM s WHERE df >= 2 OR token = '?'",
)
def dictionary_unbounded(spark, sf):
    return vocabulary.build_dictionary(tokenized(spark, sf), "tokens", no_below=2, keep_n=None)


BOW = f"WITH {WHOLE} SELECT doc_id, token_id, count(*) AS cnt FROM t JOIN d USING (token) GROUP BY doc_id, token_id"


@query("doc2bow", BOW)
def doc2bow(spark, sf):
    docs = stored_tokens(spark, sf)
    return vocabulary.doc2bow(docs, "doc_id", "tokens", whole_dictionary(docs))


@query(
    "bow_arrays",
    f"""SELECT documents.doc_id, coalesce(string_agg(token_id || ':' || cnt, ' ' ORDER BY token_id), '') AS bow FROM documents
    LEFT JOIN ({BOW}) b ON documents.doc_id = b.doc_id GROUP BY documents.doc_id""",
)
def bow_arrays(spark, sf):
    docs = stored_tokens(spark, sf)
    made = vocabulary.with_bow(docs, "doc_id", "tokens", whole_dictionary(docs))
    shown = F.transform("bow", lambda x: F.concat(x["id"].cast("string"), F.lit(":"), x["cnt"].cast("string")))
    return made.select("doc_id", F.array_join(shown, " ").alias("bow"))


@query("vectorized_counts", BOW)
def vectorized_counts(spark, sf):
    """The same counts from sparse vectors, as the models read them."""
    docs = stored_tokens(spark, sf)
    vectors = vocabulary.with_vectors(docs, "tokens", whole_dictionary(docs), keep=["doc_id"])
    parts = F.unwrap_udt("features")
    pairs = F.arrays_zip(parts["indices"].alias("i"), parts["values"].alias("v"))
    return inline_rows(vectors, ["doc_id"], pairs).select(
        "doc_id", F.col("i").cast("long").alias("token_id"), F.col("v").cast("long").alias("cnt")
    )


# --- tf-idf ----------------------------------------------------------------------------------

TERM_ROWS = ROWS.replace("t AS (SELECT", "t AS (SELECT * FROM (SELECT") + r" WHERE regexp_full_match(token, '[\p{L}\p{N}_]{2,}'))"
TFIDF = f"""{TERM_ROWS}, f AS (SELECT doc_id, token AS term, count(*) AS tf FROM t GROUP BY ALL),
    s AS (SELECT term, count(*) AS df FROM f GROUP BY term),
    w AS (SELECT doc_id, term, tf, df, tf * (ln((1.0 + n) / (1 + df)) + 1) AS weight FROM f JOIN s USING (term),
      (SELECT count(*) AS n FROM documents) WHERE df >= 5 AND df <= 0.8 * n),
    x AS (SELECT doc_id, term, tf, df, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS score FROM w)"""


def scores(spark, sf):
    return tfidf.tfidf(tokenized(spark, sf), "doc_id", "tokens")


@query("tfidf", f"WITH {TFIDF} SELECT doc_id, term, tf, df, round(score, 6) AS score FROM x")
def tfidf_scores(spark, sf):
    return scores(spark, sf).withColumn("score", F.round("score", 6))


@query(
    "tfidf_top_doc",
    f"""WITH {TFIDF} SELECT * FROM (SELECT doc_id, term, round(score, 6) AS score,
    row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 6) DESC, term) AS rank FROM x) WHERE rank <= 20""",
)
def tfidf_top_doc(spark, sf):
    return tfidf.top_terms(scores(spark, sf), "doc_id", 20).withColumn("rank", F.col("rank").cast("long"))


@query(
    "tfidf_mean",
    f"""WITH {TFIDF} SELECT term, round(sum(CASE WHEN score >= 0.1 THEN score ELSE 0 END) / (SELECT count(*) FROM documents), 6)
    AS score FROM x GROUP BY term ORDER BY score DESC, term LIMIT 25""",
)
def tfidf_mean(spark, sf):
    return tfidf.top_mean_terms(scores(spark, sf), documents(spark, sf).count())


@query(
    "tfidf_mean_class",
    f"""WITH {TFIDF}, m AS (SELECT quality, term, round(sum(CASE WHEN score >= 0.1 THEN score ELSE 0 END)
    / (SELECT count(*) FROM labels l2 WHERE l2.quality = labels.quality), 6) AS score
    FROM x JOIN labels USING (doc_id) GROUP BY quality, term)
    SELECT * FROM (SELECT quality, term, score, row_number() OVER (PARTITION BY quality ORDER BY score DESC, term) AS rank FROM m)
    WHERE rank <= 10""",
)
def tfidf_mean_class(spark, sf):
    found = tfidf.top_mean_terms_by_class(scores(spark, sf), table(spark, sf, "labels"), "doc_id", "quality")
    return found.withColumn("rank", F.col("rank").cast("long"))


COPIES = f"""c AS (SELECT min(doc_id) AS representative, count(*) AS copies
    FROM (SELECT doc_id, list_sort({LOWER_TOKENS}) AS bag FROM documents) GROUP BY bag)"""


@query("token_copies", f"WITH {COPIES} SELECT representative, copies FROM c")
def token_copies(spark, sf):
    return tfidf.representatives(tokenized(spark, sf), "doc_id", "tokens").drop("signature")


@query(
    "cosine_pairs",
    f"""WITH {TFIDF}
    SELECT * FROM (SELECT a.doc_id AS "left", b.doc_id AS "right", round(sum(a.score * b.score), 6) AS cosine
    FROM x a JOIN x b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id) WHERE cosine >= 0.8""",
)
def cosine_pairs(spark, sf):
    """Every pair of documents, copies too."""
    vectors = tfidf.tfidf(tokenized(spark, sf), "doc_id", "tokens", with_length=True)
    return tfidf.cosine_pairs(vectors, "doc_id", 0.8)


@query(
    "equal_documents",
    f"""SELECT min(doc_id) OVER (PARTITION BY bag) AS representative, doc_id AS member
    FROM (SELECT doc_id, list_sort({LOWER_TOKENS}) AS bag FROM documents)""",
)
def equal_documents(spark, sf):
    return tfidf.members(tokenized(spark, sf), "doc_id", "tokens")


# --- given topic vectors ---------------------------------------------------------------------


def given_vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


@query(
    "best_topic",
    """SELECT vec_id, CASE WHEN m > 0 THEN m ELSE 0 END AS pred_probability, CASE WHEN m > 0 THEN p END AS pred_index
    FROM (SELECT vec_id, list_max(embedding)::DOUBLE AS m, list_position(embedding, list_max(embedding)) - 1 AS p FROM embeddings)""",
)
def best_topic(spark, sf):
    return topics.best_topics(given_vectors(spark, sf), "v").select("vec_id", "pred_probability", "pred_index")


@query(
    "one_topic_score",
    "SELECT vec_id, CASE WHEN embedding[4] >= 0.05 THEN embedding[4]::DOUBLE END AS score FROM embeddings",
)
def one_topic_score(spark, sf):
    from textmill.functions.vectors import topic_score

    return given_vectors(spark, sf).select("vec_id", topic_score(F.col("v"), 3, 0.05).alias("score"))


@query(
    "all_topics_long",
    """SELECT vec_id, i - 1 AS pred_index, p::DOUBLE AS pred_probability FROM (SELECT vec_id, unnest(embedding) AS p,
    generate_subscripts(embedding, 1) AS i FROM embeddings) WHERE p >= 0.1""",
)
def all_topics_long(spark, sf):
    return topics.all_topics(given_vectors(spark, sf).select("vec_id", "v"), "v", 0.1)


MEANS = """(SELECT i - 1 AS topic, avg(p::DOUBLE) AS mean FROM (SELECT unnest(embedding) AS p,
    generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)"""


@query("mean_topic_vector", f"SELECT topic, round(mean, 6) AS mean FROM {MEANS}")
def mean_topic_vector(spark, sf):
    return topics.mean_topic_vector(given_vectors(spark, sf), "v").withColumn("mean", F.round("mean", 6))


@query("top_topics", f"SELECT topic, round(mean, 6) AS mean FROM {MEANS} ORDER BY mean DESC, topic DESC LIMIT 5")
def top_topics(spark, sf):
    return topics.top_topics(topics.mean_topic_vector(given_vectors(spark, sf), "v"), 5).withColumn(
        "mean", F.round("mean", 6)
    )


@query(
    "topic_distribution",
    f"""SELECT topic, round(mean, 6) AS mean, row_number() OVER (ORDER BY mean DESC, topic DESC) <= 5 AS is_top FROM {MEANS}""",
)
def topic_distribution(spark, sf):
    made = topics.distribution_series(topics.mean_topic_vector(given_vectors(spark, sf), "v"))
    return made.withColumn("mean", F.round("mean", 6))


GATE_LONG = """(SELECT vec_id AS doc_id, i - 1 AS pred_index, p FROM (SELECT vec_id, unnest(embedding) AS p,
    generate_subscripts(embedding, 1) AS i FROM embeddings) WHERE p >= 0.05)"""


@query(
    "language_gate",
    f"""SELECT doc_id, remove_english, pred_danish, CASE WHEN remove_english = 1 AND pred_danish = 1 THEN 'train'
    WHEN remove_english = 0 AND pred_danish = 0 THEN 'out_of_scope' ELSE 'neither' END AS side FROM (
    SELECT d.doc_id, CASE WHEN text LIKE 'The%' OR text LIKE 'And%' THEN 0 ELSE 1 END AS remove_english,
    CASE WHEN pred_index IN (5, 7) THEN 0 ELSE 1 END AS pred_danish FROM documents d JOIN (SELECT doc_id, pred_index,
    row_number() OVER (PARTITION BY doc_id ORDER BY p, pred_index) AS rn FROM {GATE_LONG}) l ON d.doc_id = l.doc_id WHERE rn = 1)""",
)
def language_gate(spark, sf):
    long = topics.all_topics(
        given_vectors(spark, sf).select(F.col("vec_id").alias("doc_id"), "v"), "v", 0.05
    )
    foreign = F.col("text").like("The%") | F.col("text").like("And%")
    return language.gate(documents(spark, sf).select("doc_id", "text"), long, "doc_id", [5, 7], foreign).drop("text")


@query(
    "topic_words_join",
    f"""SELECT lang AS topic, n_docs, word, n, round(n / n_docs, 6) AS per_doc FROM (SELECT lang, token AS word, count(*) AS n
    FROM (SELECT lang, unnest({LOWER_TOKENS}) AS token FROM documents) GROUP BY lang, token) JOIN
    (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang) USING (lang)""",
)
def topic_words_join(spark, sf):
    """Words of a group joined with the size of the group, as topic words join topic shares."""
    docs = documents(spark, sf).select("lang", tok.tokenize(F.lower("text")).alias("tokens"))
    words = explode_rows(docs, ["lang"], F.col("tokens"), "word").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    sizes = documents(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    return words.join(sizes, "lang").select(
        F.col("lang").alias("topic"), "n_docs", "word", "n", F.round(F.col("n") / F.col("n_docs"), 6).alias("per_doc")
    )


# --- coherence of given word lists -----------------------------------------------------------

WORD_LISTS = (
    ("the", "and", "of", "to", "in"),
    ("de", "la", "le", "et", "les"),
    ("und", "der", "die", "in", "zu"),
)
_LISTED = "(VALUES " + ", ".join(
    f"({t}, {r}, {quoted(w)})" for t, words in enumerate(WORD_LISTS) for r, w in enumerate(words)
) + ") l(topic, r, w)"
_EVERY = in_list(sorted({w for words in WORD_LISTS for w in words}))

UMASS = f"""WITH {ROWS}, p AS (SELECT DISTINCT doc_id, token FROM t WHERE token IN {_EVERY}), l AS (SELECT * FROM {_LISTED}),
    n AS (SELECT count(*) AS n FROM documents),
    pairs AS (SELECT a.topic, a.w AS word, b.w AS earlier FROM l a JOIN l b ON a.topic = b.topic AND b.r < a.r),
    j AS (SELECT x.token AS word, y.token AS earlier, count(*) AS c FROM p x JOIN p y USING (doc_id) GROUP BY ALL),
    u AS (SELECT topic, word, earlier, coalesce(j.c, 0) AS joint, coalesce(e.c, 0) AS single,
      CASE WHEN coalesce(e.c, 0) = 0 THEN 0 ELSE ln((coalesce(j.c, 0) / n + 1e-12) / (e.c / n)) END AS score
      FROM pairs LEFT JOIN j USING (word, earlier) LEFT JOIN (SELECT word AS e, c FROM j WHERE word = earlier) e ON e.e = pairs.earlier, n)"""


@query("umass_pairs", f"{UMASS} SELECT topic, word, earlier, joint, single, round(score, 6) AS score FROM u")
def umass_pairs(spark, sf):
    return coherence.umass_pairs(tokenized(spark, sf), "tokens", WORD_LISTS).withColumn("score", F.round("score", 6))


@query("umass_coherence", f"{UMASS} SELECT topic, round(avg(score), 6) AS coherence FROM u GROUP BY topic")
def umass_coherence(spark, sf):
    return coherence.umass(tokenized(spark, sf), "tokens", WORD_LISTS).withColumn("coherence", F.round("coherence", 6))


WINDOWS = f"""WITH d AS (SELECT doc_id, {LOWER_TOKENS} AS w FROM documents),
    t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos, greatest(1, len(w) - 109) AS n FROM d),
    h AS (SELECT DISTINCT doc_id, token, s FROM (SELECT doc_id, token, unnest(range(greatest(1, pos - 109), least(n, pos) + 1)) AS s
      FROM t WHERE token IN {_EVERY}))
    SELECT a.token AS "first", b.token AS "second", count(*) AS n FROM h a JOIN h b USING (doc_id, s) GROUP BY ALL
    UNION ALL SELECT '', '', sum(greatest(1, len(w) - 109))::BIGINT FROM d WHERE len(w) > 0"""


@query("window_counts", WINDOWS)
def window_counts(spark, sf):
    listed = sorted({w for words in WORD_LISTS for w in words})
    return coherence.window_counts(tokenized(spark, sf), "tokens", listed)


@query(
    "cv_coherence",
    f"""WITH c AS ({WINDOWS}), l AS (SELECT * FROM {_LISTED}), w AS (SELECT n AS total FROM c WHERE "first" = '' AND "second" = ''),
    s AS (SELECT "first" AS word, n / total AS p FROM c, w WHERE "first" = "second" AND "first" <> ''),
    pairs AS (SELECT a.topic, a.r AS r, b.r AS q, coalesce(c.n / total, 0) + 1e-12 AS joint, x.p AS pa, y.p AS pb
      FROM l a JOIN l b USING (topic) CROSS JOIN w LEFT JOIN c ON c."first" = a.w AND c."second" = b.w
      LEFT JOIN s x ON x.word = a.w LEFT JOIN s y ON y.word = b.w),
    v AS (SELECT topic, r, q, CASE WHEN pa IS NULL OR pb IS NULL THEN 0 ELSE ln(joint / (pa * pb)) / -ln(joint) END AS v FROM pairs),
    whole AS (SELECT topic, q, sum(v) AS w FROM v GROUP BY topic, q),
    cosines AS (SELECT topic, r, CASE WHEN sum(v * v) * sum(w * w) > 0 THEN sum(v * w) / (sqrt(sum(v * v)) * sqrt(sum(w * w))) ELSE 0 END AS cosine
      FROM v JOIN whole USING (topic, q) GROUP BY topic, r)
    SELECT topic, round(avg(cosine), 6) AS coherence FROM cosines GROUP BY topic""",
)
def cv_coherence(spark, sf):
    return coherence.c_v(tokenized(spark, sf), "tokens", WORD_LISTS).withColumn("coherence", F.round("coherence", 6))


@query(
    "word_bar_series",
    f"WITH {ROWS} SELECT token, count(*) AS n FROM t GROUP BY token ORDER BY n DESC, token LIMIT 50",
)
def word_bar_series(spark, sf):
    counted = eda.token_counts(tokenized(spark, sf), "tokens")
    return eda.top_n(counted, [F.desc("n"), F.asc("token")], 50)
