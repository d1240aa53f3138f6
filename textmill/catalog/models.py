"""Queries on topic models, clusters and whole training runs."""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import functions as F

from textmill.catalog.registry import query
from textmill.catalog.relational import documents
from textmill.catalog.sql import in_list, tokens
from textmill.catalog.text import simple_clean_sql, tokenized
from textmill.functions import tokens as tok
from textmill.operators import clusters, coherence, pca, sparsekmeans, topics, vocabulary
from textmill.plans import language, settings, training
from textmill.sources import registry as model_registry
from textmill.session import discard, materialise, scratch_path

TOPICS = 3
MODEL = settings.ModelSettings(
    lda_num_topics_start=TOPICS,
    lda_num_topics_end=TOPICS + 1,
    no_above=0.5,
    no_below=8,
    lda_passes=50,
    lda_updates_per_pass=1,
    words_per_topic=10,
)
SOURCE = settings.SourceSettings("text", "doc_id", (MODEL,), passthrough=("lang",))


def prepared(spark, sf):
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    kept = tok.remove_stopwords(tok.tokenize(F.lower("text")), tok.stopwords())
    # dictionary, training vectors and predictions read the tokens again
    return materialise(docs.withColumn("stopwords_removed", kept))


def trained(spark, sf, k=TOPICS, model_settings=MODEL, docs=None):
    docs = prepared(spark, sf) if docs is None else docs
    corpus = training.build_corpus(docs, "doc_id", "text", model_settings, keep=("lang",))
    return corpus, training.fit(corpus, model_settings, k)


def _predict(corpus, model, **settings_):
    keep = ("doc_id", "lang")
    return training.predict_vectors(corpus.vectors("stopwords_removed", keep), model, keep=keep, **settings_)


#: the topic queries follow the original training run: the word prior is learned
MODEL_AUTO = replace(MODEL, lda_eta="auto")


def trained_tables(spark, sf, k=TOPICS):
    corpus = training.build_corpus(prepared(spark, sf), "doc_id", "text", MODEL_AUTO)
    model, bag = training.fit_tables(corpus, MODEL_AUTO, k, "doc_id")
    corpus.train.unpersist()
    return corpus, model, bag


def trained_topic_table(spark, sf):
    """The 10 first words of every topic."""
    corpus, model, bag = trained_tables(spark, sf)
    table = training.tables_topic_table(model, bag, corpus.dictionary, 10)
    bag.release()
    return table


@query("lda_topics")
def lda_topics(spark, sf):
    """Topic words of online LDA whose parameters are tables, with a learned word prior."""
    return trained_topic_table(spark, sf)


@query("lda_topics_wide")
def lda_topics_wide(spark, sf):
    return topics.topic_words_wide(trained_topic_table(spark, sf), TOPICS)


@query("lda_one_topic")
def lda_one_topic(spark, sf):
    return topics.one_topic(trained_topic_table(spark, sf), 0, 7)


@query("lda_eta")
def lda_eta(spark, sf):
    """The learned word prior: (token_id, Word, eta), one row per word of the dictionary."""
    corpus, model, bag = trained_tables(spark, sf)
    bag.release()
    return model.eta.join(corpus.dictionary.select("token_id", F.col("token").alias("Word")), "token_id")


@query("lda_features", "SELECT doc_id, true AS sums_to_one FROM documents")
def lda_features(spark, sf):
    """Topic vectors of every document; their sum is checked against SQL, the shares themselves are the model's."""
    corpus, model = trained(spark, sf)
    vectors = corpus.vectors("stopwords_removed", ["doc_id"])
    total = F.aggregate("lda_features", F.lit(0.0), lambda a, b: a + b)
    empty = F.aggregate("lda_features", F.lit(True), lambda a, b: a & (b == 0))
    scored = topics.with_topic_vector(vectors, model)
    return scored.select("doc_id", ((F.abs(total - 1) < 1e-6) | empty).alias("sums_to_one"))


@query("lda_predictions")
def lda_predictions(spark, sf):
    corpus, model = trained(spark, sf)
    names = topics.topic_names(spark, {0: "first", 1: "second"})
    return _predict(corpus, model, names=names)


@query("lda_all_predictions")
def lda_all_predictions(spark, sf):
    corpus, model = trained(spark, sf)
    return _predict(corpus, model, only_best=False, minimum=0.1)


@query("lda_language")
def lda_language(spark, sf):
    """Languages by topics: how many documents of each known language got each label."""
    corpus, model = trained(spark, sf, k=4)
    found = _predict(corpus, model).persist(StorageLevel.MEMORY_AND_DISK)
    labelled = topics.with_label(found, language.languages_of_topics(found, "lang"))
    return labelled.groupBy("lang", "pred_label").agg(F.count(F.lit(1)).alias("n"))


@query("lda_serve", "SELECT doc_id, true AS same FROM documents")
def lda_serve(spark, sf):
    """A run on tokens, bigrams and trigrams; serving the same texts with the stored settings agrees with its predictions."""
    folder = scratch_path(spark, "served")
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    log = training.run(spark, {"documents": SOURCE}, {"documents": docs}, folder)
    guid = log.select("model_guid").first().model_guid
    model, dictionary = model_registry.load_model(spark, folder, guid)
    served = training.serve(
        docs.withColumnRenamed("text", "message"), model, dictionary, "message", keep=("doc_id",), threshold=0.0,
        preparation=model_registry.load_preparation(spark, folder, guid),
    )
    batch = spark.read.parquet(f"{folder}/predictions").select(F.col("MessageID").alias("doc_id"), F.col("pred_index").alias("batch"))
    return served.join(batch, "doc_id").select("doc_id", F.col("pred_index").eqNullSafe(F.col("batch")).alias("same"))


@query("lda_sweep")
def lda_sweep(spark, sf):
    """Perplexity for a range of topic counts over one cached corpus."""
    corpus = training.build_corpus(prepared(spark, sf), "doc_id", "text", MODEL, keep=("lang",))
    ks = (2, 3, 4)
    models = training.fit_each(corpus, MODEL, ks)
    rows = [(k, topics.log_perplexity(model, corpus.train)) for k, model in zip(ks, models, strict=True)]
    return spark.createDataFrame(rows, "lda_num_topics int, log_perplexity double")


@query("lda_coherence")
def lda_coherence(spark, sf):
    docs = prepared(spark, sf)
    corpus, model = trained(spark, sf, docs=docs)
    rows = topics.topic_words(
        model, corpus.dictionary, topics.mean_topic_vector(topics.with_topic_vector(corpus.train, model), "lda_features"), TOPICS, 10
    ).orderBy("Topic", "Word_Rank").collect()
    lists = [[r.Word for r in rows if r.Topic == t] for t in range(TOPICS)]
    return coherence.umass(docs, "stopwords_removed", lists)


RUN_TOKENS = f"""t AS (SELECT doc_id, token FROM (SELECT doc_id, unnest({tokens('text')}) AS token
    FROM ({simple_clean_sql('documents')})) WHERE token NOT IN {in_list(tok.stopwords())}),
    s AS (SELECT token, count(DISTINCT doc_id) AS df FROM t GROUP BY token)"""


@query(
    "run_log",
    f"""WITH {RUN_TOKENS} SELECT 'documents' AS source, 'Target_text_Group-None_Topics_3' AS scope,
    (SELECT count(*) FROM documents) AS rows, (SELECT count(*) FROM s) AS words_preprocess,
    (SELECT count(*) FROM s WHERE (df >= 8 AND df <= floor(0.5 * (SELECT count(*) FROM documents))) OR token = '?')
    AS words_postprocess, 3 AS lda_num_topics""",
)
def run_log(spark, sf):
    """A whole run: clean rows stored, models trained and registered, topics and predictions appended."""
    folder = scratch_path(spark, "run")
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    log = training.run(spark, {"documents": replace(SOURCE, collocations=False)}, {"documents": docs}, folder)
    return log.select("source", "scope", "rows", "words_preprocess", "words_postprocess", "lda_num_topics")


@query(
    "run_outputs",
    """SELECT 'clean/source=documents' AS "table", count(*) AS n FROM documents UNION ALL SELECT 'topics', 20
    UNION ALL SELECT 'predictions', count(*) FROM documents WHERE regexp_matches(lang, 'de') OR regexp_matches(lang, 'fr')
    UNION ALL SELECT 'log', 2 UNION ALL SELECT 'model_repository', 2""",
)
def run_outputs(spark, sf):
    """Rows of every table that a run appends, by group scope."""
    folder = scratch_path(spark, "run")
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    config = settings.from_nested(
        {
            "documents": {
                "target_column": "text",
                "target_column_id": "doc_id",
                "passthrough": ("lang",),
                "collocations": False,
                "models": [
                    {"GroupColumn": "lang", "GroupValue": group, "lda_num_topics_start": 2, "lda_num_topics_end": 3,
                     "no_below": 5, "no_above": 0.5, "lda_updates_per_pass": 1, "words_per_topic": 5}
                    for group in ("de", "fr")
                ],
            }
        }
    )
    training.run(spark, config, {"documents": docs}, folder)
    written = [
        spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        for name in ("clean/source=documents", "topics", "predictions", "log", "model_repository")
    ]
    result = written[0]
    for part in written[1:]:
        result = result.unionByName(part)
    return result


@query("model_registry", "SELECT doc_id, true AS same FROM documents")
def model_registry_query(spark, sf):
    """A model saved, found by its guid and used again: predictions of both agree."""
    folder = scratch_path(spark, "registry")
    corpus, model = trained(spark, sf)
    model_registry.save_model(spark, folder, "guid-1", model, corpus.dictionary, "model_LDA", "all")
    again, dictionary = model_registry.load_model(spark, folder, "guid-1")
    before = _predict(corpus, model).select("doc_id", "pred_index")
    after = training.predict(
        corpus.scope, again, dictionary, "stopwords_removed", keep=("doc_id",)
    ).select("doc_id", F.col("pred_index").alias("again"))
    return before.join(after, "doc_id").select("doc_id", F.col("pred_index").eqNullSafe(F.col("again")).alias("same"))


# --- clusters --------------------------------------------------------------------------------


def vectors(spark, sf, no_below=5, docs=None):
    docs = materialise(tokenized(spark, sf)) if docs is None else docs
    n_docs = docs.count()
    dictionary = vocabulary.build_dictionary(docs, "tokens", no_below, 0.8, keep_tokens=(), n_docs=n_docs)
    return clusters.tfidf_vectors(docs, "tokens", dictionary, n_docs, keep=["doc_id"])


def stored_vectors(spark, sf):
    """(doc_id, features), stored, as entries and keys both read them."""
    docs = materialise(tokenized(spark, sf))
    stored = materialise(vectors(spark, sf, docs=docs).select("doc_id", "features"))
    discard(docs)
    return stored


#: numbers of clusters of the elbow; the full study goes to 49
ELBOW = (1, 2, 4, 8)


@query("kmeans_elbow")
def kmeans_elbow(spark, sf):
    """Mean distance to the nearest centre for every k, by k-means whose centres are tables (seeds by hash)."""
    made = stored_vectors(spark, sf)
    held = sparsekmeans.hold(sparsekmeans.entries_of(made, "doc_id"), made.select(F.col("doc_id").alias("doc")))
    rows = []
    for k in ELBOW:
        model = sparsekmeans.train(held, k)
        rows.append((k, model.labels.agg(F.avg("distance")).first()[0]))
    held.release()
    return spark.createDataFrame(rows, "k int, distortion double")


@query(
    "kmeans_one_centre",
    f"""WITH t AS (SELECT doc_id, unnest({tokens('lower(text)')}) AS token FROM documents),
    f AS (SELECT doc_id, token, count(*) AS tf FROM t GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents),
    s AS (SELECT token, count(*) AS df FROM f GROUP BY token),
    w AS (SELECT doc_id, token, tf * (ln((1.0 + n) / (1 + df)) + 1) AS weight FROM f JOIN s USING (token), n
      WHERE df >= 5 AND df <= floor(0.8 * n)),
    x AS (SELECT doc_id, token, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS v FROM w),
    m AS (SELECT token, sum(v) / any_value(n) AS c FROM x, n GROUP BY token),
    d AS (SELECT doc_id, sum(v * v) AS vv, sum(v * c) AS vc FROM x JOIN m USING (token) GROUP BY doc_id)
    SELECT 1 AS k, round(avg(sqrt(greatest(coalesce(vv, 0) - 2 * coalesce(vc, 0) + (SELECT sum(c * c) FROM m), 0))), 6) AS distortion
    FROM documents LEFT JOIN d USING (doc_id)""",
)
def kmeans_one_centre(spark, sf):
    """The elbow at one cluster, whose centre is the mean vector."""
    return clusters.elbow(vectors(spark, sf), (1,)).withColumn("distortion", F.round("distortion", 6))


@query("kmeans_labels")
def kmeans_labels(spark, sf):
    """Four clusters by k-means whose centres are tables; every document gets one."""
    made = stored_vectors(spark, sf)
    model = sparsekmeans.train(
        sparsekmeans.entries_of(made, "doc_id"), 4, keys=made.select(F.col("doc_id").alias("doc"))
    )
    return model.labels.select(F.col("doc").alias("doc_id"), F.col("centre").cast("int").alias("cluster"))


@query("pca_2d")
def pca_2d(spark, sf):
    """The first two principal components of every document's tf-idf vector; the basis is a table (operators/pca.py)."""
    made = stored_vectors(spark, sf)
    entries = sparsekmeans.entries_of(made, "doc_id")
    keys = materialise(made.select(F.col("doc_id").alias("doc")))
    axes, mean, _ = pca.principal_axes(entries, keys.count())
    xy = pca.projected(entries, keys, axes, mean)
    return xy.select(F.col("doc").alias("doc_id"), F.col("p0").alias("x"), F.col("p1").alias("y"))


@query(
    "grid_settings",
    "SELECT lang, k AS lda_num_topics FROM (SELECT DISTINCT lang FROM documents), (SELECT unnest([3, 6]) AS k)",
)
def grid_settings(spark, sf):
    return settings.group_grid(documents(spark, sf), "lang", range(3, 9, 3))
