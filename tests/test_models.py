from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textmill.operators import clusters, topics, vocabulary
from textmill.plans import preparation, settings, training
from textmill.sources import registry
from textmill.streaming.incremental import process_new_files

SETTINGS = settings.ModelSettings(
    lda_num_topics_start=2, lda_num_topics_end=3, no_below=1, lda_passes=15, lda_updates_per_pass=1, words_per_topic=4
)


@pytest.fixture(scope="module")
def planted(spark):
    """Two groups of documents with disjoint words."""
    first, second = ["kort", "penge", "konto", "løn"], ["bil", "vej", "hjul", "motor"]
    rows = []
    for i in range(100):
        words = first if i % 2 else second
        rows.append((i, "a" if i % 2 else "b", " ".join(words[(i + j) % 4] for j in range(3 + i % 5))))
    df = spark.createDataFrame(rows, "id long, grp string, body string")
    made = preparation.with_ngrams(preparation.tokenized(df, "body"), "id", collocations=False)
    return preparation.without_stopwords(made).cache()


@pytest.fixture(scope="module")
def fitted(planted):
    corpus = training.build_corpus(planted, "id", "body", SETTINGS)
    return corpus, training.fit(corpus, SETTINGS, 2)


def test_prior():
    prior = topics.asymmetric_prior(4)
    assert sum(prior) == pytest.approx(1) and prior == sorted(prior, reverse=True)
    assert prior[0] / prior[1] == pytest.approx(3 / 2)


def test_planted_topics_are_found(planted, fitted):
    corpus, model = fitted
    found = training.predict(planted, model, corpus.dictionary, "stopwords_removed", keep=("id", "grp"))
    counts = {(r.grp, r.pred_index): r["count"] for r in found.groupBy("grp", "pred_index").count().collect()}
    assert len(counts) == 2 and set(counts.values()) == {50}
    assert (corpus.rows, corpus.words_after) == (100, 8)


def test_topic_vectors_sum_to_one(fitted):
    corpus, model = fitted
    vectors = topics.with_topic_vector(corpus.train, model)
    sums = vectors.select(F.aggregate("lda_features", F.lit(0.0), lambda a, b: a + b).alias("s"))
    assert all(r.s == pytest.approx(1) for r in sums.collect())


def test_training_is_repeatable(fitted):
    corpus, model = fitted
    again = training.fit(corpus, SETTINGS, 2)
    assert np.allclose(model.topicsMatrix().toArray(), again.topicsMatrix().toArray())


def test_topic_tables(fitted):
    corpus, model = fitted
    table = training.topic_table(corpus, model, 2, 4).cache()
    assert table.count() == 8 and table.agg(F.countDistinct("Word")).first()[0] == 8
    assert {r.Word_Rank for r in table.collect()} == {0, 1, 2, 3}
    wide = topics.topic_words_wide(table, 2)
    assert wide.columns == ["Word_Rank", "Topic # 00", "Topic # 01"] and wide.count() == 4
    assert topics.one_topic(table, 1, 2).count() == 2


def test_all_predictions_and_labels(planted, fitted):
    corpus, model = fitted
    rows = training.predict(
        planted, model, corpus.dictionary, "stopwords_removed", keep=("id",), only_best=False, minimum=0.0
    )
    assert rows.count() == 200
    names = topics.topic_names(planted.sparkSession, ["one"])
    labelled = training.predict(planted, model, corpus.dictionary, "stopwords_removed", keep=("id",), names=names)
    assert {r.pred_label for r in labelled.collect()} == {"one", None}


def test_serving_agrees_with_batch(spark, planted, fitted):
    corpus, model = fitted
    one = spark.createDataFrame([(1, "Kort penge konto.")], "id long, body string")
    served = training.serve(one, model, corpus.dictionary, "body", keep=("id",)).first()
    batch = training.predict(planted.filter("id = 1"), model, corpus.dictionary, "stopwords_removed", keep=("id",)).first()
    assert served.pred_index == batch.pred_index and len(served.words.split(", ")) == 5
    empty = spark.createDataFrame([(1, "ukendt")], "id long, body string")
    assert training.serve(empty, model, corpus.dictionary, "body", keep=("id",)).first().pred_index is None


def test_serving_follows_the_settings_of_a_run(spark, tmp_path):
    rows = [(i, f"Kort penge konto {'løn rente' if i % 2 else 'bil vej'} ord{i % 3}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, body string")
    config = settings.from_nested(
        {"s": {"target_column": "body", "target_column_id": "id", "models": [
            {"n_gram": n, "lda_num_topics_start": 2, "lda_num_topics_end": 3, "no_below": 1, "lda_passes": 3, "words_per_topic": 3}
            for n in (1, 2)]}}
    )
    log = training.run(spark, config, {"s": df}, str(tmp_path)).collect()
    assert sorted(r.n_gram for r in log) == [1, 2] and len({r.words_preprocess for r in log}) == 2
    for row in log:
        model, dictionary = registry.load_model(spark, str(tmp_path), row.model_guid)
        how = registry.load_preparation(spark, str(tmp_path), row.model_guid)
        assert how["n_gram"] == row.n_gram and how["collocations"]
        served = training.serve(df, model, dictionary, "body", keep=("id",), preparation=how, threshold=0.0)
        batch = spark.read.parquet(f"{tmp_path}/predictions").filter(F.col("model_guid") == row.model_guid)
        batch = {r.MessageID: (r.pred_index, round(r.pred_probability, 6)) for r in batch.collect()}
        assert {r.id: (r.pred_index, round(r.pred_probability, 6)) for r in served.collect()} == batch


def test_perplexity_sign(fitted):
    corpus, model = fitted
    assert topics.log_perplexity(model, corpus.train) < 0


def test_registry(spark, fitted, tmp_path):
    corpus, model = fitted
    registry.save_model(spark, str(tmp_path), "g1", model, corpus.dictionary, "model_LDA", "all")
    again, dictionary = registry.load_model(spark, str(tmp_path), "g1")
    assert again.vocabSize() == 8 == dictionary.count()
    with pytest.raises(KeyError):
        registry.load_model(spark, str(tmp_path), "g1' or '1'='1")


def test_run_appends_and_skips_stored_rows(spark, tmp_path):
    rows = [(i, "x" if i % 2 else "y", f"kort penge konto ord{i % 7} bil vej hjul") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, team string, body string")
    config = settings.from_nested(
        {
            "s": {
                "target_column": "body", "target_column_id": "id", "passthrough": ("team",),
                "models": [
                    {"GroupColumn": group, "GroupValue": value, "lda_num_topics_start": 2, "lda_num_topics_end": 4,
                     "no_below": 1, "lda_passes": 1, "lda_sample_size": 20, "words_per_topic": 3}
                    for group, value in ((None, None), ("team", "x"))
                ],
            }
        }
    )
    first = training.run(spark, config, {"s": df.filter("id < 40")}, str(tmp_path)).collect()
    assert sorted(r.rows for r in first) == [20, 20, 40, 40] and {r.lda_sample_size for r in first} == {20}
    second = training.run(spark, config, {"s": df}, str(tmp_path)).collect()
    assert len(second) == 4 and max(r.rows for r in second) == 60
    clean = spark.read.parquet(f"{tmp_path}/clean/source=s")
    assert clean.select("settings").distinct().count() == 1
    assert clean.count() == 60 == clean.select("id").distinct().count()
    assert spark.read.parquet(f"{tmp_path}/topics").count() == 2 * (2 + 3) * 3 * 2
    assert spark.read.parquet(f"{tmp_path}/predictions").count() == (40 + 20 + 60 + 30) * 2
    assert registry.models(spark, str(tmp_path)).count() == 8


def test_empty_dictionary_is_reported(planted):
    with pytest.raises(ValueError, match="no token"):
        training.build_corpus(planted, "id", "body", settings.ModelSettings(no_below=1000))


def test_published_predictions(spark, planted, fitted):
    corpus, model = fitted
    found = training.predict(planted, model, corpus.dictionary, "stopwords_removed", keep=("id", "grp"))
    training.publish(found, "topic_predictions")
    query = "SELECT count(*) AS n FROM topic_predictions WHERE grp = :grp"
    assert spark.sql(query, args={"grp": "a"}).first().n == 50


def test_settings():
    mixed = settings.SourceSettings("a", "b", (settings.ModelSettings(), settings.ModelSettings(n_gram=2)))
    assert mixed.n_grams() == [1, 2]
    assert training.clean_name("s", mixed, 1) != training.clean_name("s", mixed, 2)
    with pytest.raises(ValueError):
        settings.from_nested({"s": {"target_column": "a", "target_column_id": "b", "models": [{"Tests": 1}]}})
    config = settings.from_nested(
        {"s": {"target_column": "a", "target_column_id": "b", "models": [{"lda_num_topics_start": 2, "lda_num_topics_end": 9, "lda_num_topics_increment": 3}]}}
    )
    assert [r.topics for r in settings.grid(config)] == [2, 5, 8]


def test_subject_is_added_to_first_messages(spark):
    df = spark.createDataFrame([(1, "tekst", "Emne", 1), (2, "tekst", "Emne", 0)], "id int, b string, s string, f int")
    made = preparation.tokenized(df, "b", subject="s", is_first="f").orderBy("id").collect()
    assert [r.text for r in made] == ["tekst emne", "tekst"]


def test_clusters(planted):
    dictionary = vocabulary.build_dictionary(planted, "stopwords_removed")
    made = clusters.tfidf_vectors(planted, "stopwords_removed", dictionary, 100).cache()
    dense = np.array([r.v for r in made.orderBy("id").select(vector_to_array("features").alias("v")).collect()])
    distortions = {r.k: r.distortion for r in clusters.elbow(made, (1, 2), max_iterations=10).collect()}
    mean = dense.mean(axis=0)
    assert distortions[1] == pytest.approx(np.linalg.norm(dense - mean, axis=1).mean())
    halves = [dense[i::2] for i in (0, 1)]
    plain = np.concatenate([np.linalg.norm(h - h.mean(axis=0), axis=1) for h in halves]).mean()
    assert distortions[2] == pytest.approx(plain)
    labels = clusters.fit_kmeans(made, 2).transform(made)
    assert labels.groupBy("grp").agg(F.countDistinct("cluster").alias("n")).filter("n > 1").count() == 0
    xy = np.array([(r.x, r.y) for r in clusters.two_components(made).orderBy("id").collect()])
    _, _, axes = np.linalg.svd(dense - mean, full_matrices=False)
    expected = (dense - mean) @ axes[:2].T
    assert np.allclose(np.abs(xy[:, 0]), np.abs(expected[:, 0]), atol=1e-6)


def test_new_files_are_processed_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    df = spark.createDataFrame([(1, "Hej Anna\nhvor er kortet?")], "id long, body string")
    clean = lambda rows: preparation.tokenized(rows, "body")
    df.write.parquet(source)
    assert process_new_files(spark, source, target, progress, df.schema, clean) == 1
    assert process_new_files(spark, source, target, progress, df.schema, clean) == 0
    df.withColumn("id", F.lit(2).cast("long")).write.mode("append").parquet(source)
    assert process_new_files(spark, source, target, progress, df.schema, clean) == 1
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2]


def test_rows_of_more_batches_than_are_kept_are_counted(spark, tmp_path):
    source, target, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    df = spark.range(80)
    df.repartition(8).write.parquet(source)
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        assert process_new_files(spark, source, target, progress, df.schema, lambda d: d, files_per_batch=1) == 80
        assert spark.conf.get(name) == "3"
    finally:
        spark.conf.set(name, before)
    assert spark.read.parquet(target).count() == 80


def test_predictions_read_the_training_vectors(planted, monkeypatch):
    corpus = training.build_corpus(planted, "id", "body", SETTINGS, keep=("grp",))
    model = training.fit(corpus, SETTINGS, 2)
    wanted = training.predict(planted, model, corpus.dictionary, "stopwords_removed", keep=("id", "grp"))
    counted = []
    monkeypatch.setattr(vocabulary, "counted_rows", lambda *a, **k: counted.append(a))
    found = training.predict_vectors(corpus.vectors("stopwords_removed", ("id", "grp")), model, keep=("id", "grp"))
    assert not counted and found.columns == wanted.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    corpus.train.unpersist()


def test_a_sample_is_not_all_that_is_predicted(planted):
    corpus = training.build_corpus(planted, "id", "body", replace(SETTINGS, lda_sample_size=60), keep=("grp",))
    assert corpus.train.count() == 60
    assert sorted(r.id for r in corpus.vectors("stopwords_removed", ("id", "grp")).collect()) == list(range(100))
    corpus.train.unpersist()


def test_models_trained_at_the_same_time_are_those_of_each(spark):
    docs = spark.createDataFrame([(i, ["ab", "cd", "ef", "gh"][i % 3 :] * 2) for i in range(30)], "id long, stopwords_removed array<string>")
    chosen = settings.ModelSettings(no_below=1, lda_passes=2, lda_updates_per_pass=1)
    corpus = training.build_corpus(docs.withColumn("text", F.lit("x")), "id", "text", chosen)
    ks = [3, 2, 4, 2]
    models = training.fit_each(corpus, chosen, ks)
    assert [m.getK() for m in models] == ks
    for k, model in zip(ks, models, strict=True):
        assert model.logPerplexity(corpus.train) == pytest.approx(training.fit(corpus, chosen, k).logPerplexity(corpus.train))
