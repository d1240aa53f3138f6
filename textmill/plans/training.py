"""Train, describe, predict and log over a grid of sources, groups and topic counts."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.ml.clustering import LDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from textmill.operators import blocks, onlinelda, shape, topics, vocabulary
from textmill.plans.preparation import tokenized, with_ngrams, without_stopwords
from textmill.plans.settings import ModelSettings, SourceSettings
from textmill.session import discard, materialise, scratch_path
from textmill.sources import files, registry, tables

RUN_LOG = """iteration_guid string, model_guid string, source string, target_column string, target_column_id string,
group_column string, group_value string, scope string, identifier string, predict_by_column string, n_gram int,
no_above double, no_below int, random_state int, lda_sample_size long, lda_num_topics int, lda_updates_per_pass int,
lda_passes int, lda_alpha string, lda_eta string, lda_minimum_probability double, rows long, words_preprocess long,
words_postprocess long, train_start timestamp, train_end timestamp, model_comment string"""


#: models that are trained at the same time
FITS = 3


@dataclass(frozen=True)
class Corpus:
    """A scope with its dictionary and the training vectors, which carry the key and the columns kept for predictions."""

    scope: DataFrame
    train: DataFrame
    dictionary: DataFrame
    rows: int
    sample_size: int
    words_before: int
    words_after: int

    def vectors(self, tokens: str, keep: Sequence[str]) -> DataFrame:
        """Vectors of the whole scope: those it was trained on, if no row was left out; the rest is counted anew."""
        if self.sample_size == self.rows and set(keep) <= set(self.train.columns):
            return self.train.select(*keep, "features")
        return vocabulary.with_vectors(self.scope, tokens, self.dictionary, keep=keep)


def build_corpus(prepared: DataFrame, key: str, text: str, settings: ModelSettings, keep: Sequence[str] = ()) -> Corpus:
    """Scope filter, training sample, dictionary and vectors of one model; the vectors are cached, with the columns of `keep`."""
    scope = shape.in_scope(prepared, text, settings.group_column, settings.group_value)
    rows = scope.count()
    wanted = settings.lda_sample_size
    sample = rows if not wanted or wanted > rows else wanted
    tokens = settings.predict_by_column
    train = scope if sample == rows else shape.sample_n(scope, sample, key, settings.random_state, rows)
    counted = vocabulary.counted_rows(train, tokens, list(dict.fromkeys([key, *keep])))
    statistics = counted.statistics().persist(StorageLevel.MEMORY_AND_DISK)
    before = statistics.count()
    kept = vocabulary.filter_extremes(statistics, sample, settings.no_below, settings.no_above, settings.keep_n)
    dictionary = materialise(vocabulary.with_ids(kept).select("token_id", "token", "df", "cf"))
    after = dictionary.count()
    if after == 0:
        raise ValueError(f"no token of {rows} rows is within no_below={settings.no_below} and no_above={settings.no_above}")
    statistics.unpersist()
    vectors = vocabulary.vectors_of(counted, dictionary)
    return Corpus(scope, vectors.persist(StorageLevel.MEMORY_AND_DISK), dictionary, rows, sample, before, after)


def fit(corpus: Corpus, settings: ModelSettings, k: int) -> LDAModel:
    return topics.train_lda(
        corpus.train,
        k=k,
        passes=settings.lda_passes,
        updates_per_pass=settings.lda_updates_per_pass,
        alpha=settings.lda_alpha,
        eta=settings.lda_eta,
        seed=settings.random_state,
    )


def fit_each(corpus: Corpus, settings: ModelSettings, ks: Sequence[int]) -> list[LDAModel]:
    """A model for every number of topics, trained at the same time: an update is too little work to keep all cores busy, and its driver's
    part leaves them idle. The vectors are cached first, so that every training finds them."""
    corpus.train.count()
    fitted = inheritable_thread_target(corpus.train.sparkSession)(lambda k: fit(corpus, settings, k))
    with ThreadPoolExecutor(max(1, min(len(ks), FITS))) as pool:
        return list(pool.map(fitted, ks))


def training_bag(corpus: Corpus, key: str, tokens: str) -> DataFrame:
    """(doc, token_id, cnt) of the training rows."""
    rows = corpus.scope.join(corpus.train.select(key), key, "left_semi")
    return vocabulary.doc2bow(rows, key, tokens, corpus.dictionary).withColumnRenamed(key, "doc")


def _training_rows(corpus: Corpus, key: str) -> DataFrame | None:
    """(doc, places, values) of the vectors, stored; None if rows were left out or keys repeat, whose counts are added up elsewhere."""
    if corpus.sample_size != corpus.rows:
        return None
    parts = F.unwrap_udt("features")
    every = corpus.train.select(
        F.col(key).alias("doc"), parts["indices"].cast("array<long>").alias("places"), parts["values"].alias("values")
    )
    stored = materialise(every.where(F.col("doc").isNotNull() & (F.size("places") > 0)))
    again = stored.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if again.isEmpty():
        return stored
    discard(stored)
    return None


def fit_tables(corpus: Corpus, settings: ModelSettings, k: int, key: str) -> tuple[onlinelda.OnlineLDA, blocks.Blocks]:
    """Online LDA whose parameters are tables (see operators/onlinelda.py), and its training rows in blocks, to be released by the caller; eta
    "auto" is learned, None is 1 / k. The blocks are made of the vectors where these hold every row once."""
    rows = _training_rows(corpus, key)
    if rows is None:
        pairs = training_bag(corpus, key, settings.predict_by_column)
        bag = blocks.deal(pairs.select("doc", F.col("token_id").alias("place"), F.col("cnt").alias("value")))
    else:
        bag = blocks.deal_rows(rows)
        discard(rows)
    eta = 1.0 / k if settings.lda_eta is None else settings.lda_eta
    model = onlinelda.train(
        bag,
        k,
        passes=settings.lda_passes,
        updates_per_pass=settings.lda_updates_per_pass,
        alpha=settings.lda_alpha,
        eta=eta,
        seed=settings.random_state,
    )
    return model, bag


def tables_topic_table(
    model: onlinelda.OnlineLDA, bag: DataFrame | blocks.Blocks, dictionary: DataFrame, n_words: int
) -> DataFrame:
    """Topic words of a table model with the mean share of each topic over the training rows; the same columns as
    topic_table."""
    shares = model.transform(bag).select(F.posexplode("topics").alias("topic", "share"))
    means = shares.groupBy("topic").agg(F.avg("share").alias("Topic_Distribution"))
    words = model.topic_words(dictionary, n_words)
    return words.join(means, "topic").select(
        F.col("topic").alias("Topic"), "Topic_Distribution", "Probability_Word", "Word", "Word_Rank"
    )


def topic_table(corpus: Corpus, model: LDAModel, k: int, n_words: int) -> DataFrame:
    """Topic words with the mean share of each topic over the training rows."""
    means = topics.mean_topic_vector(topics.with_topic_vector(corpus.train, model), "lda_features")
    return topics.topic_words(model, corpus.dictionary, means, k, n_words)


def predict(
    df: DataFrame,
    model: LDAModel,
    dictionary: DataFrame,
    tokens: str,
    *,
    keep: tuple[str, ...],
    names: DataFrame | None = None,
    only_best: bool = True,
    minimum: float = 0.0,
    threshold: float = 0.0,
) -> DataFrame:
    """Best topic, or every topic above the minimum, for each row; one message is a one-row table."""
    return predict_vectors(
        vocabulary.with_vectors(df, tokens, dictionary, keep=keep), model,
        keep=keep, names=names, only_best=only_best, minimum=minimum, threshold=threshold,
    )


def predict_vectors(
    vectors: DataFrame,
    model: LDAModel,
    *,
    keep: tuple[str, ...],
    names: DataFrame | None = None,
    only_best: bool = True,
    minimum: float = 0.0,
    threshold: float = 0.0,
) -> DataFrame:
    """`predict` for rows that have their vectors, such as those of a corpus."""
    scored = topics.with_topic_vector(vectors, model).select(*keep, "lda_features")
    if only_best:
        found = topics.best_topics(scored, "lda_features", threshold).drop("lda_features")
    else:
        found = topics.all_topics(scored, "lda_features", minimum)
    return topics.with_label(found, names) if names is not None else found


def serve(
    messages: DataFrame,
    model: LDAModel,
    dictionary: DataFrame,
    text: str,
    *,
    keep: tuple[str, ...] = (),
    names: DataFrame | None = None,
    preparation: Mapping[str, object] | None = None,
    stop=None,
    threshold: float = 0.0001,
    n_words: int = 5,
) -> DataFrame:
    """Probability, topic and its top words for messages, prepared as the training rows were.

    `preparation` holds the settings stored with the model. Collocations are those of the message itself, as in training.
    """
    how = {"n_gram": 1, "full_clean": False, "remove_stopwords": True, "collocations": False} | dict(preparation or {})
    made = tokenized(messages, text, n_gram=how["n_gram"], full_clean=how["full_clean"])
    if how["collocations"]:
        made = materialise(made.withColumn("_message", F.monotonically_increasing_id()))
    made = with_ngrams(made, "_message", collocations=how["collocations"])
    prepared = without_stopwords(made, stop if how["remove_stopwords"] else ())
    found = predict(
        prepared, model, dictionary, "stopwords_removed", keep=keep, names=names, threshold=threshold
    )
    weights = model.describeTopics(n_words).select(
        F.col("topic").alias("pred_index"), F.posexplode("termIndices").alias("_rank", "_id")
    )
    words = (
        dictionary.join(F.broadcast(weights), F.col("token_id") == F.col("_id"))
        .groupBy("pred_index")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rank", "token"))), lambda x: x["token"]), ", ").alias("words"))
    )
    return found.join(F.broadcast(words), "pred_index", "left")


def run(
    spark: SparkSession,
    sources: Mapping[object, SourceSettings],
    inputs: Mapping[object, DataFrame],
    folder: str,
    stop=None,
) -> DataFrame:
    """Run the whole grid and append to folder/{clean, topics, predictions, log, model_repository}.

    Each source is prepared once for each way of preparing it, only rows without a stored clean row are prepared, and the
    models of a source read the stored clean table. Clean rows are kept by source and settings, so rows of different settings
    never mix.
    """
    iteration = str(uuid.uuid4())
    for name, source in sources.items():
        for n_gram in source.n_grams():
            clean_path = f"{folder}/clean/{clean_name(name, source, n_gram, stop)}"
            _store_clean(spark, inputs[name], source, n_gram, clean_path, iteration, stop)
            prepared = spark.read.parquet(clean_path)
            for settings in source.models:
                if settings.n_gram != n_gram:
                    continue
                corpus = build_corpus(
                    prepared, source.target_column_id, source.target_column, settings, source.passthrough
                )
                for k in settings.topic_counts():
                    _one_model(spark, str(name), source, settings, corpus, k, folder, iteration)
                corpus.train.unpersist()
    return spark.read.schema(RUN_LOG).parquet(f"{folder}/log").filter(F.col("iteration_guid") == iteration)


def read_sources(spark: SparkSession, sources: Mapping[object, SourceSettings], **jdbc) -> dict[object, DataFrame]:
    """The tables of all sources that have a query, over one JDBC connection setting."""
    return {name: tables.read_jdbc(spark, query=s.query, **jdbc) for name, s in sources.items() if s.query}


def publish(predictions: DataFrame, view: str) -> None:
    """Make predictions available to SQL under a view name."""
    predictions.createOrReplaceTempView(view)


def clean_name(name: object, source: SourceSettings, n_gram: int, stop=None) -> str:
    """Source and a digest of everything that decides how its texts become tokens."""
    listed = None if stop is None else sorted(stop)
    columns = (source.target_column, source.target_column_id, list(source.passthrough))
    told = json.dumps([columns, source.preparation(n_gram), listed], sort_keys=True)
    return f"source={name}/settings={hashlib.sha256(told.encode()).hexdigest()[:16]}"


def _store_clean(spark, table, source, n_gram, path, iteration, stop):
    key, kept = source.target_column_id, (source.target_column_id, source.target_column, *source.passthrough)
    rows = table.select(*kept)
    if _exists(spark, path):
        rows = shape.without(rows, spark.read.parquet(path), key)
    made = tokenized(
        rows.withColumn("_source_text", F.col(source.target_column)),
        "_source_text",
        n_gram=n_gram,
        full_clean=source.full_clean,
        add_features=source.add_features,
    )
    if source.collocations:
        made = files.stored(made, scratch_path(spark, "tokens"))
    made = with_ngrams(made, key, collocations=source.collocations)
    made = without_stopwords(made, stop if source.remove_stopwords else ()).drop("_source_text")
    files.append_table(shape.with_constants(made, {"iteration_guid": iteration}), path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _one_model(spark, name, source, settings, corpus, k, folder, iteration):
    guid = str(uuid.uuid4())
    scope = f"Target_{source.target_column}_Group-{settings.group_value}_Topics_{k}"
    started = datetime.now()
    model = fit(corpus, settings, k)
    ended = datetime.now()
    how = source.preparation(settings.n_gram)
    registry.save_model(spark, folder, guid, model, corpus.dictionary, "model_LDA", scope, how)
    constants = {
        "target_column": source.target_column,
        "lda_num_topics": k,
        "model_guid": guid,
        "iteration_guid": iteration,
        "datetime": ended,
    }
    words = topic_table(corpus, model, k, settings.words_per_topic)
    files.append_table(
        shape.with_constants(words, {"Group": str(settings.group_value), **constants}), f"{folder}/topics"
    )
    kept = (source.target_column_id, *source.passthrough)
    predicted = predict_vectors(
        corpus.vectors(settings.predict_by_column, kept),
        model,
        keep=kept,
        only_best=source.only_best,
        minimum=settings.lda_minimum_probability,
    ).withColumnRenamed(source.target_column_id, "MessageID")
    files.append_table(shape.with_constants(predicted, constants), f"{folder}/predictions", "iteration_guid")
    row = (
        iteration, guid, name, source.target_column, source.target_column_id, settings.group_column,
        settings.group_value, scope, f"{scope}_Model_{guid}", settings.predict_by_column, settings.n_gram,
        float(settings.no_above), settings.no_below, settings.random_state, corpus.sample_size, k,
        settings.lda_updates_per_pass, settings.lda_passes, str(settings.lda_alpha), str(settings.lda_eta),
        float(settings.lda_minimum_probability), corpus.rows, corpus.words_before, corpus.words_after, started, ended,
        settings.model_comment,
    )
    files.append_table(spark.createDataFrame([row], RUN_LOG), f"{folder}/log")
