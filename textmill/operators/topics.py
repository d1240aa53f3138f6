"""Topic models: training, topic tables, prediction and topic names."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions import vectors
from textmill.functions.expressions import inline_rows


# fixed values: step size (offset + update) ^ -decay of the original trainer; Spark's own offset of 1024
# learns far too slowly for tens of updates
LEARNING_OFFSET = 1.0
LEARNING_DECAY = 0.5


def asymmetric_prior(k: int) -> list[float]:
    """Topic weights 1 / (i + sqrt(k)), scaled to sum to 1."""
    raw = [1.0 / (i + math.sqrt(k)) for i in range(k)]
    return [value / sum(raw) for value in raw]


def train_lda(
    vectors_df: DataFrame,
    *,
    k: int,
    passes: int = 50,
    updates_per_pass: int = 2,
    alpha: str | float = "asymmetric",
    eta: str | float | None = None,
    seed: int = 1,
    features: str = "features",
) -> LDAModel:
    """Online LDA: `passes` over the corpus, each in `updates_per_pass` mini-batches of that share of the rows.

    Spark scans the cached vectors for every mini-batch, so a fixed number of batches keeps the work in proportion to the rows.

    alpha is "asymmetric", "symmetric", "auto" (learned) or a number. A learned eta does not
    exist in Spark ML: "auto" and None keep its default, a number is used as it is.
    """
    model = LDA(
        k=k,
        optimizer="online",
        maxIter=passes * updates_per_pass,
        subsamplingRate=1.0 / updates_per_pass,
        optimizeDocConcentration=alpha == "auto",
        learningOffset=LEARNING_OFFSET,
        learningDecay=LEARNING_DECAY,
        seed=seed,
        featuresCol=features,
        topicDistributionCol="topics",
    )
    if alpha == "asymmetric":
        model = model.setDocConcentration(asymmetric_prior(k))
    elif alpha not in ("auto", "symmetric"):
        model = model.setDocConcentration([float(alpha)])
    if isinstance(eta, (int, float)):
        model = model.setTopicConcentration(float(eta))
    return model.fit(vectors_df)


def with_topic_vector(df: DataFrame, model: LDAModel, output: str = "lda_features") -> DataFrame:
    """Add the share of every topic as an array."""
    drop = model.getTopicDistributionCol()
    return model.transform(df).withColumn(output, vector_to_array(drop)).drop(drop)


def mean_topic_vector(df: DataFrame, vector: str) -> DataFrame:
    """(topic, mean): the element-wise mean."""
    numbered = F.transform(vector, lambda p, i: F.struct(i.alias("topic"), p.alias("_p")))
    return inline_rows(df, [], numbered).groupBy("topic").agg(F.avg("_p").alias("mean"))


def top_topics(means: DataFrame, n: int) -> DataFrame:
    """The n topics with the highest mean, listed by id; one row per topic comes in."""
    order = Window.orderBy(F.desc("mean"), F.desc("topic"))
    ranked = means.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= n).drop("_rank").orderBy("topic")


def topic_words(
    model: LDAModel, dictionary: DataFrame, means: DataFrame, n_topics: int, n_words: int, digits: int | None = None
) -> DataFrame:
    """One row per topic and top word: Topic, Topic_Distribution, Probability_Word, Word, Word_Rank (from 0)."""
    listed = model.describeTopics(n_words).select(
        F.col("topic"), F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("Word_Rank", "_t")
    )
    weight = F.col("_t.termWeights")
    flat = listed.select(
        "topic",
        "Word_Rank",
        F.col("_t.termIndices").cast("long").alias("token_id"),
        (F.round(weight, digits) if digits is not None else weight).alias("Probability_Word"),
    )
    named = dictionary.select("token_id", F.col("token").alias("Word")).join(F.broadcast(flat), "token_id")
    return named.join(F.broadcast(top_topics(means, n_topics)), "topic").select(
        F.col("topic").alias("Topic"),
        F.col("mean").alias("Topic_Distribution"),
        "Probability_Word",
        "Word",
        "Word_Rank",
    )


def topic_words_wide(words: DataFrame, k: int) -> DataFrame:
    """Words by rank, one column `Topic # 00` ... per topic."""
    names = [f"Topic # {i:02d}" for i in range(k)]
    named = words.withColumn("_name", F.format_string("Topic # %02d", F.col("Topic")))
    return named.groupBy("Word_Rank").pivot("_name", names).agg(F.first("Word")).orderBy("Word_Rank")


def one_topic(words: DataFrame, topic: int, n: int) -> DataFrame:
    return words.filter((F.col("Topic") == topic) & (F.col("Word_Rank") < n)).orderBy("Word_Rank")


def topic_names(spark, names: Mapping[int, str] | Sequence[str]) -> DataFrame:
    """(pred_index, pred_label) from a mapping or list; a JSON or CSV file is read with spark.read."""
    pairs = names.items() if isinstance(names, Mapping) else enumerate(names)
    return spark.createDataFrame(list(pairs), "pred_index int, pred_label string")


def with_label(predictions: DataFrame, names: DataFrame) -> DataFrame:
    """Add the topic name, null where the topic has none."""
    return predictions.join(names, "pred_index", "left")


def best_topics(df: DataFrame, vector: str, threshold: float = 0.0) -> DataFrame:
    """Add the best topic of every row as pred_probability and pred_index."""
    best = df.withColumn("_best", vectors.best_topic(F.col(vector), threshold))
    return best.withColumns(
        {"pred_probability": F.col("_best.pred_probability"), "pred_index": F.col("_best.pred_index")}
    ).drop("_best")


def all_topics(df: DataFrame, vector: str, minimum: float = 0.0) -> DataFrame:
    """One row per topic that reaches the minimum."""
    others = [c for c in df.columns if c != vector]
    return inline_rows(df, others, vectors.topic_scores(F.col(vector), minimum))


def distribution_series(means: DataFrame, n_top: int = 5) -> DataFrame:
    """The data of the topic bar chart: (topic, mean, is_top)."""
    order = Window.orderBy(F.desc("mean"), F.desc("topic"))
    return means.withColumn("is_top", F.row_number().over(order) <= n_top)


def log_perplexity(model: LDAModel, df: DataFrame) -> float:
    """Per-word bound; higher is better (Spark reports it with the other sign)."""
    return -model.logPerplexity(df)
