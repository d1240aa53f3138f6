"""Tagged sentences as rows, and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import fixed, tokens
from textmill.functions.expressions import inline_rows


def tagged_sentences(
    df: DataFrame, key: str, text: str, table=fixed.SENTENCE_TAGS, after_ending: bool = True
) -> DataFrame:
    """(key, pos, sentence, tag); splitting and tagging stay inside the row."""
    tagged = tokens.tag_sentences(tokens.split_sentences(F.col(text)), table, after_ending)
    return inline_rows(df, [key], tagged)


def tag_counts(tagged: DataFrame) -> DataFrame:
    return (
        tagged.groupBy("sentence", "tag")
        .agg(F.count(F.lit(1)).alias("counts"))
        .orderBy(F.desc("counts"), "sentence", "tag")
    )


def with_tag(counts: DataFrame, tag: str, n: int) -> DataFrame:
    """The n most frequent sentences of a tag."""
    return counts.filter(F.col("tag") == tag).orderBy(F.desc("counts"), "sentence").limit(n)


def sentences_by_tag(tagged: DataFrame, part_size: int = 1000) -> DataFrame:
    """Distinct sentences per tag in lists of about `part_size`: (tag, part, sentences, occurrences).

    A tag may hold most of all sentences, so it is spread over as many parts as its size asks
    for; equal sentences are counted before they are listed.
    """
    counted = tagged.groupBy("tag", "sentence").agg(F.count(F.lit(1)).alias("n"))
    parts = counted.groupBy("tag").agg(F.ceil(F.count(F.lit(1)) / part_size).alias("parts"))
    spread = counted.join(F.broadcast(parts), "tag").withColumn(
        "part", F.pmod(F.xxhash64("sentence"), F.col("parts"))
    )
    return spread.groupBy("tag", "part").agg(
        F.sort_array(F.collect_list("sentence")).alias("sentences"), F.sum("n").alias("occurrences")
    )
