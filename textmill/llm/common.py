"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import scratch_path

#: a word is a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: lets Spark delete the shuffle files of a finished execution at once, not when the driver happens to collect garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: cuts lineage and survives lost executors.

    Once the table is written, the shuffle files that it was made from are of no more use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A source as a string without nulls that sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def seeded_unit(seed: str, value: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the value only, the same on every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
