"""Counts, shares, monthly aggregates, length statistics and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.expressions import explode_rows, words
from textmill.operators.ordering import global_running


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = None, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first; ties in column order."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    counted = counted.orderBy(F.col(name).desc(), *columns)
    return counted.limit(top) if top else counted


def monthly(df: DataFrame, moment: str, measure: str) -> DataFrame:
    """Sum, mean and count of a measure per month."""
    return df.groupBy(F.date_format(moment, "yyyy-MM").alias("year_month")).agg(
        F.sum(measure).alias("total"), F.avg(measure).alias("mean"), F.count(measure).alias("n")
    )


def by_calendar_month(df: DataFrame, moment: str) -> DataFrame:
    return df.groupBy(F.month(moment).alias("month")).agg(F.count(F.lit(1)).alias("n"))


def value_share(df: DataFrame, column: str, low: int = 2, high: int = 19) -> DataFrame:
    """Rows and share of all rows for every value low..high, in one pass over the data."""
    return _shares(df, [(v, F.col(column) == v) for v in range(low, high + 1)])


def cumulative_share(df: DataFrame, column: str, low: int = 200, high: int = 600, step: int = 25) -> DataFrame:
    """Rows and share of all rows at or below every bound, in one pass over the data."""
    return _shares(df, [(v, F.col(column) <= v) for v in range(low, high + 1, step)])


def _shares(df: DataFrame, tests: Sequence[tuple[int, Column]]) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        F.array(
            *[F.struct(F.lit(v).alias("value"), F.count_if(test).alias("n")) for v, test in tests]
        ).alias("_counts"),
    )
    return counted.select("_total", F.inline("_counts")).select(
        "value", "n", (F.col("n") / F.col("_total")).alias("share")
    )


def length_stats(df: DataFrame, text: str, over: int) -> DataFrame:
    """Rows, sum, mean, min and max of the word count (pieces between single blanks), and two tails."""
    counted = df.select(F.size(F.split(text, " ")).alias("n"))
    return counted.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n").alias("n_words"),
        F.avg("n").alias("mean_words"),
        F.min("n").alias("min_words"),
        F.max("n").alias("max_words"),
        F.count_if(F.col("n") > over).alias("over_limit"),
        F.count_if(F.col("n") <= 5).alias("tops_five"),
    )


def word_frequency(df: DataFrame, text: str) -> DataFrame:
    """Frequency of every word with its share and the running share, most frequent first."""
    counted = (
        explode_rows(df, [], words(F.col(text)), "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("abs_freq"))
    )
    ranked = global_running(counted, [F.desc("abs_freq"), F.asc("word")], sums={"_running": "abs_freq"})
    total = ranked.agg(F.max("_running")).first()[0] or 0
    return ranked.select(
        "word",
        "abs_freq",
        (F.col("abs_freq") / total).alias("abs_perc"),
        (F.col("_running") / total).alias("abs_perc_cum"),
    )


def token_counts(df: DataFrame, tokens: str) -> DataFrame:
    return explode_rows(df, [], F.col(tokens), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def document_frequency(df: DataFrame, tokens: str) -> DataFrame:
    """Documents per token; a token counts once per row, so one shuffle is enough."""
    return (
        explode_rows(df, [], F.array_distinct(tokens), "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, as (share, value).

    Values are counted first and then ranked by range partitions, so neither a frequent value
    nor the whole column lands in one task.
    """
    counted = (
        df.select(F.col(column).cast("double").alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = global_running(counted, [F.asc("value")], sums={"last": "n"})
    total = ranked.agg(F.max("last")).first()[0] or 0
    picks = []
    for share in shares:
        position = share * (total - 1)
        low = int(position)
        part = position - low
        covers = lambda at: (F.col("last") > at) & (F.col("last") - F.col("n") <= at)
        low_value = F.max(F.when(covers(low), F.col("value")))
        high_value = F.max(F.when(covers(min(low + 1, max(total - 1, 0))), F.col("value")))
        picks.append(
            F.struct(
                F.lit(float(share)).alias("share"), (low_value + (high_value - low_value) * part).alias("value")
            )
        )
    return ranked.agg(F.array(*picks).alias("picks")).select(F.inline("picks"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max as (statistic, value)."""
    basic = df.agg(
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    ).unpivot([], ["count", "mean", "std", "min", "max"], "statistic", "value")
    quartiles = quantiles(df, column, [0.25, 0.5, 0.75]).select(
        F.concat(F.round(F.col("share") * 100).cast("int").cast("string"), F.lit("%")).alias("statistic"), "value"
    )
    return basic.unionByName(quartiles)


def histogram(
    df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows per equal-width bin (bin 1..bins, the last one closed); bounds default to min and max."""
    if low is None or high is None:
        ends = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
        low, high = (ends[0] if low is None else low), (ends[1] if high is None else high)
    if low is None:
        return df.sparkSession.createDataFrame([], "bin long, bin_low double, bin_high double, n long")
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    value = F.col(column).cast("double")
    bucket = F.when(value == high, bins).otherwise(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)))
    counted = df.filter(value.between(low, high)).groupBy(bucket.cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * width).alias("bin_low"),
        (F.lit(low) + F.col("bin") * width).alias("bin_high"),
        "n",
    )


def proportions(df: DataFrame, column: str) -> DataFrame:
    """Rows per label and their share; the window runs over one row per label."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def least_probable(df: DataFrame, key: str, probability: str, index: str, most: bool = False) -> DataFrame:
    """One row per key: the lowest probability, then the lowest index (as the gate reads it), or the highest.

    Aggregated with min_by / max_by, so a key with many rows is reduced before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in others])
    sign = -F.col(probability) if most else F.col(probability)
    best = F.min_by(row, F.struct(sign, F.col(index))).alias("_row")
    return df.groupBy(key).agg(best).select(key, *[F.col("_row")[c].alias(c) for c in others])


def rank_in_group(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """0-based rank inside groups of bounded size, such as the words of a topic."""
    ranked = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    return df.withColumn(name, ranked)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
