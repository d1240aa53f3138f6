"""Filters, samples, reshaping and constant columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.expressions import explode_rows, words

def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the named columns under their new names."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def in_scope(df: DataFrame, text: str, group: str | None = None, value: str | None = None) -> DataFrame:
    """Rows with text whose group column contains the value; no group (None, 'None', 'All') keeps all."""
    scoped = not_null(df, text)
    if group in (None, "None") or value in (None, "None", "All"):
        return scoped
    return scoped.filter(F.col(group).rlike(value))


def where_all(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, conditions))


def flag_index(index: Column, out_of_scope: Sequence[int]) -> Column:
    """0 for the listed topic indexes, 1 otherwise."""
    return F.when(index.isin(list(out_of_scope)), 0).otherwise(1)


def flag_prefix(text: Column, prefixes: Sequence[str]) -> Column:
    """0 when the text starts with one of the prefixes, 1 otherwise (also for null)."""
    return F.when(reduce(lambda a, b: a | b, [text.like(f"{p}%") for p in prefixes]), 0).otherwise(1)


def subject_in_first_message(text: Column, subject: Column, is_first: Column) -> Column:
    """Text and subject for the first message of a thread, else the text; null if either is null."""
    return F.when(is_first, F.concat(text, F.lit(" "), subject)).otherwise(text)


def _hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def _hash_bound(share: float) -> str:
    """The md5 value below which a share of all keys falls."""
    return format(min(max(int(share * 2**128), 0), 2**128 - 1), "032x")


def sample_n(df: DataFrame, n: int | None, key: str, seed: int = 1, rows: int | None = None) -> DataFrame:
    """Exactly n rows, drawn by the hash order of the key; no n, or more than there are, keeps all.

    The rows are counted in 4,096 ranges of the hash. The ranges before the one that holds the n-th row are taken by a
    filter, and only that range is sorted.
    """
    if not n or n <= 0 or (rows is not None and n >= rows):
        return df
    order = _hash_order(key, seed)
    place = F.conv(F.substring(order, 1, 3), 16, 10).cast("int")
    before = 0
    for found in df.groupBy(place.alias("slice")).agg(F.count(F.lit(1)).alias("rows")).orderBy("slice").collect():
        if before + found.rows >= n:
            last = df.filter(place == found.slice).orderBy(order, F.col(key)).limit(n - before)
            return df.filter(place < found.slice).unionByName(last)
        before += found.rows
    return df


def sample_fraction(df: DataFrame, fraction: float, key: str, seed: int = 1) -> DataFrame:
    """A share of the rows by the hash of the key: repeatable, inside each partition."""
    return df if fraction >= 1 else df.filter(_hash_order(key, seed) < _hash_bound(fraction))


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the other table: sample complement, or rows not processed yet."""
    return df.join(other.select(key), key, "left_anti")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def shorter_than(df: DataFrame, text: str, limit: int) -> DataFrame:
    return df.filter(F.length(text) < limit)


def fewer_words_than(df: DataFrame, text: str, limit: int) -> DataFrame:
    """Cut-off by the number of pieces between single blanks."""
    return df.filter(F.size(F.split(text, " ")) < limit)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, counted in one pass and returned as (column_name, nulls)."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], names, "column_name", "nulls")


def vocabulary_list(df: DataFrame, tokens: str) -> DataFrame:
    return explode_rows(df, [], F.col(tokens), "token").distinct()


def fill_null_text(df: DataFrame, columns: Sequence[str], value: str = " ") -> DataFrame:
    return df.na.fill(value, list(columns))


def remove_from_category(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.withColumn(column, F.regexp_replace(column, pattern, ""))


def word_count(text: Column) -> Column:
    return F.size(words(text))
