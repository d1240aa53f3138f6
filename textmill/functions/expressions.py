"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# \w, \b, \s and \d follow Unicode and only \n ends a line, as in Python patterns
UNICODE = "(?Ud)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`, also when `body` uses it in lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sub(column: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(column, UNICODE + pattern, replacement)


def matches(column: Column, pattern: str) -> Column:
    return column.rlike(UNICODE + pattern)


def strip(column: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return sub(column, r"^\s+|\s+\z")


def collapse_spaces(column: Column) -> Column:
    return strip(sub(column, r"\s+", " "))


def words(column: Column) -> Column:
    """White-space separated words; empty text gives an empty array."""
    return F.array_remove(F.split(column, UNICODE + r"\s+"), "")


def explode_rows(df: DataFrame, keep: Sequence[str | Column], array: Column, name: str) -> DataFrame:
    """One row per array item; rows without items go.

    A plain explode makes the optimizer test the array for items below it, which computes an
    expensive array (tokens, model output) again for every test. The outer form with a filter
    on the item computes it once.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def inline_rows(df: DataFrame, keep: Sequence[str | Column], array: Column) -> DataFrame:
    """One row per struct of an array, with the fields as columns; see `explode_rows`."""
    item = "_item"
    exploded = df.select(*keep, F.explode_outer(array).alias(item)).filter(F.col(item).isNotNull())
    names = [c if isinstance(c, str) else exploded.columns[i] for i, c in enumerate(keep)]
    return exploded.select(*names, f"{item}.*")


def item_counts(items: Column) -> Column:
    """array<struct<token, cnt>> of an array of tokens, in token order: how often each item occurs, without leaving the row."""

    def runs(ordered: Column) -> Column:
        opens = F.array_compact(
            F.transform(ordered, lambda t, i: F.when((i == 0) | ~t.eqNullSafe(F.get(ordered, i - 1)), i))
        )
        return let(
            opens,
            lambda at: F.transform(
                at,
                lambda p, j: F.struct(
                    F.get(ordered, p).alias("token"), (F.coalesce(F.get(at, j + 1), F.size(ordered)) - p).cast("long").alias("cnt")
                ),
            ),
        )

    return let(F.sort_array(items), runs)
