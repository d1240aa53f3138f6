"""Audit rows: a mask of attributes and a string of values, paired by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from textmill.functions.expressions import inline_rows, let


def trim_mask(mask: Column) -> Column:
    """Drop the first and the last character of a mask such as ,5,28, ."""
    return F.substr(mask, F.lit(2), F.greatest(F.length(mask) - 2, F.lit(0)))


def paired(mask: Column, data: Column) -> Column:
    """Array of (attribute, value), as long as the shorter of the two lists."""

    def zip_shorter(keys: Column) -> Column:
        return let(
            F.split(data, "~"),
            lambda values: F.transform(
                F.slice(keys, F.lit(1), F.least(F.size(keys), F.size(values))),
                lambda key, i: F.struct(key.alias("attribute"), F.get(values, i).alias("value")),
            ),
        )

    return let(F.split(mask, ","), zip_shorter)


def unpivot_audit(df: DataFrame, key: str, mask: str, data: str) -> DataFrame:
    """One row per attribute and value."""
    return inline_rows(df, [key], paired(F.col(mask), F.col(data)))


def changed_values(df: DataFrame, key: str, mask: str, data: str) -> DataFrame:
    """Non-empty values only, split at the comma into (entry, value, identifier)."""
    pairs = unpivot_audit(df, key, mask, data).filter(F.length("value") > 0)
    parts = F.split("value", ",")
    return pairs.select(
        key,
        F.col("attribute").alias("entry"),
        F.get(parts, F.lit(0)).alias("value"),
        F.get(parts, F.lit(1)).alias("identifier"),
    )


def with_changes(df: DataFrame, mask: str, data: str, name: str = "changes") -> DataFrame:
    """The non-empty pairs as an array per row: (attribute, parts)."""
    kept = F.filter(paired(F.col(mask), F.col(data)), lambda p: F.length(p["value"]) > 0)
    return df.withColumn(
        name,
        F.transform(kept, lambda p: F.struct(p["attribute"].alias("attribute"), F.split(p["value"], ",").alias("parts"))),
    )


@udtf(returnType="attribute: string, value: string", useArrow=True)
class AuditPairs:
    """Table function for SQL: the (attribute, value) pairs of a comma-separated mask and a `~`-separated data string, paired
    by position, as long as the shorter list; a null mask or data gives no rows (as `paired` does)."""

    def eval(self, mask: str | None, data: str | None):
        if mask is None or data is None:
            return
        yield from zip(mask.split(","), data.split("~"))


def register_audit_pairs(spark: SparkSession, name: str = "audit_pairs") -> str:
    """Make the table function callable from SQL: SELECT ... FROM t, LATERAL audit_pairs(t.mask, t.data)."""
    spark.udtf.register(name, AuditPairs)
    return name
