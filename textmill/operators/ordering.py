"""Ranks and running sums over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import materialise


def global_running(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str] | None = None,
    rank: str | None = None,
) -> DataFrame:
    """Add a 1-based rank and running sums in the total order `order`.

    Rows are range-partitioned by the order keys and checkpointed, so that the partition
    bounds are sampled once. Each partition gets its own window, and the totals of the
    partitions before it, one row per partition, are joined by broadcast. The order keys must
    be unique (aggregate first), so that no key fills a partition by itself.
    """
    sums = dict(sums or {})
    ranged = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slice", F.spark_partition_id())
    )
    totals = ranged.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{out}") for out, c in sums.items()]
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_sum_{out}") for out in sums],
    )
    inside = Window.partitionBy("_slice").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = ranged.join(F.broadcast(offsets), "_slice")
    columns = {out: F.sum(c).over(running) + F.col(f"_sum_{out}") for out, c in sums.items()}
    if rank:
        columns[rank] = F.row_number().over(inside) + F.col("_rows")
    return joined.withColumns(columns).drop("_slice", "_rows", *[f"_sum_{out}" for out in sums])
