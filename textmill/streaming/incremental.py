"""Clean only files that were not processed yet, with the progress kept in a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RECENT = "spark.sql.streaming.numRecentProgressUpdates"


def process_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    files_per_batch: int = 1000,
) -> int:
    """Run `transform` over the parquet files that arrived since the last call; returns the rows read.

    The transform works row by row (cleaning, tokens, features), so no state is kept. Files are
    taken once, also after a failure.
    """
    arriving = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    # the query keeps its latest progress records only, as many as the setting says at each batch; all of them are summed here
    kept = spark.conf.get(RECENT)
    spark.conf.set(RECENT, str(2**31 - 1))
    try:
        running = (
            transform(arriving)
            .writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
        return sum(p["numInputRows"] for p in running.recentProgress)
    finally:
        spark.conf.set(RECENT, kept)
