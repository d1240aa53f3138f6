"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes the shuffle files of a statement at its end
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; on a cluster use the session it provides."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("textmill")
    folder = tempfile.mkdtemp(prefix="textmill-")
    for key, value in SETTINGS.items() | {("spark.checkpoint.dir", folder)}:
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Only a local session without the setting gets a temporary folder, set once for the whole session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textmill-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one folder for each application.

    Results read these tables until they are written elsewhere, so only tables inside a step that nothing reads any more are deleted
    while the application runs (`discard`); when it has ended, the folder textmill/<application id> can go as a whole.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/textmill/{application}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the statements inside go when each statement has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def materialise(df: DataFrame) -> DataFrame:
    """Write a table below the shared folder and read it back: lost executors cost no recomputation, and later reads
    still prune columns and know sizes. The table stands for its shuffles, whose files are dropped."""
    path = scratch_path(df.sparkSession, "table")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete the files of a table that `materialise` returned; nothing may read it, or what was derived from it, any more."""
    path = stored.sparkSession._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    path.getFileSystem(stored.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
