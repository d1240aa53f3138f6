"""Model registry: fitted models and dictionaries as files, and one table that lists them."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.ml.clustering import DistributedLDAModel, LDAModel, LocalLDAModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SCHEMA = "model_guid string, model_type string, scope string, path string, created timestamp, preparation string"


def save_model(
    spark: SparkSession,
    folder: str,
    guid: str,
    model: LDAModel,
    dictionary: DataFrame,
    model_type: str,
    scope: str,
    preparation: Mapping[str, object] | None = None,
) -> None:
    """Write the model and its dictionary, then append the registry row with the settings that texts were prepared with."""
    path = f"{folder}/models/{guid}"
    model.write().overwrite().save(f"{path}/model")
    dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
    row = [(guid, model_type, scope, path, datetime.now(), json.dumps(dict(preparation or {}), sort_keys=True))]
    spark.createDataFrame(row, SCHEMA).write.mode("append").parquet(f"{folder}/model_repository")


def models(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{folder}/model_repository")


def load_model(spark: SparkSession, folder: str, guid: str) -> tuple[LDAModel, DataFrame]:
    """Model and dictionary of a guid."""
    found = _row(spark, folder, guid)
    kind = DistributedLDAModel if found.model_type.endswith("em") else LocalLDAModel
    return kind.load(f"{found.path}/model"), spark.read.parquet(f"{found.path}/dictionary")


def load_preparation(spark: SparkSession, folder: str, guid: str) -> dict[str, object]:
    """The settings that the model's texts were prepared with."""
    return json.loads(_row(spark, folder, guid).preparation or "{}")


def _row(spark: SparkSession, folder: str, guid: str) -> Row:
    found = models(spark, folder).filter(F.col("model_guid") == guid).orderBy(F.desc("created")).first()
    if found is None:
        raise KeyError(guid)
    return found
