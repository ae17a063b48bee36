"""Fitted pipelines saved under the shared folder and loaded again.

A model is named by its training inputs and parameters. The registry table
learns of it after its files are written, so a save that broke off is not
found, and a model that is there is loaded, not trained again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_path
from .upsert import has_data

REGISTRY = "name string, path string, saved_at timestamp"


def registry_path(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tables", "model-registry")


def find_model(spark: SparkSession, name: str) -> PipelineModel | None:
    """The last saved model of a name."""
    path = registry_path(spark)
    if not has_data(spark, path):
        return None
    row = spark.read.schema(REGISTRY).parquet(path).where(F.col("name") == name).agg(F.max_by("path", "saved_at")).first()
    return PipelineModel.load(row[0]) if row[0] is not None else None


def save_model(spark: SparkSession, name: str, model: PipelineModel) -> None:
    path = shared_path(spark, "model")
    model.write().save(path)
    entry = spark.range(1).select(F.lit(name).alias("name"), F.lit(path).alias("path"), F.current_timestamp().alias("saved_at"))
    entry.write.mode("append").parquet(registry_path(spark))


def saved_models(spark: SparkSession, names: dict[str, str], train: Callable[[list[str]], dict[str, PipelineModel]]) -> dict[str, PipelineModel]:
    """Models by target from the registry; ``train`` fits those that are missing
    (all at once), which are saved and loaded back."""
    missing = [t for t, name in names.items() if find_model(spark, name) is None]
    for target, model in (train(missing) if missing else {}).items():
        save_model(spark, names[target], model)
    return {t: find_model(spark, name) for t, name in names.items()}
