"""Model persistence under one configurable root: scaler parameters,
isolation forest, reconstruction model, graph classifier, the range of the
scores, ensemble PipelineModel. Loading tolerates missing parts (serving then
uses the forest alone).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.forest import IsolationForestModel, load_forest, save_forest
from ..operators.reconstruct import ReconstructionModel, load_reconstruction, save_reconstruction
from .files import path_exists


@dataclass
class ModelSet:
    scaler: DataFrame
    forest: IsolationForestModel
    reconstruction: ReconstructionModel | None = None
    ensemble: PipelineModel | None = None
    features: list[str] | None = None
    graph: PipelineModel | None = None
    score_range: DataFrame | None = None


def save_params(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_models(spark: SparkSession, models: ModelSet, root: str, write_scaler: bool = True) -> None:
    """``write_scaler=False`` when the scaler was read from ``root`` itself."""
    if write_scaler:
        save_params(models.scaler, f"{root}/scaler")
    save_forest(models.forest, spark, f"{root}/forest")
    if models.reconstruction is not None:
        save_reconstruction(models.reconstruction, spark, f"{root}/reconstruction")
    for name, model in (("ensemble", models.ensemble), ("graph", models.graph)):
        if model is not None:
            model.write().overwrite().save(f"{root}/{name}")
    if models.score_range is not None:
        save_params(models.score_range, f"{root}/score_range")


def load_models(spark: SparkSession, root: str) -> ModelSet:
    scaler = load_params(spark, f"{root}/scaler").cache()
    forest = load_forest(spark, f"{root}/forest")
    recon = load_reconstruction(spark, f"{root}/reconstruction") if path_exists(spark, f"{root}/reconstruction") else None
    ens, graph = (PipelineModel.load(f"{root}/{n}") if path_exists(spark, f"{root}/{n}") else None for n in ("ensemble", "graph"))
    span = load_params(spark, f"{root}/score_range") if path_exists(spark, f"{root}/score_range") else None
    return ModelSet(scaler, forest, recon, ens, forest.features, graph, span)
