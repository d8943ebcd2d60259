"""The whole serving chain as one ``PipelineModel``.

Each fitted part (feature scaler, forest, reconstruction, graph classifier,
score range, ensemble) is a ``pyspark.ml`` Model with a writer and a reader of its
own, so ``PipelineModel.save`` and ``load`` keep the chain as a whole, and its
``transform`` gives what the parts give one after another. ``FeatureScaling``,
``ForestOutliers`` and ``ReconstructionErrors`` are the Estimators of the parts
that learn from the table alone; they can stand in a ``Pipeline``.

A chain without one of the optional parts serves the forest alone. A part's data
are small by construction: two numbers a column, the forest's nodes, a d x k matrix.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ensemble as ens
from .ensemble_features import apply_score_range
from .features import engineer_features, feature_columns, fit_feature_scaler
from .forest import fit_isolation_forest, load_forest, save_forest, score_isolation_forest
from .graph_model import graph_features, graph_scores
from .reconstruct import fit_reconstruction, load_reconstruction, reconstruction_score, save_reconstruction


class _PartWriter(MLWriter):
    def __init__(self, part):
        super().__init__()
        self.part = part

    def saveImpl(self, path: str) -> None:  # noqa: N802 (Spark's name)
        DefaultParamsWriter.saveMetadata(self.part, path, self.sparkSession)
        self.part.save_data(self.sparkSession, f"{path}/data")


class _PartReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        part = self.cls(self.cls.load_data(self.sparkSession, f"{path}/data"))
        part._resetUid(meta["uid"])
        return part


class Part(Model, MLReadable, MLWritable):
    """A fitted part of the chain around its ``model``."""

    def __init__(self, model=None):
        super().__init__()
        self.model = model

    def write(self) -> MLWriter:
        return _PartWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _PartReader(cls)


class _OneRow(Part):
    """A part whose model is a one-row parameter table."""

    def save_data(self, spark: SparkSession, path: str) -> None:
        self.model.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load_data(cls, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(path)


class ScaledFeatures(_OneRow):
    def _transform(self, df: DataFrame) -> DataFrame:
        if "id" not in df.columns:
            df = df.withColumn("id", F.monotonically_increasing_id())
        return engineer_features(df, self.model, keep=[c for c in df.columns if not c.startswith("V")])


class ForestScores(Part):
    def _transform(self, df: DataFrame) -> DataFrame:
        return score_isolation_forest(df, self.model)

    def save_data(self, spark: SparkSession, path: str) -> None:
        save_forest(self.model, spark, path)

    @classmethod
    def load_data(cls, spark: SparkSession, path: str):
        return load_forest(spark, path)


class ReconstructionScores(Part):
    def _transform(self, df: DataFrame) -> DataFrame:
        return reconstruction_score(df, self.model)

    def save_data(self, spark: SparkSession, path: str) -> None:
        save_reconstruction(self.model, spark, path)

    @classmethod
    def load_data(cls, spark: SparkSession, path: str):
        return load_reconstruction(spark, path)


class _Classifier(Part):
    """A part around a ``PipelineModel`` (None where ``data`` is missing)."""

    def save_data(self, spark: SparkSession, path: str) -> None:
        kept = [self.model] if self.model is not None else []
        PipelineModel(kept).write().overwrite().save(path)

    @classmethod
    def load_data(cls, spark: SparkSession, path: str):
        kept = PipelineModel.load(path).stages
        return kept[0] if kept else None


class GraphScores(_Classifier):
    """Three hops over the graph of the rows given, then the classifier."""

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = feature_columns(df)
        h = graph_features(df.select("id", "Time", "Amount", *[c for c in cols if c not in ("Time", "Amount")]), cols, hops=3)
        return df.join(graph_scores(self.model, h).select("id", "graph_score"), "id")


class ScoreRange(_OneRow):
    def _transform(self, df: DataFrame) -> DataFrame:
        return apply_score_range(df, self.model)


class FinalScores(_Classifier):
    def _transform(self, df: DataFrame) -> DataFrame:
        return ens.score_ensemble(df, self.model)


class FeatureScaling(Estimator):
    def _fit(self, df: DataFrame) -> ScaledFeatures:
        return ScaledFeatures(fit_feature_scaler(df))


class ForestOutliers(Estimator):
    def __init__(self, n_trees: int = 100, max_samples: int = 256, contamination: float = 0.1, seed: int = 42):
        super().__init__()
        self.settings = dict(n_trees=n_trees, max_samples=max_samples, contamination=contamination, seed=seed)

    def _fit(self, df: DataFrame) -> ForestScores:
        return ForestScores(fit_isolation_forest(df, feature_columns(df), **self.settings))


class ReconstructionErrors(Estimator):
    def __init__(self, k: int = 16, quantile: float = 0.95):
        super().__init__()
        self.settings = dict(k=k, quantile=quantile)

    def _fit(self, df: DataFrame) -> ReconstructionScores:
        return ReconstructionScores(fit_reconstruction(df, feature_columns(df), **self.settings))


def chain(scaler: DataFrame, forest, reconstruction=None, graph=None, score_range: DataFrame | None = None, ensemble=None) -> PipelineModel:
    """The serving chain of fitted parts; the forest alone while any of the
    other parts is absent."""
    first = [ScaledFeatures(scaler), ForestScores(forest)]
    if any(x is None for x in (reconstruction, graph, score_range, ensemble)):
        return PipelineModel([*first, FinalScores(None)])
    return PipelineModel([*first, ReconstructionScores(reconstruction), GraphScores(graph), ScoreRange(score_range), FinalScores(ensemble)])
