"""Reconstruction-error anomaly model (a linear autoencoder).

Fit on normal rows: standardise every feature (population std, std 0 → 1),
take the principal components (a distributed Gramian), and set the
threshold at the exact 95th percentile of the training errors. The error of
a row is mean((z − P Pᵀ z)²) = (‖z‖² − ‖Pᵀz‖²)/d for orthonormal P.

The principal components come from the covariance of z, built as a
distributed Gramian: one zᵀz per Arrow batch in ``mapInPandas`` and a Spark
sum by matrix cell (d² + d + 1 numbers leave each partition), then a d×d
eigendecomposition on the driver (the same split as Spark ML's PCA, which
computes the Gramian on executors and the SVD locally). Scoring is one
matrix product per Arrow batch in a pandas UDF.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import complete_rows
from .quantiles import exact_quantiles


@dataclass
class ReconstructionModel:
    features: list[str]
    center: list[float]
    scale: list[float]
    components: np.ndarray  # d × k, orthonormal columns
    threshold: float

    def with_error(self, df: DataFrame, name: str) -> DataFrame:
        """Adds the error with an Arrow-batched pandas UDF: one (rows × d) @
        (d × k) product per batch. The d×k matrix and the scaler travel
        with the function (fixed size, independent of the data). As one
        generated projection the d·k products fall out of whole-stage
        codegen and run about 20× slower."""
        center = np.asarray(self.center, dtype=float)
        scale = np.asarray(self.scale, dtype=float)
        comps = np.asarray(self.components, dtype=float)

        @F.pandas_udf(T.DoubleType())
        def error(*cols: pd.Series) -> pd.Series:
            z = (np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in cols]) - center) / scale
            proj = z @ comps
            e = ((z * z).sum(axis=1) - (proj * proj).sum(axis=1)) / z.shape[1]
            return pd.Series(np.maximum(e, 0.0))

        return df.withColumn(name, error(*[F.col(c).cast("double") for c in self.features]))


def gram_moments(df: DataFrame, cols: list[str], shift: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, column sums, XᵀX) of the numeric columns less ``shift`` (a point
    near the data, against cancellation), computed per Arrow batch and summed
    by Spark; only d² + d + 1 numbers reach the driver."""
    d = len(cols)

    def partial(it):
        n, s, g = 0, np.zeros(d), np.zeros((d, d))
        for pdf in it:
            X = pdf[cols].to_numpy(dtype=float) - shift
            n += len(X)
            s += X.sum(axis=0)
            g += X.T @ X
        vals = np.concatenate([[float(n)], s, g.ravel()])
        yield pd.DataFrame({"i": np.arange(len(vals), dtype=np.int32), "v": vals})

    rows = df.select(*cols).mapInPandas(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    vals = np.zeros(1 + d + d * d)
    for r in rows:
        vals[r["i"]] = r["v"]
    return int(vals[0]), vals[1:1 + d], vals[1 + d:].reshape(d, d)


def fit_reconstruction(df: DataFrame, features: list[str], k: int = 16, quantile: float = 0.95) -> ReconstructionModel:
    """One pass over the complete training rows gives the moments, from which
    mean, deviation and the covariance of the standardised features follow; a
    second one the errors. Only these are kept, for the percentile: the wide rows
    are read twice, so a caller with costly rows keeps what they come from."""
    df = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    full = complete_rows(df, features)
    some = full.limit(1).collect()
    shift = np.array([some[0][c] for c in features], dtype=float) if some else np.zeros(len(features))
    n, total, gram = gram_moments(full, features, shift)
    mean = total / max(n, 1)
    cov = gram / max(n, 1) - np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(cov), 0.0))
    scale = np.where(std > 1e-12 * np.maximum(np.abs(mean + shift), 1e-300), std, 1.0)
    w, v = np.linalg.eigh(cov / np.outer(scale, scale))
    comps = v[:, np.argsort(w)[::-1][:min(k, len(features))]]
    model = ReconstructionModel(features, [float(x) for x in mean + shift], [float(x) for x in scale], comps, 0.0)
    err = model.with_error(df, "_e").select("_e").persist(StorageLevel.MEMORY_AND_DISK)
    model.threshold = float(exact_quantiles(err, "_e", [quantile])[0])
    err.unpersist()
    return model


def reconstruction_score(df: DataFrame, model: ReconstructionModel, score: str = "reconstruction_score",
                         pred: str = "reconstruction_pred") -> DataFrame:
    """Adds the mean squared reconstruction error and the flag error > threshold."""
    out = model.with_error(df, score)
    return out.withColumn(pred, (F.col(score) > F.lit(model.threshold)).cast("int"))


def save_reconstruction(model: ReconstructionModel, spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(model.features, model.center, model.scale,
                            [list(map(float, r)) for r in model.components], model.threshold)],
                          "features array<string>, center array<double>, scale array<double>, "
                          "components array<array<double>>, threshold double").write.mode("overwrite").parquet(path)


def load_reconstruction(spark: SparkSession, path: str) -> ReconstructionModel:
    r = spark.read.parquet(path).first()
    return ReconstructionModel(list(r["features"]), list(r["center"]), list(r["scale"]),
                               np.array(r["components"], dtype=float), float(r["threshold"]))
