"""Reconstruction by a trained autoencoder (the non-linear sibling of
``reconstruct.py``; its models serve in the same places).

Standardised features pass dense layers d → 64 → dropout → k → 64 → d, ReLU
but for the last one; the loss is the mean squared error. A share of the rows,
chosen by a hash of the key, is kept for validation, the others are dealt by
another hash to ``steps`` mini-batches, which are folders of one written
table. A step reads its folder, sums the gradient over all tasks and moves the
weights (Adam); so the model depends on the rows and not on how they are
partitioned, but for the rounding of sums. After each epoch the validation
error decides: the rate is halved after ``plateau`` epochs without a gain, the
fit ends after ``patience`` of them, and the best weights are kept. The
threshold is the exact 95th percentile of the errors of all fitted rows.

Defined results: incomplete rows take no part in the fit and have no error;
without validation rows the training loss decides; equal keys share their
mini-batch. A constant feature is divided by 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import complete_rows
from .gradient import Adam, Weights, row_dropout, summed
from .quantiles import exact_quantiles

VALID_SHARE = 10  # one row in so many
VALID = -1


@dataclass
class Autoencoder:
    features: list[str]
    layers: tuple[int, ...] = (64, 16, 64)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    flat: np.ndarray | None = None
    threshold: float = float("nan")
    history: list[tuple[float, float]] = field(default_factory=list)  # (validation error, rate) of each epoch

    @property
    def weights(self) -> Weights:
        sizes, shapes = (len(self.features), *self.layers, len(self.features)), {}
        for i, (a, b) in enumerate(zip(sizes, sizes[1:])):
            shapes |= {f"w{i}": (a, b), f"b{i}": (b,)}
        return Weights(shapes)

    def with_error(self, df: DataFrame, name: str) -> DataFrame:
        """Adds the mean squared error, in Arrow batches; NULL for incomplete rows."""
        mean, scale, w = np.asarray(self.mean), np.asarray(self.scale), self.weights.split(self.flat)

        @F.pandas_udf(T.DoubleType())
        def error(*cols: pd.Series) -> pd.Series:
            z = (np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in cols]) - mean) / scale
            e = np.mean((forward(z, w)[0] - z) ** 2, axis=1)
            return pd.Series(e).where(~np.isnan(e), None)

        return df.withColumn(name, error(*[F.col(c).cast("double") for c in self.features]))


def forward(z: np.ndarray, w: dict[str, np.ndarray], keep: np.ndarray | None = None):
    """(output, inputs of each layer, what is before each ReLU); ``keep``
    scales the units of the first layer."""
    n, x, inputs, before = len(w) // 2, z, [], []
    for i in range(n):
        inputs.append(x)
        a = x @ w[f"w{i}"] + w[f"b{i}"]
        before.append(a)
        x = np.maximum(a, 0.0) if i < n - 1 else a
        if i == 0 and keep is not None:
            x = x * keep
    return x, inputs, before


def row_gradient(z: np.ndarray, model: Autoencoder, flat: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(gradient, loss) summed over the rows."""
    w = model.weights.split(flat)
    out, inputs, before = forward(z, w, keep)
    diff = out - z
    d, g, n = 2.0 * diff / z.shape[1], {}, len(inputs)
    for i in range(n - 1, -1, -1):
        if i < n - 1:
            if i == 0 and keep is not None:
                d = d * keep
            d = d * (before[i] > 0)
        g |= {f"w{i}": inputs[i].T @ d, f"b{i}": d.sum(axis=0)}
        d = d @ w[f"w{i}"].T
    return model.weights.join(g), float(np.sum(diff * diff) / z.shape[1])


def _moment(df: DataFrame, cols: list[str], about: np.ndarray, power: int) -> tuple[float, np.ndarray]:
    def sums(b: pd.DataFrame) -> np.ndarray:
        x = b[cols].to_numpy(dtype=float) - about
        return np.append((x ** power).sum(axis=0), len(x))
    s = summed(df, sums, len(cols) + 1)
    return s[-1], s[:-1]


def fit_autoencoder(df: DataFrame, features: list[str], key: str = "id", layers: tuple[int, ...] = (64, 16, 64), epochs: int = 20,
                    steps: int = 4, rate: float = 0.003, share: float = 0.2, patience: int = 10, plateau: int = 5,
                    quantile: float = 0.95, seed: int = 42) -> Autoencoder:
    model = Autoencoder(list(features), tuple(layers))
    rows = df.select(F.col(key).cast("long").alias("_key"), *[F.col(c).cast("double").alias(c) for c in features])
    rows = complete_rows(rows, features)
    part = F.when(F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(VALID_SHARE)) == 0, VALID).otherwise(F.pmod(F.xxhash64("_key", F.lit(seed + 1)), F.lit(steps)))
    parts = materialize(rows.withColumn("part", part.cast("int")), "autoencoder-rows", partition_by="part")
    n, total = _moment(parts.select(*features), features, np.zeros(len(features)), 1)
    model.mean = total / max(n, 1)
    _, squares = _moment(parts.select(*features), features, model.mean, 2)
    std = np.sqrt(squares / max(n, 1))
    model.scale = np.where(std > 1e-12 * np.maximum(np.abs(model.mean), 1e-300), std, 1.0)
    size, flat = model.weights.size, model.weights.start(seed)

    def step(k: int, at: np.ndarray, s: int | None) -> tuple[np.ndarray, float, float]:
        """(gradient, loss, rows) of a mini-batch; without dropout if ``s`` is None."""
        def sums(b: pd.DataFrame) -> np.ndarray:
            z = (b[features].to_numpy(dtype=float) - model.mean) / model.scale
            keep = row_dropout(b["_key"].to_numpy(np.int64), layers[0], s, share) if s is not None and share > 0 else None
            g, loss = row_gradient(z, model, at, keep)
            return np.concatenate([g, [loss, len(z)]])
        got = summed(parts.where(F.col("part") == k).select("_key", *features), sums, size + 2)
        return got[:size] / max(got[-1], 1), got[size], got[-1]

    adam, best, stale = Adam(size, rate), (float("inf"), flat), 0
    for e in range(epochs):
        loss = seen = 0.0
        for k in range(steps):
            g, lost, count = step(k, flat, seed + 1 + e)
            loss, seen = loss + lost, seen + count
            if count:
                flat = adam.step(flat, g)
        _, lost, count = step(VALID, flat, None)
        error = lost / count if count else loss / max(seen, 1)
        model.history.append((error, adam.rate))
        if error < best[0]:
            best, stale = (error, flat), 0
        else:
            stale += 1
            if stale >= patience:
                break
            if stale % plateau == 0:
                adam.rate *= 0.5
    model.flat = best[1]
    err = model.with_error(parts, "_e").select("_e").persist(StorageLevel.MEMORY_AND_DISK)
    found = exact_quantiles(err, "_e", [quantile])[0]
    err.unpersist()
    model.threshold = float("nan") if found is None else float(found)
    return model


def save_autoencoder(model: Autoencoder, spark: SparkSession, path: str) -> None:
    row = (model.features, list(model.layers), *(list(map(float, a)) for a in (model.mean, model.scale, model.flat)), float(model.threshold))
    spark.createDataFrame([row], "features array<string>, layers array<int>, mean array<double>, scale array<double>, flat array<double>, "
                                 "threshold double").write.mode("overwrite").parquet(path)


def load_autoencoder(spark: SparkSession, path: str) -> Autoencoder:
    r = spark.read.parquet(path).first()
    return Autoencoder(list(r["features"]), tuple(r["layers"]), *(np.array(r[c], dtype=float) for c in ("mean", "scale", "flat")), r["threshold"])
