"""Ensemble classifier over the six score features, its random
hyper-parameter search (cross-validation on a stratified fold column),
feature importance and batch scoring with the forest-only fallback.

A fit is a chain of short jobs: in a search, regressions and evaluations read
the rows in as few parts as ROWS_A_PART allows, and fits run side by side to
fill the cores. Forests keep the parts of the cached rows, as they draw their
rows by part. Forests over more rows than that would keep a number of draws and
a node for each row and tree, so those of a search are grown from counted cells
(``cell_forest``), all in one job."""

from __future__ import annotations

import math
import random
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import defaulted_id
from ..schemas import ENSEMBLE_FEATURES
from .cell_forest import FoldCells

ROWS_A_PART = 50_000
MOST_ROWS_A_PART = 1_000_000  # where parts grow to be two a core
MOST_FITS = 6  # side by side; the driver holds the splits of a forest's level for each
FOLDS = 3


def _classifier(kind: str, params: dict, n_rows: int, label: str, seed: int):
    if kind == "rf":
        # each row's node is kept between levels (the same trees), not walked to from the root
        return RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed, cacheNodeIds=True, checkpointInterval=-1,
                                      numTrees=int(params["n_estimators"]), maxDepth=int(params["max_depth"]))
    # C·Σloss + ½‖w‖²  ≡  (1/n)Σloss + (1/(C·n))·½‖w‖²
    return LogisticRegression(labelCol=label, featuresCol="features", maxIter=1000, standardization=False,
                              elasticNetParam=0.0, regParam=1.0 / (float(params["C"]) * max(n_rows, 1)))


def ensemble_pipeline(kind: str, params: dict, n_rows: int, features=ENSEMBLE_FEATURES,
                      label: str = "Class", seed: int = 42) -> Pipeline:
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[asm, _classifier(kind, params, n_rows, label, seed)])


def fit_ensemble(train: DataFrame, kind: str, params: dict, features=ENSEMBLE_FEATURES,
                 label: str = "Class", seed: int = 42) -> PipelineModel:
    data = train.withColumn(label, F.col(label).cast("double"))
    return ensemble_pipeline(kind, params, data.count(), features, label, seed).fit(data)


def predict_proba(model: PipelineModel, df: DataFrame, prob: str = "ensemble_prob",
                  pred: str = "ensemble_pred") -> DataFrame:
    """Positive-class probability and the strict ``p > 0.5`` prediction."""
    out = model.transform(df)
    out = out.withColumn(prob, vector_to_array("probability")[1])
    keep = [c for c in df.columns] + [prob]
    return out.select(*keep).withColumn(pred, (F.col(prob) > 0.5).cast("int"))


def draw_trials(n_trials: int = 20, seed: int = 42) -> list[dict]:
    """Seeded random search space: rf(n 50–200, depth 3–10) or lr(C log 0.01–10)."""
    rng = random.Random(seed)
    out = []
    for t in range(n_trials):
        if rng.random() < 0.5:
            out.append({"trial": t, "model": "rf", "n_estimators": rng.randint(50, 200),
                        "max_depth": rng.randint(3, 10), "C": None})
        else:
            c = math.exp(rng.uniform(math.log(0.01), math.log(10.0)))
            out.append({"trial": t, "model": "lr", "n_estimators": None, "max_depth": None, "C": c})
    return out


def n_parts(spark: SparkSession, n_rows: int) -> int:
    """A part for each ROWS_A_PART rows, or two a core if those can hold the rows."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(math.ceil(n_rows / ROWS_A_PART), max(2 * cores, math.ceil(n_rows / MOST_ROWS_A_PART))))


def in_parts(df: DataFrame, n_rows: int) -> DataFrame:
    """``df`` in at most ``n_parts`` parts."""
    return df.coalesce(n_parts(df.sparkSession, n_rows))


def fits_at_once(spark: SparkSession, n_rows: int, parallelism: int) -> int:
    """``parallelism``, or more if fits have few parts: two parts a core, as
    the driver works on a fit between its jobs."""
    cores = spark.sparkContext.defaultParallelism
    return max(parallelism, min(MOST_FITS, 2 * cores // n_parts(spark, n_rows)))


def forest_cells(data: DataFrame, n_rows: int, folds: list, fold_col: str, features, label: str) -> FoldCells | None:
    """The cells of the folds if there are too many rows for forests over rows."""
    return FoldCells.of(data, folds, fold_col, features, label) if n_rows > ROWS_A_PART else None


def fit_auc(data: DataFrame, setting: dict, n_fit: int, fold, fold_col: str, features, label: str, seed: int) -> float:
    """AUC on the rows of ``fold`` of a model of all other rows of ``data``, which is cached."""
    few = in_parts(data, n_fit)
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability", metricName="areaUnderROC", numBins=0)
    model = ensemble_pipeline(setting["model"], setting, n_fit, features, label, seed).fit((few if setting["model"] == "lr" else data).where(F.col(fold_col) != fold))
    return ev.evaluate(model.transform(few.where(F.col(fold_col) == fold)))


def search(df: DataFrame, n_trials: int = 20, fold_col: str = "fold", features=ENSEMBLE_FEATURES,
           label: str = "Class", seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Trial table (trial, model, n_estimators, max_depth, C, auc): the mean
    AUC of every drawn setting over the folds 0, 1 and 2."""
    trials = draw_trials(n_trials, seed)
    data, cells = df.withColumn(label, F.col(label).cast("double")).cache(), None
    try:
        sizes = {r[0]: r["count"] for r in data.groupBy(fold_col).count().collect()}  # a row a fold
        n = sum(sizes.values())
        if set(sizes) != set(range(FOLDS)):
            raise ValueError(f"{fold_col} must hold each of the folds 0 to {FOLDS - 1} and no other: {sorted(map(str, sizes))}")
        n_fit = int(round(n * 2 / 3))  # rows per training fold
        # the long ones first: forests by their nodes
        jobs = [(t, f) for t in sorted(trials, key=lambda t: -(t["n_estimators"] or 0) * 2 ** (t["max_depth"] or 0)) for f in range(FOLDS)]
        if any(t["model"] == "rf" for t in trials):
            cells = forest_cells(data, n, list(range(FOLDS)), fold_col, features, label)
        forests = [j for j in jobs if cells and j[0]["model"] == "rf"]
        jobs = [j for j in jobs if j not in forests]
        with ThreadPool(fits_at_once(df.sparkSession, n, parallelism)) as pool:
            grown = pool.apply_async(lambda: cells.aucs(forests, seed) if forests else [])
            aucs = pool.map(lambda j: fit_auc(data, j[0], n_fit, j[1], fold_col, features, label, seed), jobs, chunksize=1)
            jobs, aucs = forests + jobs, grown.get() + aucs
    finally:
        data.unpersist()
        if cells:
            cells.release()
    by = {(t["trial"], f): auc for (t, f), auc in zip(jobs, aucs)}
    rows = [(t["trial"], t["model"], t["n_estimators"], t["max_depth"], t["C"], sum(by[t["trial"], f] for f in range(FOLDS)) / FOLDS)
            for t in sorted(trials, key=lambda t: t["model"] != "rf")]
    # one row per trial: a small, fixed-size table
    return df.sparkSession.createDataFrame(rows, "trial int, model string, n_estimators int, max_depth int, C double, auc double")


def best_trial(trials: DataFrame) -> DataFrame:
    """Keep-best: the trial with the highest AUC (ties → lowest trial id)."""
    return trials.agg(F.max_by(F.struct(*trials.columns), F.struct(F.col("auc"), -F.col("trial"))).alias("b")).select("b.*")


def feature_importance(model: PipelineModel, features=ENSEMBLE_FEATURES) -> DataFrame | None:
    """(feature, importance) sorted descending; None for a linear model.
    The importances live in the fitted model on the driver (one per feature)."""
    clf = model.stages[-1]
    if not hasattr(clf, "featureImportances"):
        return None
    spark = SparkSession.getActiveSession()
    rows = list(zip(features, map(float, clf.featureImportances.toArray())))
    imp = spark.createDataFrame(rows, "feature string, importance double")
    return imp.orderBy(F.col("importance").desc(), "feature")


def fallback_predictions(df: DataFrame, iso: str = "iso_score", iso_pred: str = "iso_pred",
                         key: str = "id") -> DataFrame:
    """Forest-only serving: prediction = outlier flag, confidence = |score|."""
    return df.select(defaulted_id(df, key).alias("transaction_id"),
                     F.col(iso_pred).cast("int").alias("prediction"),
                     F.abs(F.col(iso)).alias("confidence"), F.col(iso).alias(iso), *[c for c in df.columns
                                                                                      if c not in (iso, iso_pred, key)])


def score_ensemble(df: DataFrame, model: PipelineModel | None, iso: str = "iso_score",
                   iso_pred: str = "iso_pred") -> DataFrame:
    """Final prediction/confidence: the ensemble when a model exists, else the
    forest alone (``confidence = |iso_score|``)."""
    if model is None:
        return df.withColumn("prediction", F.col(iso_pred).cast("int")) \
                 .withColumn("confidence", F.abs(F.col(iso)))
    p = predict_proba(model, df)
    return p.withColumn("prediction", F.col("ensemble_pred")).withColumn("confidence", F.col("ensemble_prob"))
