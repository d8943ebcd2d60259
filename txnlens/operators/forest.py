"""Isolation forest (Liu, Ting & Zhou 2008) fitted and scored by Spark.

Fit: every tree gets its own sample of psi = min(max_samples, n) rows drawn
by key hashes: row r enters the draw of tree t when hash(r, t) is below
min(1, 1.5·psi/n), and the psi smallest hashes of a tree are its sample. The
trees are grown in parallel with ``groupBy("tree").applyInPandas`` (each group
is about 1.5·psi rows, whatever n is). The forest is at most
trees·(2·psi − 1) nodes, a proven bound, so it is broadcast to the scorer.

Score: an Arrow-batched pandas UDF walks each tree for a slice of a batch at
once (vectorised over rows; the trees are laid out as complete ones, so a
step is an index calculation without a test for leaves). score = −2^(−E[h(x)]/c(psi)); the offset is
the exact ``contamination`` percentile of the training scores;
decision = score − offset; outlier (prediction 1) when decision < 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .quantiles import exact_quantiles

EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()), T.StructField("depth", T.IntegerType()),
])


def average_path_length(n):
    """c(n): expected path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(X: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    nodes: list = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append(None)
        n = len(idx)
        if depth >= max_depth or n <= 1:
            nodes[me] = (-1, float("nan"), -1, -1, n, depth)
            return me
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            nodes[me] = (-1, float("nan"), -1, -1, n, depth)
            return me
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < t
        if go_left.all() or not go_left.any():  # t fell on the minimum
            t = float(hi[f])
            go_left = sub[:, f] < t
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me] = (f, t, left, right, n, depth)
        return me

    build(np.arange(len(X)), 0)
    return nodes


def _tree_builder(features: list[str], max_depth: int, seed: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        X = pdf[features].to_numpy(dtype=float)
        X = np.nan_to_num(X, nan=0.0)
        rng = np.random.default_rng([seed, tree])
        rows = _grow(X, rng, max_depth)
        return pd.DataFrame([(tree, i, *r) for i, r in enumerate(rows)],
                            columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])
    return build


@dataclass
class IsolationForestModel:
    features: list[str]
    nodes: pd.DataFrame  # NODE_SCHEMA rows, small by construction
    psi: int
    n_trees: int
    offset: float
    contamination: float

    def arrays(self) -> dict:
        nd = self.nodes.sort_values(["tree", "node"])
        width = int(nd.groupby("tree")["node"].max().max()) + 1
        shape = (self.n_trees, width)
        out = {k: np.full(shape, v, dtype=dt) for k, v, dt in (
            ("feature", -1, np.int32), ("threshold", np.nan, float), ("left", -1, np.int32),
            ("right", -1, np.int32), ("size", 0, np.int32), ("depth", 0, np.int32))}
        trees = {t: i for i, t in enumerate(sorted(nd["tree"].unique()))}
        ti = nd["tree"].map(trees).to_numpy()
        ni = nd["node"].to_numpy()
        for k in out:
            out[k][ti, ni] = nd[k].to_numpy()
        out["leaf_len"] = out["depth"] + average_path_length(out["size"])
        out["c_psi"] = float(average_path_length([self.psi])[0])
        out["n_used"] = len(trees)
        return out


def tree_samples(df: DataFrame, n: int, n_trees: int, psi: int, seed: int, key: str) -> DataFrame:
    """Rows tagged with a tree id, at most psi per tree; a row may be drawn
    for several trees, by the same rule for every n."""
    share = min(1.0, 1.5 * psi / max(n, 1))

    def draw(t):
        return F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))

    drawn = df.withColumn("tree", F.explode(F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: draw(t) < F.lit(share))))
    w = Window.partitionBy("tree").orderBy(draw(F.col("tree")), F.col(key))
    return drawn.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi).drop("_r")


def _grown(data: DataFrame, features: list[str], n_trees: int, max_samples: int, contamination: float, seed: int, key: str) -> IsolationForestModel:
    """The trees; the offset is still 0."""
    n = data.count()
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    samples = tree_samples(data, n, n_trees, psi, seed, key)
    # explicit partitioning by tree: the small sample is not coalesced into
    # one task, so the trees grow in parallel; groupBy reuses it
    par = max(1, min(n_trees, data.sparkSession.sparkContext.defaultParallelism * 2))
    nodes = samples.repartition(par, "tree").groupBy("tree").applyInPandas(
        _tree_builder(features, max_depth, seed), NODE_SCHEMA)
    # forest size ≤ n_trees · (2·psi − 1) rows: a proven bound for the driver
    return IsolationForestModel(features, nodes.toPandas(), psi, n_trees, 0.0, contamination)


def fit_isolation_forest(df: DataFrame, features: list[str], n_trees: int = 100, max_samples: int = 256,
                         contamination: float = 0.1, seed: int = 42, key: str = "id") -> IsolationForestModel:
    # read for the count, the tree samples and the offset scores: persisted
    data = df.select(key, *[F.col(c).cast("double").alias(c) for c in features]).persist(StorageLevel.MEMORY_AND_DISK)
    model = _grown(data, features, n_trees, max_samples, contamination, seed, key)
    scored = score_samples(data, model, "_s").select("_s").cache()
    model.offset = float(exact_quantiles(scored, "_s", [contamination])[0])
    scored.unpersist()
    data.unpersist()
    return model


def fit_and_score(df: DataFrame, train: Column, features: list[str], keep: list[str], score: str = "iso_score", pred: str = "iso_pred",
                  n_trees: int = 100, max_samples: int = 256, contamination: float = 0.1, seed: int = 42, key: str = "id") -> DataFrame:
    """The ``keep`` columns, decision value and outlier flag of every row by
    a forest fitted on the ``train`` rows. Each row is scored once: the scores
    are written, and the offset is taken from those of the training rows."""
    own = df.where(train).select(key, *[F.col(c).cast("double").alias(c) for c in features])
    model = _grown(own, features, n_trees, max_samples, contamination, seed, key)
    marked = df.withColumn("_train", train)
    raw = materialize(score_samples(marked, model, "_iso_raw").select(*keep, "_train", "_iso_raw"), "forest-scores")
    model.offset = float(exact_quantiles(raw.where("_train"), "_iso_raw", [contamination])[0])
    return _decided(raw, model, score, pred).drop("_train")


SLICE = 2048  # rows that walk a tree together


def _complete(a: dict) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(steps, features, thresholds, leaf lengths) of the trees as complete
    ones, a row each: children of i are 2 i + 1 and 2 i + 2; below a leaf all
    thresholds are infinite and the leaf's length is at the left end."""
    steps, n = int(a["depth"].max()), a["n_used"]
    feature, threshold = np.zeros((n, 2 ** steps - 1), np.int64), np.full((n, 2 ** steps - 1), np.inf)
    length = np.zeros((n, 2 ** steps))
    for t in range(n):
        todo = [(0, 0, 0)]  # node, place, depth
        while todo:
            node, at, depth = todo.pop()
            if a["feature"][t, node] < 0:
                length[t, ((at + 1) << (steps - depth)) - 2 ** steps] = a["leaf_len"][t, node]
            else:
                feature[t, at], threshold[t, at] = a["feature"][t, node], a["threshold"][t, node]
                todo += [(a["left"][t, node], 2 * at + 1, depth + 1), (a["right"][t, node], 2 * at + 2, depth + 1)]
    return steps, feature, threshold, length


def _scorer(spark: SparkSession, model: IsolationForestModel):
    arrays = model.arrays()
    bc = spark.sparkContext.broadcast((*_complete(arrays), arrays["c_psi"]))

    @F.pandas_udf(T.DoubleType())
    def score(*cols: pd.Series) -> pd.Series:
        steps, feature, threshold, length, c_psi = bc.value
        total = np.zeros(len(cols[0]))
        for lo in range(0, len(total), SLICE):
            x = np.stack([c.iloc[lo:lo + SLICE].to_numpy(dtype=float) for c in cols])
            flat, n = np.nan_to_num(x, nan=0.0).ravel(), x.shape[1]
            rows = np.arange(n)
            for t in range(len(feature)):
                place, cut, node = feature[t] * n, threshold[t], np.zeros(n, np.int64)
                for _ in range(steps):
                    node = 2 * node + 1 + (flat.take(place.take(node) + rows) >= cut.take(node))
                total[lo:lo + SLICE] += length[t].take(node - (2 ** steps - 1))
        mean = total / max(len(feature), 1)
        return pd.Series(-np.power(2.0, -mean / c_psi) if c_psi > 0 else -np.ones(len(total)))

    return score


def score_samples(df: DataFrame, model: IsolationForestModel, name: str = "iso_raw") -> DataFrame:
    """Adds −2^(−E[h]/c(psi)) (in (−1, 0); lower = more anomalous)."""
    udf = _scorer(df.sparkSession, model)
    return df.withColumn(name, udf(*[F.col(c).cast("double") for c in model.features]))


def score_isolation_forest(df: DataFrame, model: IsolationForestModel, score: str = "iso_score",
                           pred: str = "iso_pred") -> DataFrame:
    """Adds the decision value (score − offset) and the outlier flag."""
    return _decided(score_samples(df, model, "_iso_raw"), model, score, pred)


def _decided(s: DataFrame, model: IsolationForestModel, score: str, pred: str) -> DataFrame:
    s = s.withColumn(score, F.col("_iso_raw") - F.lit(model.offset)).drop("_iso_raw")
    return s.withColumn(pred, (F.col(score) < 0).cast("int"))


def save_forest(model: IsolationForestModel, spark: SparkSession, path: str) -> None:
    spark.createDataFrame(model.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
    meta = spark.createDataFrame([(model.features, model.psi, model.n_trees, model.offset, model.contamination)],
                                 "features array<string>, psi int, n_trees int, offset double, contamination double")
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def load_forest(spark: SparkSession, path: str) -> IsolationForestModel:
    m = spark.read.parquet(f"{path}/meta").first()
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    return IsolationForestModel(list(m["features"]), nodes, m["psi"], m["n_trees"], m["offset"], m["contamination"])
