"""Forests from counted cells: the trees of Spark's classifier, and its AUC."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnlens.operators import ensemble, tuning
from txnlens.operators.cell_forest import FoldCells, tree_votes, weighted_auc
from txnlens.operators.tuning import ENSEMBLE_SPACE


def rows(spark, n, nulls=False):
    rng, out = random.Random(7), []
    for i in range(n):
        a, b, c = rng.randrange(20), rng.randrange(12), rng.random()
        y = int(rng.random() < 1 / (1 + math.exp(4 - 0.2 * a - 0.15 * b - (a > 9) * (b < 5))))
        out.append((i, i % 3, y, None if nulls and i % 11 == 0 else float(a), float("nan") if nulls and i % 17 == 0 else float(b), round(c, 3)))
    return spark.createDataFrame(out, "id long, fold int, Class int, a double, b double, c double").repartition(5)


@pytest.mark.parametrize("depth", [3, 8])
def test_a_tree_is_that_of_the_classifier(spark, depth):
    d = rows(spark, 1500).withColumn("Class", F.col("Class").cast("double"))
    asm = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    model = DecisionTreeClassifier(labelCol="Class", maxDepth=depth).fit(asm.transform(d))
    got = model.transform(asm.transform(d)).select("a", "b", "Class", vector_to_array("probability")[1].alias("p")).toPandas()
    x = got[["a", "b"]].to_numpy().astype(np.uint8)
    votes = tree_votes((x, got["Class"].to_numpy(), np.ones(len(x))), x, [20, 12], depth, None, some_features=False)
    assert np.allclose(votes, got["p"], atol=1e-12) and len(set(votes)) >= 4


def test_cells_count_every_row_once_a_fold(spark):
    d = rows(spark, 900, nulls=True).withColumn("Class", F.col("Class").cast("double"))
    cells = FoldCells.of(d, [0, 1, 2], "fold", ["a", "b", "c"], "Class")
    for fold, ((bins, y, w), (held, _, held_w)) in cells.cells.value.items():
        assert w.sum() == 600 and held_w.sum() == 300 and bins.max() <= 31 and len({(*b, q) for b, q in zip(bins.tolist(), y)}) == len(bins)
        assert (y * w).sum() == d.where(F.col("fold") != fold).agg(F.sum("Class")).first()[0]
        assert held_w[held[:, 0] == 19].sum() == d.where((F.col("fold") == fold) & (F.col("a").isNull() | (F.col("a") == 19))).count()
    again = FoldCells.of(d.repartition(2), [0, 1, 2], "fold", ["a", "b", "c"], "Class")
    setting = {"n_estimators": 25, "max_depth": 5}
    assert cells.aucs([(setting, 0), (setting, 2)], 42) == again.aucs([(setting, 0), (setting, 2)], 42)
    assert FoldCells.of(d, [0], "fold", ["a", "b", "c"], "Class", most=10) is None
    assert FoldCells.of(d.withColumn("Class", F.col("Class") * 2), [0], "fold", ["a"], "Class") is None


def test_weighted_auc_counts_pairs():
    rng = np.random.default_rng(1)
    s, y, w = rng.integers(0, 9, 60) / 9, rng.integers(0, 2, 60), rng.integers(1, 5, 60)
    s_, y_ = np.repeat(s, w), np.repeat(y, w)
    pairs = [(p > q) + 0.5 * (p == q) for p in s_[y_ == 1] for q in s_[y_ == 0]]
    assert weighted_auc(s, y, w) == pytest.approx(np.mean(pairs)) and math.isnan(weighted_auc(s, y * 0, w))


def test_forests_rank_as_those_of_the_classifier(spark):
    """The same job with other draws: AUCs of both agree."""
    d = rows(spark, 6000).withColumn("Class", F.col("Class").cast("double")).cache()
    features, setting = ["a", "b", "c"], {"model": "rf", "n_estimators": 60, "max_depth": 6}
    own = FoldCells.of(d, [0, 1, 2], "fold", features, "Class").aucs([(setting, f) for f in range(3)], 42)
    its = [ensemble.fit_auc(d, setting, 4000, f, "fold", features, "Class", 42) for f in range(3)]
    assert own == pytest.approx(its, abs=0.012) and all(a > 0.7 for a in own)


@pytest.mark.parametrize("how", [ensemble.search, tuning.adaptive_search])
def test_searches_over_many_rows_keep_no_row_a_tree(spark, monkeypatch, how):
    """More rows than a part: no forest over rows is fitted; every trial is judged."""
    monkeypatch.setattr(ensemble, "ROWS_A_PART", 500)
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *_: pytest.fail("a forest over rows"))
    d = rows(spark, 1200)
    if how is ensemble.search:
        t = how(d, n_trials=4, features=["a", "b", "c"])
    else:
        t = how(d, n_trials=4, features=["a", "b", "c"], space={"rf": ENSEMBLE_SPACE["rf"]})
    got = t.collect()
    assert {r["trial"] for r in got} == {0, 1, 2, 3} and any(r["model"] == "rf" for r in got) and all(0.6 < r["auc"] < 1 for r in got)
