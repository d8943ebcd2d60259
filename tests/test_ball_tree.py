"""The tree of balls: exact against brute force, and work below n sqrt n."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators.ball_tree import tree_knn
from txnlens.operators.resample import knn_join


def brute(x, k):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    out = {}
    for i in range(len(x)):
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (d[i, j], j))[:k]
        out.update({(i, r + 1): (j, d[i, j]) for r, j in enumerate(order)})
    return out


def frame(spark, x):
    rows = [(int(i), *map(float, p)) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double")


@pytest.mark.parametrize("shape", ["grid", "line", "few", "far"])
def test_tree_equals_brute_force(spark, shape):
    rng = np.random.default_rng(7)
    x = {"grid": rng.integers(0, 12, (260, 2)).astype(float),  # ties and copies
         "line": np.stack([np.arange(200.0), np.zeros(200)], 1),
         "few": rng.normal(size=(4, 2)),  # fewer than k + 1 points
         "far": np.concatenate([rng.normal(size=(150, 2)), 1e6 + rng.normal(size=(7, 2))])}[shape]
    points = frame(spark, x).select(F.col("id").alias("_q"), "a", "b", (F.col("id") % 3 != 1).alias("_ask"))
    work = {}
    got = {(r["_q"], r["nn_rank"]): r["_x"] for r in tree_knn(points, ["a", "b"], 5, cell_size=12, fanout=4, work=work).collect()}
    assert got == {q: v[0] for q, v in brute(x, 5).items() if q[0] % 3 != 1}
    assert work["levels"] >= 1 or len(x) <= 12


def test_join_by_tree_with_hot_copies(spark):
    x = np.concatenate([np.random.default_rng(3).integers(0, 9, (120, 2)), np.full((90, 2), 4)]).astype(float)
    got = {(r.id, r.nn_rank): (r.nn_id, round(r.dist ** 2, 6))
           for r in knn_join(frame(spark, x), ["a", "b"], k=5, cell_size=12, max_pivots=2).collect()}
    assert got == {q: (j, round(float(d), 6)) for q, (j, d) in brute(x, 5).items()}


def test_work_grows_less_than_n_sqrt_n(spark):
    # measured per n log n: 40, 58 and 69, so a bound of 1.5 for n log n itself is not met at these sizes
    share = []
    for n in (500, 2000, 8000):
        pts = spark.range(n).select(F.col("id").alias("_q"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.lit(True).alias("_ask"))
        work = {}
        assert tree_knn(pts, ["a", "b"], 5, cell_size=32, fanout=16, work=work).count() == 5 * n
        share.append(work["distances"] / (n * math.log2(n)))
    flat = math.sqrt(16) / (math.log2(8000) / math.log2(500))  # growth of n sqrt n, 2.77
    assert share[2] < 0.75 * flat * share[0], share


def test_few_cells_a_point_by_small_cells(spark):
    """Nodes just above a cell's size were split into cells of single points, whose candidates came from everywhere."""
    pts = spark.range(6000).select(F.col("id").alias("_q"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.lit(True).alias("_ask"))
    work = {}
    assert tree_knn(pts, ["a", "b"], 5, cell_size=32, fanout=32, work=work).count() == 5 * 6000
    assert work["distances"] < 6000 * 2000, work


def test_cells_equal_brute_force_with_repeated_and_null_keys(spark):
    from txnlens.operators.cell_knn import nearest_in_cells

    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (300, 2)).astype(float)
    key = [None if i % 41 == 0 else i // 2 for i in range(300)]
    rows = [(0, key[i], float(x[i, 0]), float(x[i, 1])) for i in range(300)]
    df = spark.createDataFrame(rows, "cell int, k long, a double, b double").repartition(7)
    asked = df.select("cell", F.col("k").alias("_q"), F.lit(2.0).alias("theta"), "a", "b")
    got = {}
    for r in nearest_in_cells(asked, df.select("cell", F.col("k").alias("_x"), "a", "b"), ["a", "b"], 4).collect():
        got.setdefault(r["_q"], []).append((r["nn_rank"], r["_d2"], r["_x"]))
    want = {}
    for i in range(300):
        for j in range(300):
            d2 = float(((x[i] - x[j]) ** 2).sum())
            if key[i] is not None and key[j] is not None and key[i] != key[j] and math.sqrt(d2) <= 2.0:
                want.setdefault(key[i], []).append((d2, key[j]))
    assert {q: sorted(v) for q, v in got.items()} == {q: [(r + 1, *p) for r, p in enumerate(sorted(v)[:4])] for q, v in want.items()}
