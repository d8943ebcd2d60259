"""Minority over-sampling: exact k-nearest-neighbour self-join + synthetic
interpolation (SMOTE, Chawla et al. 2002).

kNN without all pairs (pivot partitioning with triangle-inequality
pruning, after Lu et al., VLDB 2012):

1. P pivots are a hash sample of the points (P ≤ ``max_pivots``: the table
   that is broadcast); every point joins the cell of its nearest pivot (an
   Arrow-batched pandas UDF; distances to P pivots). When that many cells of
   ``cell_size`` don't hold the points, a tree of balls takes the place of the
   flat pivots (``ball_tree``), so cells keep their size.
2. Per cell c: radius R_c (max distance of its points to the pivot) and
   D_c, the distance from the pivot to its (k+1)-th nearest point anywhere
   (per-partition top-(k+1) in ``mapInPandas``, merged by pivot). For every
   q in c, its k-th neighbour is within θ_c = R_c + D_c.
3. A point x can be a neighbour of some q in c only if
   d(x, p_c) ≤ R_c + θ_c, so x is sent to exactly those cells.
4. Per cell, the candidates stream past the queries (``cell_knn``); pairs
   beyond θ_c are dropped and the k nearest per query (ties → lower key)
   are kept. The pruning is exact, never a cap.

Pivots are sampled from the data, so dense regions get proportionally more
pivots and cells stay balanced. Groups of more than k identical points are
answered without pairs (see ``knn_join``), so a hot value cannot make one
cell quadratic.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .ball_tree import tree_knn
from .cell_knn import SLACK, nearest_in_cells
from .common import complete_rows, join_small
from .sampling import hash_uniform, sample_exact, stratum_positions

REPLICA_CHUNK = 1024


def _pivot_distances(X: np.ndarray, piv: np.ndarray, piv_sq: np.ndarray) -> np.ndarray:
    d2 = (X * X).sum(axis=1)[:, None] + piv_sq[None, :] - 2.0 * (X @ piv.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _smallest_keys(df: DataFrame, features: list[str], m: int) -> DataFrame:
    """(features…, _top): the m smallest keys of every distinct vector.
    Each partition keeps at most m keys per vector (pandas, per Arrow
    batch); the merge collects at most m·partitions keys per vector — a
    bound that does not grow with the size of a group."""
    key_type = df.schema["_q"].dataType
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in features] + [T.StructField("_q", key_type)])

    def part(it):
        acc = []
        for pdf in it:
            acc.append(pdf.sort_values("_q").groupby(features, sort=False).head(m))
            if len(acc) > 16:
                acc = [pd.concat(acc).sort_values("_q").groupby(features, sort=False).head(m)]
        if acc:
            yield pd.concat(acc).sort_values("_q").groupby(features, sort=False).head(m)[features + ["_q"]]

    tops = df.select(*features, "_q").mapInPandas(part, schema)
    return tops.groupBy(*features).agg(F.slice(F.array_sort(F.collect_list("_q")), 1, m).alias("_top"))


def knn_join(df: DataFrame, features: list[str], k: int = 5, key: str = "id", cell_size: int = 1024,
             max_pivots: int = 2048, seed: int = 42) -> DataFrame:
    """(key, nn_rank 1..k, nn_key, dist): the k nearest other points of
    every point (Euclidean over ``features``; ties → lower key; NULL
    features skipped).

    Exact copies are handled first, so a hot value cannot make a cell
    quadratic: a point whose vector has more than k copies has its k
    nearest among them (distance 0, the lowest other keys), and every such
    group enters the candidate set only through its k+1 lowest keys (no
    query ever needs more of one identical group). The pivot join then runs
    over the remaining points."""
    spark = df.sparkSession
    pts = complete_rows(df.select(F.col(key).alias("_q"), *[F.col(c).cast("double").alias(c) for c in features]), features)
    copies = pts.groupBy(*features).agg(F.count(F.lit(1)).alias("_m"))
    tagged = materialize(pts.join(copies, features), "knn-points")  # written, not cached: nothing is left in memory
    dense = tagged.where(F.col("_m") > k).drop("_m")
    sparse = tagged.where(F.col("_m") <= k).drop("_m")
    top = _smallest_keys(dense, features, k + 1)
    top = materialize(top, "knn-copies")
    others = F.slice(F.filter("_top", lambda x: x != F.col("_q")), 1, k)
    dense_nn = dense.join(top, features).select("_q", F.posexplode(others).alias("_p", "_x")).select(
        F.col("_q").alias(key), (F.col("_p") + 1).cast("int").alias("nn_rank"), F.col("_x").alias(f"nn_{key}"),
        F.lit(0.0).alias("dist"))
    reps = top.select(F.explode("_top").alias("_q"), *features)
    if sparse.isEmpty():
        return dense_nn
    cands = sparse.unionByName(reps)
    if cands.count() > cell_size * max_pivots:
        points = sparse.withColumn("_ask", F.lit(True)).unionByName(reps.withColumn("_ask", F.lit(False)))
        near = tree_knn(points, features, k, cell_size, seed=seed)
        return near.select(F.col("_q").alias(key), F.col("nn_rank").cast("int").alias("nn_rank"), F.col("_x").alias(f"nn_{key}"),
                           F.sqrt("_d2").alias("dist")).unionByName(dense_nn)
    return _pivot_knn(spark, sparse, cands, features, k, key, cell_size, max_pivots, seed).unionByName(dense_nn)


def _pivot_knn(spark, queries: DataFrame, cands: DataFrame, features: list[str], k: int, key: str,
               cell_size: int, max_pivots: int, seed: int) -> DataFrame:
    """kNN of ``queries`` among ``cands`` (queries ⊆ cands) by pivot cells."""
    n = cands.count()
    # pivots for cells of ``cell_size``; their table is collected and broadcast
    n_piv = min(max(1, math.ceil(n / cell_size)), max_pivots)
    piv = np.array([[r[c] for c in features] for r in sample_exact(cands, n_piv, seed, key="_q").collect()], dtype=float)
    piv_sq = (piv * piv).sum(axis=1)
    bc = spark.sparkContext.broadcast((piv, piv_sq))

    @F.pandas_udf("cell int, dp double")
    def assign(*cols: pd.Series) -> pd.DataFrame:
        p, ps = bc.value
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        cell = np.empty(len(X), dtype=np.int32)
        dp = np.empty(len(X))
        for s in range(0, len(X), 2048):
            D = _pivot_distances(X[s:s + 2048], p, ps)
            j = D.argmin(axis=1)
            cell[s:s + 2048] = j
            dp[s:s + 2048] = D[np.arange(len(j)), j]
        return pd.DataFrame({"cell": cell, "dp": dp})

    def topk(it):
        p, ps = bc.value
        best = np.full((len(p), k + 1), np.inf)
        for pdf in it:
            X = pdf[features].to_numpy(dtype=float)
            for s in range(0, len(X), 2048):
                D = _pivot_distances(X[s:s + 2048], p, ps).T  # pivots × rows
                both = np.concatenate([best, D], axis=1)
                kk = min(k + 1, both.shape[1])
                best = np.sort(np.partition(both, kk - 1, axis=1)[:, :kk], axis=1)
        rows = [(i, float(v)) for i in range(len(p)) for v in best[i] if np.isfinite(v)]
        yield pd.DataFrame(rows, columns=["cell", "d"])

    a = queries.withColumn("_a", assign(*[F.col(c) for c in features])) \
               .select("_q", *features, F.col("_a.cell").alias("_cell"), F.col("_a.dp").alias("_dp"))
    a = materialize(a, "knn-cells")
    radius = a.groupBy("_cell").agg(F.max("_dp").alias("R"))
    # per pivot: ≤ (k+1) values from each partition, merged (bounded by the partition count)
    near = cands.select(*features).mapInPandas(topk, "cell int, d double") \
                .groupBy("cell").agg(F.sort_array(F.collect_list("d")).alias("ds"))
    near = near.select(F.col("cell").alias("_cell"),
                       F.when(F.size("ds") > k, F.element_at("ds", k + 1)).alias("D"))
    # one row per pivot: a proven bound
    params = radius.join(near, "_cell", "left").select(
        "_cell", "R", F.coalesce(F.col("R") + F.col("D"), F.lit(float("inf"))).alias("theta")).toPandas()
    R = np.full(len(piv), -1.0)
    theta = np.full(len(piv), -1.0)
    R[params["_cell"].to_numpy()] = params["R"].to_numpy()
    theta[params["_cell"].to_numpy()] = params["theta"].to_numpy()
    reach = np.where(R >= 0, R + theta, -1.0)
    bc2 = spark.sparkContext.broadcast(reach)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def targets(*cols: pd.Series) -> pd.Series:
        p, ps = bc.value
        rc = bc2.value
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        out = []
        for s in range(0, len(X), 2048):
            D = _pivot_distances(X[s:s + 2048], p, ps)
            ok = D <= rc[None, :] * (1 + SLACK) + SLACK
            out.extend(np.flatnonzero(r).astype(np.int32).tolist() for r in ok)
        return pd.Series(out)

    th = spark.createDataFrame(pd.DataFrame({"_cell": np.arange(len(piv), dtype=np.int32), "_theta": theta}))
    asked = a.select(F.col("_cell").alias("cell"), "_q", *features).join(F.broadcast(th.withColumnsRenamed({"_cell": "cell", "_theta": "theta"})), "cell")
    met = cands.select(F.col("_q").alias("_x"), *features, F.explode(targets(*[F.col(c) for c in features])).alias("cell"))
    top = nearest_in_cells(asked, met, features, k)
    return top.select(F.col("_q").alias(key), F.col("nn_rank").cast("int").alias("nn_rank"),
                      F.col("_x").alias(f"nn_{key}"), F.sqrt("_d2").alias("dist"))


def smote(df: DataFrame, features: list[str], label: str = "Class", minority: int = 1, k: int = 5,
          seed: int = 42, key: str = "id") -> DataFrame:
    """Original rows ∪ synthetic minority rows until both classes are equal.

    Each minority point makes ⌊S/n⌋ synthetic rows, the first S mod n points
    in hash order one more (S = n_majority − n_minority, exact); each
    synthetic row takes a hashed choice among the point's k neighbours and a
    hashed gap u ∈ [0, 1): x + u·(neighbour − x). Synthetic keys are
    negative. Output: key, label, features, ``synthetic``.
    """
    base = df.select(key, label, *features)
    counts = {r[label]: r["n"] for r in base.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_min = counts.get(minority, 0)
    n_maj = sum(v for c, v in counts.items() if c != minority)
    out = base.withColumn("synthetic", F.lit(False))
    need = n_maj - n_min
    if need <= 0:
        return out
    # rows without all features have no neighbours and make no synthetic rows
    mino = complete_rows(base.where(F.col(label) == minority), features)
    n_src = mino.count()
    if n_src < 2:
        raise ValueError(f"over-sampling needs two complete rows of {label} = {minority}, found {n_src}")
    nn = materialize(knn_join(mino, features, k, key, seed=seed), "knn")  # read for the counts and for the pairs
    per, extra = divmod(need, n_src)
    ranked = stratum_positions(mino, None, seed, key)
    reps = F.lit(per) + F.when(F.col("_rank") < extra, 1).otherwise(0)
    kcount = nn.groupBy(key).agg(F.count(F.lit(1)).alias("_k"))
    syn = ranked.withColumn("_reps", reps).where(F.col("_reps") > 0).join(kcount, key)
    # replicas are made in two steps, chunks spread over all tasks and then
    # rows, so few minority rows don't make one long array in one task
    chunk = F.lit(REPLICA_CHUNK)
    syn = syn.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_reps") - 1) / chunk).cast("int"))))
    if per > REPLICA_CHUNK:
        syn = syn.repartition(key, "_chunk")
    syn = syn.withColumn("_rep", F.explode(F.sequence(F.col("_chunk") * chunk + 1, F.least(F.col("_reps").cast("int"), (F.col("_chunk") + 1) * chunk))))
    tag = F.concat(F.col(key).cast("string"), F.lit("-"), F.col("_rep").cast("string"))
    syn = syn.withColumn("_tag", tag)
    syn = syn.withColumn("nn_rank", (F.pmod(F.conv(F.substring(F.md5(F.concat("_tag", F.lit(f"-nn-{seed}"))), 1, 13), 16, 10).cast("long"), F.col("_k")) + 1).cast("int")) \
             .withColumn("_u", hash_uniform("_tag", seed))
    # neighbours with their features: k rows a minority row, joined by size
    nbr = mino.select(F.col(key).alias(f"nn_{key}"), *[F.col(c).alias(f"_n_{c}") for c in features])
    near = nn.select(key, "nn_rank", f"nn_{key}").join(nbr, f"nn_{key}").drop(f"nn_{key}")
    syn = join_small(syn, near, [key, "nn_rank"])
    new_key = -(F.col("_rank") * F.lit(per + 1) + F.col("_rep"))
    return out.unionByName(syn.select(
        new_key.cast(base.schema[key].dataType).alias(key), F.lit(minority).cast(base.schema[label].dataType).alias(label),
        *[(F.col(c) + F.col("_u") * (F.col(f"_n_{c}") - F.col(c))).alias(c) for c in features],
        F.lit(True).alias("synthetic")))
