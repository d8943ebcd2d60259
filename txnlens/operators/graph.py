"""Similarity graph and feature propagation as DataFrame joins.

Banded self-join (rows i < j <= i + band in (Time, id) order with
|ΔTime| < time_window and |ΔAmount| < amount_window, both strict): a range
condition alone plans a nested-loop join, so positions are cut into blocks
of band+1 rows; the left row is sent to its block and the next one, the
right row to its own block only, and the equi-join on the block finds every
pair exactly once. Every block key holds at most 2·(band+1) left and
band+1 right rows, so no key can be skewed whatever the data.

Propagation is the normalised graph convolution D^-1/2 (A + I) D^-1/2 X
(Kipf & Welling 2017; parameter-free hops as in Wu et al. 2019): per hop one
join of the edges with the node table and one aggregate by destination,
where the in-degree falls out of the same aggregate. Those joins move every
edge with its features once a hop. With the places of a banded graph's rows
there is no need to: all hops of a row depend on rows at most ``band * hops``
places away, so nodes and edges are dealt once to blocks of places, with that
border, and a block has the exact values of its own rows. Keys that repeat or
are NULL, and NaN features, go the way of the joins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .features import LateFeatures
from .position import row_parts, with_position

PLACE_BLOCK = 2048
PART_ROWS = 1 << 16  # of wide rows in a task
SIMILARITY_DEFAULTS = dict(band=19, time_window=3600.0, amount_window=100.0)


def banded_pairs(pos: DataFrame, key: str = "id", time_col: str = "Time", amount_col: str = "Amount", band: int = 19,
                 time_window: float = 3600.0, amount_window: float = 100.0, at: str = "_i") -> DataFrame:
    """(src, dst, i, j) of similar rows at most ``band`` places apart; ``at``
    holds the places."""
    size = band + 1
    blk = F.floor(F.col(at) / F.lit(size))
    left = pos.select(F.col(key).alias("src"), F.col(at).alias("i"),
                      F.col(time_col).alias("t_i"), F.col(amount_col).alias("a_i"),
                      F.explode(F.array(blk, blk + 1)).alias("blk"))
    right = pos.select(F.col(key).alias("dst"), F.col(at).alias("j"),
                       F.col(time_col).alias("t_j"), F.col(amount_col).alias("a_j"), blk.alias("blk"))
    pairs = left.join(right, "blk").where(
        (F.col("j") > F.col("i")) & (F.col("j") - F.col("i") <= band)
        & (F.abs(F.col("t_i") - F.col("t_j")) < time_window)
        & (F.abs(F.col("a_i") - F.col("a_j")) < amount_window))
    return pairs.select("src", "dst", "i", "j")


def banded_edges(df: DataFrame, order_by=("Time", "id"), key: str = "id", time_col: str = "Time",
                 amount_col: str = "Amount", band: int = 19, time_window: float = 3600.0,
                 amount_window: float = 100.0) -> DataFrame:
    """Forward edges (src, dst) between similar rows at most ``band`` apart."""
    pos = with_position(df.select(key, time_col, amount_col), list(order_by), "_i")
    return banded_pairs(pos, key, time_col, amount_col, band, time_window, amount_window).select("src", "dst")


def symmetric_edges(edges: DataFrame, nodes: DataFrame, key: str = "id", places: bool = False) -> DataFrame:
    """Forward ∪ reverse ∪ one self-loop per node (bag union); both directions
    come from one pass over the edges. With ``places`` also (i, j), the places
    of src and dst, from those of ``edges`` and the nodes' ``_i``."""
    side = ("src", "dst", *(("i", "j") if places else ()))
    back = dict(zip(side, ("dst", "src", "j", "i")))
    both = F.array(F.struct(*side), F.struct(*[F.col(back[c]).alias(c) for c in side]))
    loops = nodes.select(*[F.col("_i" if c in ("i", "j") else key).alias(c) for c in side])
    return edges.select(F.explode(both).alias("e")).select("e.*").unionAll(loops)


def similarity_graph(df: DataFrame, features: list[str], key: str = "id", label: str | None = "Class", places: bool = False,
                     order_by=("Time", "id"), **kw) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): nodes carry ``features`` (+ label), edges are symmetric
    with self-loops. ``places`` adds the nodes' ``_i`` and the edges' (i, j)."""
    own = [*features, *([label] if label else [])]
    if not places:
        nodes = df.select(key, *own)
        fwd = materialize(banded_edges(df, order_by, key=key, **kw), "edges")  # read by every hop
        return nodes, symmetric_edges(fwd, nodes, key)
    wanted = dict.fromkeys([key, *order_by, kw.get("time_col", "Time"), kw.get("amount_col", "Amount"), *own])
    pos = with_position(df.select(*wanted), list(order_by), "_i")
    fwd = materialize(banded_pairs(pos, key, **kw), "edges")
    nodes = pos.select(key, *own, "_i")
    return nodes, symmetric_edges(fwd, nodes, key, places=True)


def graph_size(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n_edges = edges.count()
    return nodes.agg(F.count(F.lit(1)).alias("n_nodes")).withColumn("n_edges", F.lit(n_edges).cast("long"))


def with_degree(nodes: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    deg = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("_deg"))
    return nodes.join(deg.withColumnRenamed("dst", key), key, "left") \
                .withColumn("_deg", F.coalesce(F.col("_deg"), F.lit(0)))


def one_row_a_key(nodes: DataFrame, features: list[str], key: str) -> bool:
    """Whether every key has one row, and no feature is NaN."""
    nan = F.lit(False)
    for c in features:
        nan = nan | F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(False))
    rows = nodes.select(F.col(key), nan.alias("_nan")).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max("_nan").alias("_nan"))
    return rows.where(F.col(key).isNull() | (F.col("_n") > 1) | F.col("_nan")).isEmpty()


def _block_values(x: np.ndarray, i: np.ndarray, j: np.ndarray, hops: int) -> np.ndarray:
    """Values of a block's rows (NaN: NULL) after ``hops`` rounds; (i, j) are its
    forward edges by row number, some with an end outside the block."""
    n = len(x)
    here, there = (i >= 0) & (i < n), (j >= 0) & (j < n)
    degree = 1.0 + np.bincount(i[here], minlength=n) + np.bincount(j[there], minlength=n)
    inside = here & there
    i, j = i[inside], j[inside]
    order = np.argsort(j - i, kind="stable")
    i, j = i[order], j[order]
    # of one offset a row occurs once in each of the two arrays
    pairs = list(zip(*(np.split(v, np.flatnonzero(np.diff(j - i)) + 1) for v in (i, j)))) if len(i) else []
    return _spread(x, degree, pairs, hops)


def _spread(x: np.ndarray, degree: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], hops: int) -> np.ndarray:
    """``hops`` rounds over the forward edges ``pairs``, row numbers of one offset each."""
    def summed(h):
        out = h.copy()
        for a, b in pairs:
            out[a] += h[b]
            out[b] += h[a]
        return out
    scale = (1.0 / np.sqrt(degree))[:, None]
    known = (~np.isnan(x)).astype(float)
    whole = bool(known.all())
    x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
    for _ in range(hops):
        x = summed(x * scale) * scale
        if not whole:
            known = (summed(known) > 0).astype(float)
    return x if whole else np.where(known > 0, x, np.nan)


def _propagate_by_place(nodes: DataFrame, edges: DataFrame, features: list[str], hops: int, key: str, band: int) -> DataFrame:
    reach = band * hops
    size = max(PLACE_BLOCK, 4 * reach)

    def blocks(lo, hi):
        first = F.greatest(F.lit(0).cast("long"), F.floor((lo - reach) / F.lit(size)))
        return F.explode(F.sequence(first, F.floor((hi + reach) / F.lit(size)))).alias("_block")
    at = nodes.select(key, "_i", *[F.col(c).cast("double").alias(c) for c in features], blocks(F.col("_i"), F.col("_i")))
    forward = edges.where("i < j").select("i", (F.col("j") - F.col("i")).cast("int").alias("o"), blocks(F.col("i"), F.col("j")))

    def values(n: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        if not len(n):
            return pd.DataFrame({c: [] for c in (key, *features)})
        n = n.sort_values("_i")
        place = n["_i"].to_numpy(np.int64)
        i = e["i"].to_numpy(np.int64) - place[0]
        out = _block_values(n[features].to_numpy(dtype=float), i, i + e["o"].to_numpy(np.int64), hops)
        mine = place // size == n["_block"].iloc[0]
        return pd.DataFrame({key: n[key].to_numpy()[mine], **{c: out[mine, f] for f, c in enumerate(features)}})
    schema = T.StructType([nodes.schema[key], *[T.StructField(c, T.DoubleType()) for c in features]])
    return at.groupBy("_block").cogroup(forward.groupBy("_block")).applyInPandas(values, schema)


def propagate_rows(df: DataFrame, features: list[str], hops: int, key: str = "id", keep: tuple[str, ...] = (), late: LateFeatures | None = None,
                   order_by=("Time", "id"), time_col: str = "Time", amount_col: str = "Amount", band: int = 19, time_window: float = 3600.0,
                   amount_window: float = 100.0) -> DataFrame:
    """(key, ``keep``, propagated features) of the rows of ``df`` over their
    banded graph, written once. The rows are dealt to blocks of places with a
    border of ``band * (hops + 1)``, the degrees' band included, and a block
    finds its edges itself, so no edge is written or moved; of ``late``
    features only what they need is, and they are attached in the blocks.
    For tables of one row a key; the others go by ``propagate``."""
    reach = band * (hops + 1)
    size = max(PLACE_BLOCK, 4 * reach)
    moved = dict.fromkeys([key, *order_by, time_col, amount_col, *keep, *(late.needs if late else features)])
    rows = with_position(df.select(*moved), list(order_by), "_i")
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col("_i") - reach) / F.lit(size)))
    rows = rows.withColumn("_block", F.explode(F.sequence(first, F.floor((F.col("_i") + reach) / F.lit(size)))))
    rows = rows.repartition(row_parts(df, PART_ROWS), "_block")  # a number, as the narrow rows' bytes say little of the wide ones'
    rows = late.add(rows) if late else rows
    own = [*dict.fromkeys([key, *keep])]
    rows = rows.select("_block", "_i", F.col(time_col).cast("double").alias("_t"), F.col(amount_col).cast("double").alias("_a"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(own)],
                       *[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)])
    inputs = [f"_f{i}" for i in range(len(features))]

    def values(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_i")
        t, a, n = (*(g[c].to_numpy(dtype=float, na_value=np.nan) for c in ("_t", "_a")), len(g))
        degree, pairs = np.ones(n), []
        for o in range(1, min(band, n - 1) + 1):
            i = np.flatnonzero((np.abs(t[o:] - t[:-o]) < time_window) & (np.abs(a[o:] - a[:-o]) < amount_window))  # NaN: no edge
            degree[i] += 1
            degree[i + o] += 1
            pairs.append((i, i + o))
        x = _spread(g[inputs].to_numpy(dtype=float, na_value=np.nan), degree, pairs, hops)
        mine = g["_i"].to_numpy(np.int64) // size == g["_block"].iloc[0]
        kept = {c: g[f"_k{i}"].to_numpy()[mine] for i, c in enumerate(own)}
        return pd.DataFrame({**kept, **{c: x[mine, f] for f, c in enumerate(features)}})
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in own], *[T.StructField(c, T.DoubleType()) for c in features]])
    return materialize(rows.groupBy("_block").applyInPandas(values, schema), "hop")


def propagate(nodes: DataFrame, edges: DataFrame, features: list[str], hops: int = 1,
              key: str = "id", checkpoint_each: bool = True, band: int | None = None) -> DataFrame:
    """``hops`` rounds of h ← D^-1/2 (A+I) D^-1/2 h over symmetric edges with
    self-loops. Returns (key, features…) with propagated values; the lineage
    is cut after each hop so iterations stay cheap to recover. With ``band``,
    of a graph with places, the hops are done in blocks of places, where keys
    allow it."""
    if band is not None and hops > 0 and one_row_a_key(nodes, features, key):
        h = _propagate_by_place(nodes, edges, features, hops, key, band)
        return materialize(h, "hop") if checkpoint_each else h
    edges = edges.select("src", "dst")
    h = with_degree(nodes.select(key, *features), edges, key)
    for _ in range(hops):
        msg = edges.join(h.withColumnRenamed(key, "src"), "src")
        scale = F.lit(1.0) / F.sqrt(F.col("_deg").cast("double"))
        agg = msg.groupBy("dst").agg(F.count(F.lit(1)).alias("_deg"),
                                     *[F.sum(F.col(c) * scale).alias(c) for c in features])
        h = agg.select(F.col("dst").alias(key), "_deg",
                       *[(F.col(c) / F.sqrt(F.col("_deg").cast("double"))).alias(c) for c in features])
        if checkpoint_each:
            h = materialize(h, "hop")
    return h.drop("_deg")


def mean_pool(df: DataFrame, group: str, features: list[str]) -> DataFrame:
    """Mean of node vectors per graph."""
    return df.groupBy(group).agg(*[F.avg(c).alias(f"mean_{c}") for c in features])


def log_loss(df: DataFrame, prob: str = "probability", label: str = "Class") -> DataFrame:
    """Mean binary cross-entropy; each log is floored at −100."""
    p, y = F.col(prob).cast("double"), F.col(label).cast("double")
    lp = F.greatest(F.log(p), F.lit(-100.0))
    lq = F.greatest(F.log(F.lit(1.0) - p), F.lit(-100.0))
    return df.agg(F.avg(-(y * lp + (F.lit(1.0) - y) * lq)).alias("log_loss"))
