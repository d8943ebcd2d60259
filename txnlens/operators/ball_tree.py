"""Exact k nearest neighbours over a tree of pivot balls.

The tree is built level by level. A node with more than ``cell_size`` points
takes up to about 1.5·``fanout`` of them as the centres of its children (a hash
sample by the node's own count, about two for each ``cell_size`` points, and its
points of least and largest hash), and every point goes to the nearest of them. A level is one join of the points with a row a node and a few
aggregates, so no node's points are gathered; distances are array expressions.

A node's radius R is the largest distance of its points to its centre. All k
neighbours of a point q of a leaf lie within theta of q, the least of

* 2R of any ball over q with more than k points, and
* R + D of its leaf, D the distance of the (k+1)-th point from the centre.

A candidate x descends from the root and enters a child only if
d(x, centre) <= R + the largest theta below it (triangle inequality), so each
leaf meets all candidates its points may need, and few others. A leaf keeps its
size, so the work a point grows with the levels and not with the square root of the
number of points (measured in README); a leaf's own points number
``cell_size`` at most. Nothing is collected to the driver: a level's centres are a
written table, which Spark broadcasts below its own threshold and joins by
node above it, when no node holds much of the data any more.

Points with more than k copies must have been reduced (see ``knn_join``), so
every node of more points than ``cell_size`` >= 2k + 2 has different points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import default_parallelism, materialize
from .cell_knn import SLACK, nearest_in_cells

ROOT = "0"


def _distance(features: list[str], c) -> Column:
    d2 = F.lit(0.0)
    for f in features:
        d2 = d2 + (F.col(f) - c[f]) * (F.col(f) - c[f])
    return F.sqrt(d2)


def _dealt(points: DataFrame) -> DataFrame:
    """Spread over all tasks: a few small files hold work for many of them."""
    return points.repartition(default_parallelism(points.sparkSession), "_q")


def _uniform(seed: int, level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("_q")), F.lit(2 ** 30)) / F.lit(2.0 ** 30)


def _centres(points: DataFrame, features: list[str], fanout: int, seed: int, level: int, cell_size: int) -> DataFrame:
    """(node, kids): the centres of the children of each node of ``points``
    (with ``n``, the node's count), named by the node's name and a number.
    A node just above ``cell_size`` gets a few: children of k points or fewer have
    no bound of their own, and their parent's radius sends them far candidates."""
    at, u = F.struct(*features), _uniform(seed, level)
    share = F.least(F.lit(1.5 * fanout) / F.col("n"), F.lit(2.0 / cell_size))
    some = points.withColumn("_u", u).groupBy("node").agg(
        F.collect_set(F.when(F.col("_u") < share, at)).alias("some"), F.min(F.struct("_u", *features)).alias("one"), F.max(F.struct("_u", *features)).alias("last"))
    ends = [F.struct(*[F.col(f"{e}.{f}").alias(f) for f in features]) for e in ("one", "last")]
    every = F.array_distinct(F.concat("some", F.array(*ends)))
    named = F.transform(F.array_sort(every), lambda c, i: F.struct(F.concat(F.col("node"), F.lit("."), i.cast("string")).alias("child"),
                                                                   *[c[f].alias(f) for f in features]))
    return some.select("node", named.alias("kids"))


def build(points: DataFrame, features: list[str], k: int, cell_size: int, fanout: int, seed: int):
    """Leaves' points (with node, dp), levels [(node, kids)] and all nodes'
    (node, parent, level, leaf, n, radius, near)."""
    level, now = 0, materialize(points.withColumns({"node": F.lit(ROOT), "parent": F.lit(""), "dp": F.lit(math.inf)}), "ball-points")
    leaves, levels, nodes = [], [], []
    while True:
        sizes = materialize(now.groupBy("node", "parent").agg(F.count(F.lit(1)).alias("n"), F.max("dp").alias("radius")), "ball-nodes")
        small = now.join(sizes.where(F.col("n") <= cell_size).select("node"), "node")
        leaves.append(small)
        # at most cell_size distances a leaf
        near = small.groupBy("node").agg(F.get(F.array_sort(F.collect_list("dp")), F.lit(k)).alias("near"))
        nodes.append(materialize(sizes.join(near, "node", "left").withColumns(
            {"level": F.lit(level), "leaf": F.col("n") <= cell_size}), "ball-level"))
        large = sizes.where(F.col("n") > cell_size).select("node", "n")
        if large.isEmpty():
            return leaves, levels, nodes
        rest = now.join(large, "node")
        kids = materialize(_centres(rest, features, fanout, seed, level, cell_size), "ball-centres")
        levels.append(kids)
        best = F.array_min(F.transform("kids", lambda c: F.struct(_distance(features, c).alias("dp"), c["child"].alias("child"))))
        now = _dealt(rest).join(kids, "node").withColumn("_b", best)
        now = materialize(now.select(*points.columns, F.col("_b.child").alias("node"), F.col("node").alias("parent"), F.col("_b.dp").alias("dp")), "ball-points")
        level += 1


def _reaches(nodes: list[DataFrame], k: int) -> tuple[DataFrame, list[DataFrame]]:
    """(node, theta) of the leaves, and per level (node, parent, leaf, reach)."""
    bounds, above = [], None
    for n in nodes:  # from the root: the least bound of any ball above
        own = F.when(F.col("n") > k, 2 * F.col("radius")).otherwise(F.lit(math.inf))
        if above is not None:
            n = n.join(above.select(F.col("node").alias("parent"), F.col("bound").alias("_above")), "parent")
            own = F.least(own, "_above")
        n = n.withColumn("bound", own)
        theta = F.least("bound", F.coalesce(F.when(F.col("n") > k, F.col("radius") + F.col("near")), F.lit(math.inf)))
        above = materialize(n.withColumn("theta", F.when(F.col("leaf"), theta)).select("node", "parent", "leaf", "radius", "bound", "theta"), "ball-bounds")
        bounds.append(above)
    reaches, below = [], None
    for b in reversed(bounds):  # to the root: the largest theta below
        if below is not None:
            b = b.join(below.groupBy("parent").agg(F.max("theta").alias("_below")).withColumnRenamed("parent", "node"), "node", "left")
            b = b.withColumn("theta", F.coalesce("theta", "_below")).drop("_below")
        below = materialize(b.select("node", "parent", "leaf", "theta", (F.col("radius") + F.col("theta")).alias("reach")), "ball-reach")
        reaches.insert(0, below)
    thetas = reaches[0]
    for r in reaches[1:]:
        thetas = thetas.unionByName(r)
    return thetas.where("leaf").select("node", "theta"), reaches


def _within(d: Column, bound: Column) -> Column:
    return d <= bound * (1 + SLACK) + SLACK


def tree_knn(points: DataFrame, features: list[str], k: int, cell_size: int = 1024, fanout: int = 32, seed: int = 42,
             work: dict | None = None) -> DataFrame:
    """(_q, _x, _d2, nn_rank): the k nearest other points of each point with
    ``_ask``, among all of ``points`` (_q, features, _ask); ties go to the lower
    key. ``work`` receives the number of distances computed."""
    cell_size = max(cell_size, 2 * k + 2)
    leaves, levels, nodes = build(points, features, k, cell_size, fanout, seed)
    thetas, reaches = _reaches(nodes, k)
    front = points.select(F.col("_q"), *features, F.lit(ROOT).alias("node"))
    ends = [] if levels else [front]
    probes = 0
    for kids, reach in zip(levels, reaches[1:]):
        each = kids.select("node", F.explode("kids").alias("c")).select("node", "c.*")
        limits = reach.select(F.col("node").alias("child"), "leaf", "reach")
        # a centre without points is left out
        kids = materialize(each.join(limits, "child").groupBy("node").agg(F.collect_list(F.struct("child", "leaf", "reach", *features)).alias("kids")), "ball-kids")
        hit = _dealt(front).join(kids, "node")
        near = F.filter("kids", lambda c: _within(_distance(features, c), c["reach"]))
        went = materialize(hit.select("_q", *features, F.explode(near).alias("c"))
                           .select("_q", *features, F.col("c.child").alias("node"), F.col("c.leaf").alias("leaf")), "ball-front")
        if work is not None:
            probes += hit.agg(F.sum(F.size("kids"))).first()[0] or 0
        ends.append(went.where("leaf").drop("leaf"))
        front = went.where(~F.col("leaf")).drop("leaf")
    asked = None
    for p in leaves:
        p = p.where("_ask").select("node", "_q", *features)
        asked = p if asked is None else asked.unionByName(p)
    met = None
    for e in ends:
        e = e.select(F.col("node").alias("cell"), F.col("_q").alias("_x"), *features)
        met = e if met is None else met.unionByName(e)
    asked = asked.join(thetas, "node").withColumnRenamed("node", "cell")
    if work is not None:
        work["distances"] = probes + asked.select("cell").join(met.select("cell"), "cell").count()
        work["levels"] = len(levels)
    return nearest_in_cells(asked, met, features, k)
