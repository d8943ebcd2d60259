"""Graph queries: banded similarity edges, symmetric graph, size,
one-hop normalised propagation, mean pooling, log loss."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hour_of_day, rounded, sigmoid
from ..operators import graph, position
from ..sources.tables import txn, txn_ml, with_views
from .catalog import R, register

BAND = graph.SIMILARITY_DEFAULTS["band"]
EDGES_SQL = """pos AS (SELECT id, Time, Amount, ((Time / 3600.0) % 24.0) AS Hour,
                      row_number() OVER (ORDER BY Time, id) - 1 AS i FROM txn),
fwd AS (SELECT a.id AS src, b.id AS dst FROM pos a JOIN pos b
        ON b.i BETWEEN a.i + 1 AND a.i + 19
       AND abs(a.Time - b.Time) < 3600 AND abs(a.Amount - b.Amount) < 100),
sym AS (SELECT src, dst FROM fwd UNION ALL SELECT dst, src FROM fwd UNION ALL SELECT id, id FROM pos)"""


def _sql(body: str) -> str:
    return with_views(f"WITH {EDGES_SQL} {body}")


@register("band_edges", "W1 J1", _sql("SELECT src, dst FROM fwd"))
def band_edges(spark, sf):
    return graph.banded_edges(txn(spark, sf))


@register("graph_edges", "J2 U1", _sql("SELECT src, dst FROM sym"))
def graph_edges(spark, sf):
    t = txn(spark, sf)
    _, e = graph.similarity_graph(t, ["Amount"])
    return e


@register("graph_size", "A16", _sql("""
SELECT (SELECT count(*) FROM pos) AS n_nodes, (SELECT count(*) FROM sym) AS n_edges"""))
def graph_size(spark, sf):
    n, e = graph.similarity_graph(txn(spark, sf), ["Amount"])
    return graph.graph_size(n, e)


PROP_SQL = """deg AS (SELECT dst AS id, count(*) AS d FROM sym GROUP BY dst),
h AS (SELECT s.dst AS id, sum(p.Amount / sqrt(dg.d)) / sqrt(dd.d) AS Amount_h,
             sum(p.Hour / sqrt(dg.d)) / sqrt(dd.d) AS Hour_h
      FROM sym s JOIN pos p ON p.id = s.src JOIN deg dg ON dg.id = s.src JOIN deg dd ON dd.id = s.dst
      GROUP BY s.dst, dd.d)"""


def _propagated(spark, sf):
    t = txn(spark, sf).withColumn("Hour", hour_of_day("Time"))
    nodes, edges = graph.similarity_graph(t, ["Amount", "Hour"], places=True)
    h = graph.propagate(nodes, edges, ["Amount", "Hour"], hops=1, band=BAND)
    return t, h.select("id", F.col("Amount").alias("Amount_h"), F.col("Hour").alias("Hour_h"))


@register("graph_propagation", "J3", _sql(f""", {PROP_SQL}
SELECT id, {R('Amount_h')} AS Amount_h, {R('Hour_h')} AS Hour_h FROM h"""))
def graph_propagation(spark, sf):
    _, h = _propagated(spark, sf)
    return h.select("id", rounded("Amount_h").alias("Amount_h"), rounded("Hour_h").alias("Hour_h"))


_HOP = """h{i} AS (SELECT s.dst AS id, sum(p.Amount / sqrt(dg.d)) / sqrt(any_value(dd.d)) AS Amount, sum(p.Hour / sqrt(dg.d)) / sqrt(any_value(dd.d)) AS Hour
      FROM sym s JOIN {src} p ON p.id = s.src JOIN deg dg ON dg.id = s.src JOIN deg dd ON dd.id = s.dst GROUP BY s.dst)"""


@register("graph_propagation_3hops", "J3 M3", _sql(", deg AS (SELECT dst AS id, count(*) AS d FROM sym GROUP BY dst), " + ", ".join(
    _HOP.format(i=i, src="pos" if i == 1 else f"h{i - 1}") for i in (1, 2, 3)) + f"""
SELECT id, {R('Amount', 5)} AS Amount_h, {R('Hour', 5)} AS Hour_h FROM h3"""))
def graph_propagation_3hops(spark, sf):
    t = txn(spark, sf).withColumn("Hour", hour_of_day("Time"))
    nodes, edges = graph.similarity_graph(t, ["Amount", "Hour"], places=True)
    h = graph.propagate(nodes, edges, ["Amount", "Hour"], hops=3, band=BAND)
    return h.select("id", rounded("Amount", 5).alias("Amount_h"), rounded("Hour", 5).alias("Hour_h"))


@register("graph_mean_pool", "A15", _sql(f""", {PROP_SQL}
SELECT CAST(floor(p.i / 100) AS BIGINT) AS batch_id, {R('avg(Amount_h)', 4)} AS mean_Amount_h,
       {R('avg(Hour_h)', 4)} AS mean_Hour_h
FROM h JOIN pos p USING (id) GROUP BY 1"""))
def graph_mean_pool(spark, sf):
    t, h = _propagated(spark, sf)
    b = position.row_batches(t.select("id", "Time"), 100)
    pooled = graph.mean_pool(h.join(b, "id"), "batch_id", ["Amount_h", "Hour_h"])
    return pooled.select("batch_id", *[rounded(c, 4).alias(c) for c in ("mean_Amount_h", "mean_Hour_h")])


@register("graph_log_loss", "A17", with_views(f"""
SELECT {R('avg(-(Class * greatest(ln(p), -100) + (1 - Class) * greatest(ln(1 - p), -100)))')} AS log_loss
FROM (SELECT Class, 1.0 / (1.0 + exp(-V1)) AS p FROM txn_ml) q""", ml=True))
def graph_log_loss(spark, sf):
    d = txn_ml(spark, sf).select("Class", sigmoid("V1").alias("probability"))
    return graph.log_loss(d).select(rounded("log_loss").alias("log_loss"))
