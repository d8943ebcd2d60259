"""Propagation by blocks of places equals propagation by joins."""

import math
import random

from txnlens.operators import graph

SCHEMA = "id long, Time double, Amount double, Hour double"


def rows(n, gap=700.0, copies=False):
    rng = random.Random(4)
    out = [(i, i * gap * rng.random(), None if i % 13 == 5 else rng.random() * 220, float(i % 24)) for i in range(n)]
    return out + (out[:9] + [(None, 5.0, 1.0, 2.0)] if copies else [])


def both(spark, data, hops, monkeypatch):
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    feats = ["Amount", "Hour"]
    monkeypatch.setattr(graph, "PLACE_BLOCK", 64)  # many blocks, borders and all
    nodes, edges = graph.similarity_graph(df, feats, label=None, places=True, band=5)
    by_place = graph.propagate(nodes, edges, feats, hops=hops, band=5)
    by_join = graph.propagate(nodes.drop("_i"), edges, feats, hops=hops)
    return [sorted([tuple(r) for r in h.select("id", *feats).collect()], key=str) for h in (by_place, by_join)]


def close(a, b):
    return len(a) == len(b) and all((x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9)) for r, s in zip(a, b) for x, y in zip(r, s))


def test_blocks_equal_joins(spark, monkeypatch):
    place, join = both(spark, rows(500), 3, monkeypatch)
    assert len(place) == 500 and close(place, join)


def test_blocks_move_no_edge_with_features(spark, monkeypatch):
    df = spark.createDataFrame(rows(200), SCHEMA)
    nodes, edges = graph.similarity_graph(df, ["Amount"], label=None, places=True)
    plan = graph.propagate(nodes, edges, ["Amount"], hops=3, band=19, checkpoint_each=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "_deg" not in plan


def test_repeated_and_null_keys_go_by_joins(spark, monkeypatch):
    place, join = both(spark, rows(120, copies=True), 2, monkeypatch)
    assert close(place, join)
