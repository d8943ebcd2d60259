"""Narrow rows are moved, features attached where they are used: the same
results, and nothing wide or by edge is written or kept on the way."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators import graph, graph_model, reconstruct
from txnlens.operators import graph_network as gn
from txnlens.operators.features import LateFeatures
from txnlens.plans import q_models

SCHEMA = "id long, vec long, Time double, Amount double, Class int, split string"


def rows(spark, n, more=()):
    rng = random.Random(3)
    out = [(i, i % 7, i * 500.0 * rng.random(), None if i % 13 == 5 else rng.random() * 220, None if i % 11 == 3 else i % 2, "test" if i % 5 == 0 else "train") for i in range(n)]
    return spark.createDataFrame(out + list(more), SCHEMA).repartition(4)


def late(spark):
    vec = spark.createDataFrame([(i, float(i * i % 5) - 1, None if i == 2 else 0.5 * i) for i in range(7)], "vec long, V1 double, V2 double")
    return LateFeatures(["vec", "Amount"], lambda d: d.join(F.broadcast(vec), "vec").withColumn("Amount_log", F.log1p("Amount")))


FEATURES = ["V1", "V2", "Amount_log"]


def table(df, *cols):
    plain = [[round(v, 8) if isinstance(v, float) else v for v in r] for r in df.select(*cols).collect()]
    return sorted(plain, key=str)


@pytest.mark.parametrize("repeats", [False, True])
def test_graph_features_of_late_features(spark, monkeypatch, repeats):
    """Equal to the joins over the edges; without repeated or NULL keys no edge is written."""
    d, f = rows(spark, 300, [(7, 3, 900.0, 5.0, 1, "train"), (None, 1, 900.0, 5.0, 1, "train")] if repeats else []), late(spark)
    monkeypatch.setattr(graph, "PLACE_BLOCK", 64)
    nodes, edges = graph.similarity_graph(f.add(d), FEATURES, label=None)
    want = graph.propagate(nodes, edges, FEATURES, hops=2).join(d.select("id", "Class", "split"), "id")
    seen, write = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name, **k: (seen.append(name), write(df, name, **k))[1])
    got = graph_model.graph_features(d, FEATURES, hops=2, keep=("Class", "split"), late=f)
    cols = ("id", "Class", "split", *FEATURES)
    assert table(got, *cols) == table(want, *cols) and got.count() >= 300
    assert ("edges" in seen) == repeats
    wide = graph_model.graph_features(f.add(d), FEATURES, hops=2)
    assert set(wide.columns) == {"id", *FEATURES} and table(wide, "id", *FEATURES) == table(want.drop("Class", "split") if not repeats else graph.propagate(nodes, edges, FEATURES, hops=2), "id", *FEATURES)


def test_spread_blocks_of_late_features(spark):
    """Blocks written once, without inputs, equal those written twice."""
    d, f = rows(spark, 400), late(spark)
    two, one = gn.GraphNetwork(FEATURES, 4), gn.GraphNetwork(FEATURES, 4)
    plain = gn.graph_blocks(f.add(d), two, "Class", "split", block=100)
    gn._standardise(two, gn._train_matrices(plain, two))
    want = {r["block"]: r for r in gn.with_first(plain, two).collect()}
    blocks = gn.graph_blocks(d, one, "Class", "split", block=100, late=f, spread=True)
    assert np.allclose(one.mean, two.mean) and np.allclose(one.scale, two.scale) and "x" not in blocks.columns
    got = {r["block"]: r for r in blocks.collect()}
    assert got.keys() == want.keys() and len(got) == 4
    for k, r in got.items():
        assert all(r[c] == want[k][c] for c in ("n", "lo", "hi", "ids", "t", "a", "y", "part")) or np.isnan(np.frombuffer(r["a"])).any()
        assert np.allclose(np.frombuffer(r["first"]), np.frombuffer(want[k]["first"]))
    a = gn.fit_graph_network(d, FEATURES, epochs=3, blocks=blocks, net=one)
    b = gn.fit_graph_network(f.add(d), FEATURES, hidden=4, epochs=3, blocks=plain)
    assert np.allclose(a.flat, b.flat) and a.auc == b.auc


def test_late_working_set_is_the_working_set(spark, tmp_root):
    """Also with vectors that come twice."""
    at, rng = datetime.datetime(2024, 1, 3), random.Random(1)
    events = [(i, at + datetime.timedelta(seconds=37 * i), i % 9, "error" if i % 4 else "view", rng.random() * 90, "{}") for i in range(120)]
    spark.createDataFrame(events + events[:5], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_root}/events.parquet")
    vec = [(i, [rng.random() for _ in range(3)], i % 2) for i in range(20)]
    spark.createDataFrame(vec + vec[4:7], "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_root}/embeddings.parquet")
    f, cols = q_models.features_with_split(spark, tmp_root)
    t, late_, own = q_models.late_features_with_split(spark, tmp_root)
    assert own == cols and len(t.columns) < 9 and table(late_.add(t), *f.columns) == table(f, *f.columns) and f.count() > 125


def test_reconstruction_keeps_no_wide_rows(spark, monkeypatch):
    kept, kind = [], type(spark.range(1))
    persist = kind.persist
    monkeypatch.setattr(kind, "persist", lambda self, *a: (kept.append(len(self.columns)), persist(self, *a))[1])
    d = spark.range(200).select(*[F.sin(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(6)])
    model = reconstruct.fit_reconstruction(d, d.columns, k=2)
    assert kept and max(kept) == 1 and model.threshold > 0
