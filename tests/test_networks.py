"""The trained networks: gradients against finite differences, independence
of blocks and partitions, and that training learns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators import autoencoder as ae
from txnlens.operators import gradient as gr
from txnlens.operators import graph, metrics
from txnlens.operators import graph_network as gn
from txnlens.operators.reconstruct import reconstruction_score

N = 400


@pytest.fixture(scope="module")
def nodes(spark):
    """Two features; the class is that of a node's neighbourhood, not of the node alone."""
    rng = np.random.default_rng(3)
    time = np.sort(rng.uniform(0, 40_000, N))
    amount = rng.choice([10.0, 500.0, 900.0], N)
    x = rng.normal(size=(N, 2))
    near = np.array([x[(np.abs(time - t) < 3000) & (amount == a), 0].mean() for t, a in zip(time, amount)])
    rows = [(i, float(time[i]), float(amount[i]), float(x[i, 0]), float(x[i, 1]), int(near[i] > 0), "test" if i % 4 == 0 else "train") for i in range(N)]
    rows[5] = (5, None, 10.0, 1.0, None, 1, "train")
    rows[6] = (6, rows[6][1], None, float("nan"), 0.5, None, "train")
    rows[7] = (*rows[7][:5], rows[7][5], None)
    return spark.createDataFrame(rows, "id long, Time double, Amount double, V1 double, V2 double, Class int, split string").repartition(3).cache()


def network(hidden=4):
    net = gn.GraphNetwork(["V1", "V2"], hidden, mean=np.array([0.1, -0.2]), scale=np.array([1.5, 0.5]))
    net.flat = net.weights.start(1) + 0.05
    return net


def differences(value, flat, places, step=1e-6):
    out = []
    for i in places:
        a, b = flat.copy(), flat.copy()
        a[i], b[i] = a[i] + step, b[i] - step
        out.append((value(a) - value(b)) / (2 * step))
    return np.array(out)


def test_graph_gradient_equals_finite_differences(spark, nodes):
    net = network()
    blocks = [gn.Block(r, net) for r in gn.graph_blocks(nodes, net, "Class", "split", block=150).collect()]
    assert len(blocks) == 3 and sum(b.hi - b.lo for b in blocks) == N
    keep = [gr.dropout(np.random.default_rng(k), (b.n, 2), 0.3) for k, b in enumerate(blocks)]

    def loss(flat):
        return sum(gn.block_gradient(b, net, flat, k)[1] for b, k in zip(blocks, keep))
    g = sum(gn.block_gradient(b, net, net.flat, k)[0] for b, k in zip(blocks, keep))
    assert np.allclose(g, differences(loss, net.flat, range(len(g))), rtol=1e-4, atol=1e-5) and np.abs(g).max() > 0.1


def test_blocks_do_not_change_gradients_or_scores(spark, nodes):
    """A block's borders hold all that its own rows depend on."""
    net = network(6)
    whole = gn.epoch_sums(gn.graph_blocks(nodes, net, "Class", "split"), net, net.flat)
    cut = gn.epoch_sums(gn.graph_blocks(nodes, net, "Class", "split", block=76), net, net.flat)
    assert np.allclose(whole[0], cut[0], atol=1e-12) and np.isclose(whole[1], cut[1]) and np.isclose(whole[2], cut[2])
    one, many = ({r["id"]: r["graph_score"] for r in gn.score_graph_network(nodes, net, block=b).collect()} for b in (gn.BLOCK, 80))
    assert len(one) == N and one.keys() == many.keys() and np.allclose([one[i] for i in one], [many[i] for i in one], atol=1e-12)
    with pytest.raises(ValueError):
        gn.graph_blocks(nodes, net, block=75)


def test_spread_equals_joined_propagation(spark, nodes):
    """The band of coefficients is the propagation by joins."""
    net = gn.GraphNetwork(["V1", "V2"], 2, mean=np.zeros(2), scale=np.ones(2))
    full = nodes.na.fill(0.0, ["V1", "V2"]).na.drop(subset=["Time", "Amount"])
    n, e = graph.similarity_graph(full, ["V1", "V2"])
    want = {r["id"]: (r["V1"], r["V2"]) for r in graph.propagate(n, e, ["V1", "V2"], hops=1).collect()}
    b = gn.Block(gn.graph_blocks(full, net, None).collect()[0], net)
    got = b.spread(b.x)
    assert all(np.allclose(got[i], want[k]) for i, k in enumerate(b.ids.tolist())) and len(want) == N - 2


def test_training_learns_and_keeps_the_best_epoch(spark, nodes, tmp_root):
    net = gn.fit_graph_network(nodes, ["V1", "V2"], hidden=8, epochs=40, rate=0.03, seed=5, amount_window=100.0, time_window=3000.0)
    losses, aucs = zip(*net.history)
    assert min(losses[-5:]) < losses[0] * 0.9 and net.auc == max(aucs) > 0.8
    s = gn.score_graph_network(nodes, net).join(nodes, "id")
    assert metrics.roc_auc(s.where("split = 'test'"), "graph_score").first()[0] == pytest.approx(net.auc, abs=0.01)
    gn.save_graph_network(net, spark, f"{tmp_root}/net")
    again = gn.load_graph_network(spark, f"{tmp_root}/net")
    assert sorted(gn.score_graph_network(nodes, again).collect()) == sorted(s.select("id", "graph_score").collect())


def test_graph_without_labels_or_rows(spark, nodes):
    net = gn.fit_graph_network(nodes.where("false"), ["V1", "V2"], hidden=2, epochs=1)
    assert gn.score_graph_network(nodes.where("false"), net).count() == 0 and gn.score_graph_network(nodes, net).count() == N
    assert np.isnan(net.auc) and np.isnan(gn.binned_auc(np.array([1.0]), np.array([0.0])))


def test_epochs_take_the_first_product_and_one_forward_pass(spark, nodes, monkeypatch):
    """Blocks with Â x written give the sums of blocks with x, and an epoch
    runs each block once, validation included."""
    net = network(6)
    blocks = gn.graph_blocks(nodes, net, "Class", "split", block=150)
    given = gn.with_first(blocks, net)
    assert "x" not in given.columns
    a, b = (gn.epoch_sums(x, net, net.flat, 0.3, 5) for x in (blocks, given))
    assert np.allclose(a[0], b[0], atol=1e-12) and np.isclose(a[1], b[1]) and a[2] == b[2]
    passed, own = [], gn._forward
    monkeypatch.setattr(gn, "_forward", lambda *x: passed.append(1) or own(*x))
    monkeypatch.setattr(gn, "summed", lambda rows, sums, size: sums(rows.toPandas()))
    gn.epoch_sums(given, net, net.flat, 0.3, 5)
    assert len(passed) == given.count()


# ---- autoencoder

@pytest.fixture(scope="module")
def points(spark):
    """Points near a curve, and some far from it (class 1)."""
    rng = np.random.default_rng(9)
    t = rng.uniform(-1, 1, 1200)
    x = np.column_stack([t, t * t, np.sin(3 * t), -t]) + rng.normal(0, 0.02, (1200, 4))
    x[::40] = rng.normal(0, 1.5, (30, 4))
    rows = [(i, *map(float, r), int(i % 40 == 0)) for i, r in enumerate(x)] + [(5000, None, 1.0, 1.0, 1.0, 0), (5001, float("nan"), 1.0, 1.0, 1.0, 0)]
    return spark.createDataFrame(rows, "id long, V1 double, V2 double, V3 double, V4 double, Class int").cache()


COLS = ["V1", "V2", "V3", "V4"]


def test_autoencoder_gradient_equals_finite_differences():
    model, rng = ae.Autoencoder(COLS, (5, 2, 5)), np.random.default_rng(1)
    flat, z = model.weights.start(2) + 0.03, rng.normal(size=(30, 4))
    keep = gr.row_dropout(np.arange(30), 5, 7, 0.3)
    g, _ = ae.row_gradient(z, model, flat, keep)
    assert np.allclose(g, differences(lambda f: ae.row_gradient(z, model, f, keep)[1], flat, range(len(flat))), rtol=1e-4, atol=1e-6)


def test_row_dropout_is_by_row_and_of_the_share():
    keys = np.arange(2000) - 1000
    whole = gr.row_dropout(keys, 8, 3, 0.2)
    assert np.array_equal(whole[500:700], gr.row_dropout(keys[500:700], 8, 3, 0.2)) and abs((whole == 0).mean() - 0.2) < 0.02
    assert abs(whole.mean() - 1) < 0.03 and not np.array_equal(whole, gr.row_dropout(keys, 8, 4, 0.2))


def test_same_model_for_any_partitions_and_finds_outliers(spark, points, tmp_root):
    fit = lambda n: ae.fit_autoencoder(points.where("Class = 0").repartition(n), COLS, layers=(16, 2, 16), epochs=12, steps=3, rate=0.02, share=0.0)
    a, b = fit(1), fit(5)
    assert np.allclose(a.flat, b.flat, atol=1e-6) and a.threshold == pytest.approx(b.threshold, abs=1e-6)
    assert a.history[-1][0] < 0.5 * a.history[0][0]
    s = reconstruction_score(points, a)
    assert metrics.roc_auc(s, "reconstruction_score").first()[0] > 0.95
    odd = s.where("id >= 5000").collect()
    assert [r["reconstruction_score"] for r in odd] == [None, None]
    inside = s.where("Class = 0 AND id < 5000").agg(F.avg("reconstruction_pred")).first()[0]
    assert inside == pytest.approx(0.05, abs=0.002)
    ae.save_autoencoder(a, spark, f"{tmp_root}/m")
    again = reconstruction_score(points, ae.load_autoencoder(spark, f"{tmp_root}/m"))
    assert sorted(map(str, again.collect())) == sorted(map(str, s.collect()))


def test_rate_falls_and_fit_stops_without_gain(spark, points):
    m = ae.fit_autoencoder(points.where("id < 60"), COLS, layers=(4, 2, 4), epochs=30, steps=1, rate=0.0, patience=4, plateau=2)
    assert len(m.history) == 5 and [r for _, r in m.history] == [0.0] * 5
    assert ae.fit_autoencoder(points.where("false"), COLS, layers=(4, 2, 4), epochs=1, steps=1).flat is not None
