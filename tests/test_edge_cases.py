"""Hand-made cases (FIXTURES §3)."""

import math

import pytest
from pyspark.sql import functions as F

from txnlens.operators import graph, metrics, monitor, position, profile, scaling
from txnlens.operators.quantiles import exact_quantiles


def test_edge_thresholds_are_strict(spark):
    # pairs (0,1): dT 3599 kept; (1,2): dT 3600 dropped; amounts likewise
    rows = [(0, 0.0, 10.0), (1, 3599.0, 10.0), (2, 7199.0, 10.0),
            (3, 7200.0, 109.99), (4, 7201.0, 209.99)]
    df = spark.createDataFrame(rows, "id long, Time double, Amount double")
    e = {(r.src, r.dst) for r in graph.banded_edges(df).collect()}
    assert (0, 1) in e          # ΔTime 3599
    assert (1, 2) not in e      # ΔTime 3600
    assert (2, 3) in e          # ΔAmount 99.99
    assert (3, 4) not in e      # ΔAmount 100


def test_band_offset_19_kept_20_dropped(spark):
    rows = [(i, float(i), 1.0) for i in range(45)]
    df = spark.createDataFrame(rows, "id long, Time double, Amount double")
    e = {(r.src, r.dst) for r in graph.banded_edges(df).collect()}
    assert (0, 19) in e and (0, 20) not in e
    assert (21, 40) in e and (21, 41) not in e
    # every pair within the band exactly once
    assert len(e) == sum(min(19, 44 - i) for i in range(45))
    assert graph.banded_edges(df).count() == len(e)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "x double")
    h = {r.bin: r.n for r in profile.histogram(df, "x", 5).collect()}
    assert h[4] == 1 and sum(h.values()) == 5


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    h = profile.histogram(df, "x", 50).collect()
    assert len(h) == 1 and h[0].bin == 25 and h[0].n == 4


def test_constant_column_scalers(spark):
    df = spark.createDataFrame([(5.0,)] * 6, "x double")
    r = scaling.apply_scaler(df, scaling.fit_robust(df, ["x"]), ["x"]).agg(F.max("x_scaled")).first()[0]
    s = scaling.apply_scaler(df, scaling.fit_standard(df, ["x"]), ["x"]).agg(F.max("x_scaled")).first()[0]
    m = scaling.minmax(df, ["x"]).agg(F.max("x_norm")).first()[0]
    assert r == 0.0 and s == 0.0 and m == 0.0


def test_auc_ties_and_single_class(spark):
    tied = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 0), (1.0, 1)], "s double, Class int")
    assert metrics.roc_auc(tied, "s").first().auc == 0.5
    one = spark.createDataFrame([(0.3, 0), (0.9, 0)], "s double, Class int")
    assert metrics.roc_auc(one, "s").first().auc is None


def test_auc_negation(spark):
    rows = [(float(i % 7), i % 3 == 0) for i in range(60)]
    df = spark.createDataFrame([(s, int(c)) for s, c in rows], "s double, Class int")
    a = metrics.roc_auc(df, "s").first().auc
    b = metrics.roc_auc(df, "s", negate=True).first().auc
    assert math.isclose(a + b, 1.0, rel_tol=1e-12)


def test_report_without_predicted_positives(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "Class int, prediction int")
    rep = {r.metric: r for r in metrics.classification_report(df).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["1"].f1_score == 0.0
    assert math.isclose(rep["accuracy"].f1_score, 2 / 3)


def test_short_last_batch(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(250)], "id long, Time double")
    sizes = sorted(r["count"] for r in position.row_batches(df, 100).groupBy("batch_id").count().collect())
    assert sizes == [50, 100, 100]
    capped = position.row_batches(df, 100, max_batches=2)
    assert capped.count() == 200


def test_no_batches_overall_rate_zero(spark):
    empty = spark.createDataFrame([], "batch_id long, transactions_processed long, fraud_detected long")
    r = monitor.overall_rate(empty).first()
    assert r.total_processed == 0 and r.overall_rate == 0.0


def test_nan_is_null(spark):
    from txnlens.functions.columns import nan_to_null

    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = df.select(nan_to_null("x").alias("x")).agg(F.avg("x"), F.count("x")).first()
    assert r[0] == 2.0 and r[1] == 2
    assert exact_quantiles(df, "x", [0.5]) == [2.0]


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_positions_independent_of_partitions(spark, parts):
    df = spark.createDataFrame([(i, float(i % 13), float(i)) for i in range(300)], "id long, Time double, Amount double")
    p = position.with_position(df, ["Time", "id"], num_partitions=parts)
    got = [r.id for r in p.orderBy("pos").collect()]
    want = [r.id for r in df.orderBy("Time", "id").collect()]
    assert got == want
    assert [r.pos for r in p.orderBy("pos").collect()] == list(range(300))
