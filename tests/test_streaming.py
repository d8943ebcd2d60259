"""Streaming: several files, availableNow, restart from checkpoint, replay."""

import os

from pyspark.sql import functions as F

from txnlens.operators.features import engineer_features, feature_columns, fit_feature_scaler
from txnlens.operators.forest import fit_isolation_forest
from txnlens.sources.tables import txn
from txnlens.streaming.scoring import ScoringModels, read_monitoring, score_batch, start_scoring, transaction_stream

from .conftest import SF001


def _models(spark):
    t = txn(spark, SF001)
    sc = fit_feature_scaler(t)
    f = engineer_features(t, sc, keep=["id"])
    return ScoringModels(sc, fit_isolation_forest(f, feature_columns(f), n_trees=20, max_samples=64))


def _write_parts(spark, root, n):
    t = txn(spark, SF001).withColumn("part", F.pmod(F.col("id"), F.lit(n)))
    src = os.path.join(root, "src")
    for k in range(n):
        t.where(F.col("part") == k).drop("part").coalesce(1).write.mode("overwrite").parquet(f"{src}/p{k}")
    return src


def test_files_to_batches_restart_and_replay(spark, tmp_root):
    models = _models(spark)
    src = _write_parts(spark, tmp_root, 3)
    schema = spark.read.parquet(f"{src}/p0").schema
    sink, ckpt = f"{tmp_root}/sink", f"{tmp_root}/ckpt"
    q = start_scoring(transaction_stream(spark, f"{src}/*", schema), models, sink, ckpt)
    q.awaitTermination()
    alerts, stats, cases = read_monitoring(spark, sink)
    s1 = sorted((r.batch_id, r.transactions_processed, r.total_processed) for r in stats.collect())
    assert [b for b, _, _ in s1] == [0, 1, 2]
    assert s1[-1][2] == txn(spark, SF001).count()
    n_alerts = alerts.count()
    assert n_alerts == cases.count() == sum(r.fraud_detected for r in stats.collect())
    # restart from the checkpoint: nothing new, nothing duplicated
    q = start_scoring(transaction_stream(spark, f"{src}/*", schema), models, sink, ckpt)
    q.awaitTermination()
    _, stats2, _ = read_monitoring(spark, sink)
    assert stats2.count() == 3
    # replay batch 1 by hand: tables unchanged
    batch1 = spark.read.parquet(f"{src}/p1")
    score_batch(models, sink)(batch1, 1)
    a3, s3, c3 = read_monitoring(spark, sink)
    assert a3.count() == n_alerts and s3.count() == 3 and c3.count() == n_alerts


def test_empty_batch_writes_nothing(spark, tmp_root):
    models = _models(spark)
    empty = txn(spark, SF001).limit(0)
    score_batch(models, f"{tmp_root}/sink")(empty, 0)
    assert not os.path.exists(f"{tmp_root}/sink")


def test_three_files_are_written_by_all_scan_tasks(spark, tmp_root, monkeypatch):
    """Each third is a folder of many files, and still one batch."""
    import glob

    from txnlens.plans import q_streaming

    from .conftest import SF001

    spark.read.parquet(f"{SF001}/events.parquet").repartition(6).write.parquet(f"{tmp_root}/sf/events.parquet")
    want = sorted(map(tuple, q_streaming.stream_three_files(spark, SF001).collect()))
    monkeypatch.setattr(q_streaming, "scratch_path", lambda *_: f"{tmp_root}/scratch")
    conf = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "8k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = sorted(map(tuple, q_streaming.stream_three_files(spark, f"{tmp_root}/sf").collect()))
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert got == want and [r[0] for r in got] == [0, 1, 2]
    assert len(glob.glob(f"{tmp_root}/scratch/in/*.parquet")) > 3
