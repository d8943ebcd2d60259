"""End-to-end jobs on the smallest tables: preprocess → train → score → monitor."""

import os

from pyspark.sql import functions as F

from txnlens.plans import jobs
from txnlens.sources.tables import txn_ml

from .conftest import SF001


def test_end_to_end(spark, tmp_root):
    t = txn_ml(spark, SF001).drop("vec_id")
    feats = jobs.preprocess(spark, t, tmp_root, balance=True)
    assert feats.count() == t.count()
    bal = spark.read.parquet(f"{tmp_root}/balanced")
    c = {r.Class: r["count"] for r in bal.groupBy("Class").count().collect()}
    assert c[0] == c[1]
    jobs.profile_reports(spark, t, tmp_root)
    ms = jobs.train(spark, tmp_root, n_trees=20, search_trials=4)
    assert ms.ensemble is not None
    comp = {r.model: r.auc for r in spark.read.parquet(f"{tmp_root}/reports/model_comparison").collect()}
    assert set(comp) == {"graph", "reconstruction", "isolation_forest", "ensemble"}
    src = f"{tmp_root}/stream"
    feats.drop("split").select("id", "Time", "Amount", "Class", *[f"V{i}" for i in range(1, 65)]) \
         .repartition(2).write.parquet(src)
    jobs.score_stream(spark, src, tmp_root, spark.read.parquet(src).schema)
    jobs.monitor_reports(spark, tmp_root)
    total = spark.read.parquet(f"{tmp_root}/reports/overall_rate").first()
    assert total.total_processed == t.count()
    assert os.path.isdir(f"{tmp_root}/reports/recent_alerts")
