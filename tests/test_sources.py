"""Sources and sinks: CSV, missing logs, nested documents, persistence."""

import numpy as np
from pyspark.sql import functions as F

from txnlens.operators import forest, reconstruct
from txnlens.schemas import ALERTS
from txnlens.sources import files

from .conftest import SF001


def test_csv_transactions(spark, tmp_root):
    path = f"{tmp_root}/tx.csv"
    with open(path, "w") as fh:
        fh.write("Time,V1,V2,Amount,Class\n0,0.5,-1,10.5,0\n3600,1.5,2,0,1\n")
    df = files.read_transactions_csv(spark, path)
    rows = df.orderBy("Time").collect()
    assert [r.Amount for r in rows] == [10.5, 0.0] and rows[1].Class == 1 and "id" in df.columns


def test_csv_columns_by_name_and_nan(spark, tmp_root):
    path = f"{tmp_root}/tx.csv"
    with open(path, "w") as fh:
        fh.write("id,Time,V2,V1,Class,Amount,V10,note\n7,1.5,NaN,0.25,1,NaN,3,x\n8,2.5,2,,0,4.5,1,y\n")
    a, b = files.read_transactions_csv(spark, path).orderBy("id").collect()
    assert (a.id, a.Time, a.V1, a.V2, a.V10, a.Class, a.Amount, a.note) == (7, 1.5, 0.25, None, 3.0, 1, None, "x")
    assert (b.id, b.V1, b.V2, b.Amount) == (8, None, 2.0, 4.5)


def test_alert_documents_are_bounded(spark, tmp_root):
    cases = spark.range(100).select(F.col("id").cast("double").alias("Time"), F.lit(1.0).alias("Amount"), F.lit(-0.1).alias("anomaly_score"))
    files.write_alert_document(cases, 3, tmp_root, 1.0, chunk=10)
    docs = spark.read.option("multiLine", True).json(f"{tmp_root}/fraud_alerts_batch_3.json")
    assert docs.agg(F.sum("fraud_count"), F.max(F.size("cases"))).first()[0] == 100 and docs.count() > 8
    assert files.read_batch_alerts(spark, tmp_root).count() == 100
    files.write_alert_document(cases.where("false"), 4, tmp_root, 1.0)
    assert files.read_batch_alerts(spark, tmp_root).count() == 100


def test_missing_logs_are_empty(spark, tmp_root):
    assert files.read_alerts(spark, f"{tmp_root}/nope").count() == 0
    assert files.read_batch_alerts(spark, f"{tmp_root}/nope").count() == 0
    assert files.read_json_log(spark, f"{tmp_root}/x.jsonl", ALERTS).columns == ALERTS.fieldNames()


def test_batch_document_missing_cases(spark, tmp_root):
    with open(f"{tmp_root}/fraud_alerts_batch_0.json", "w") as fh:
        fh.write('{"batch_id": 0, "timestamp": 1.5, "fraud_count": 2, "cases": '
                 '[{"Time": 1.0, "Amount": 2.0, "anomaly_score": -0.1}, {"Time": 3.0, "Amount": 4.0, "anomaly_score": -0.2}]}')
    with open(f"{tmp_root}/fraud_alerts_batch_1.json", "w") as fh:
        fh.write('{"batch_id": 1, "timestamp": 2.5, "fraud_count": 0}')
    cases = files.read_batch_alerts(spark, tmp_root)
    assert sorted(r.Amount for r in cases.collect()) == [2.0, 4.0]


def test_model_persistence_roundtrip(spark, tmp_root):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, *map(float, rng.normal(size=3))) for i in range(500)], "id long, a double, b double, c double")
    m = forest.fit_isolation_forest(df, ["a", "b", "c"], n_trees=10, max_samples=64)
    forest.save_forest(m, spark, f"{tmp_root}/forest")
    m2 = forest.load_forest(spark, f"{tmp_root}/forest")
    a = forest.score_isolation_forest(df, m).agg(F.sum("iso_score")).first()[0]
    b = forest.score_isolation_forest(df, m2).agg(F.sum("iso_score")).first()[0]
    assert abs(a - b) < 1e-9
    r = reconstruct.fit_reconstruction(df, ["a", "b", "c"], k=2)
    reconstruct.save_reconstruction(r, spark, f"{tmp_root}/recon")
    r2 = reconstruct.load_reconstruction(spark, f"{tmp_root}/recon")
    assert r2.threshold == r.threshold and np.allclose(r2.components, r.components)
