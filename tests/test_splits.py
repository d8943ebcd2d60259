"""Splits by hash order statistics, over-sampling edge cases, and running from
another folder."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from txnlens.operators import profile, resample, sampling
from txnlens.sources.tables import txn_ml

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_grouped_split_keeps_vectors_whole(spark):
    t = txn_ml(spark, "/root/testdata/sf0.1").select("id", "vec_id", "Class")
    s = sampling.grouped_split(t, "vec_id", 0.2).cache()
    assert s.groupBy("vec_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    n = {r["split"]: r["n"] for r in s.select("vec_id", "Class", "split").distinct().groupBy("split").count().withColumnRenamed("count", "n").collect()}
    assert abs(n["test"] - 0.2 * sum(n.values())) <= 2
    again = sampling.grouped_split(t.repartition(7, "id"), "vec_id", 0.2)
    assert s.join(again.withColumnRenamed("split", "other"), ["id", "vec_id"]).where("split <> other").count() == 0


def test_grouped_split_rejects_mixed_labels(spark):
    d = spark.createDataFrame([(1, 0), (1, 1)], "g int, Class int")
    with pytest.raises(ValueError):
        sampling.grouped_split(d, "g")


def test_null_labels_are_a_stratum(spark):
    d = spark.range(100).withColumn("Class", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).cast("int"))
    s = sampling.stratified_split(d, 0.2).groupBy("Class", "split").count().collect()
    assert sum(r["count"] for r in s) == 100 and {(r["Class"], r["split"]): r["count"] for r in s}[None, "test"] == 4
    assert sampling.stratified_folds(d, 3).count() == 100
    h = profile.histogram(d.withColumn("x", F.col("id").cast("double")), "x", 4, by="Class")
    assert h.agg(F.sum("n")).first()[0] == 100


def test_cut_goes_down_prefixes(spark, monkeypatch):
    monkeypatch.setattr(sampling, "HEX_STEP", 1)
    monkeypatch.setattr(sampling, "FETCH_ROWS", 2)
    d = spark.range(3000)
    got = {r["id"] for r in sampling.random_split(d, 0.3).where("split = 'test'").collect()}
    want = {r["id"] for r in sampling.sample_exact(d, 900).collect()}
    assert got == want


def test_histogram_skips_infinite_values(spark):
    d = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(d, "x", 2).orderBy("bin").collect()] == [(0, 1), (1, 1)]


def test_smote_with_incomplete_rows(spark):
    rows = [(i, 0, float(i), 1.0) for i in range(160)] + [(200 + i, 1, None if i < 10 else float(i), 2.0) for i in range(40)]
    out = resample.smote(spark.createDataFrame(rows, "id long, Class int, a double, b double"), ["a", "b"])
    n = {r["Class"]: r["count"] for r in out.groupBy("Class").count().collect()}
    assert n == {0: 160, 1: 160} and out.select("id").distinct().count() == 320


def test_smote_from_two_rows(spark):
    d = spark.range(60_000).select("id", (F.col("id") < 2).cast("int").alias("Class"), F.col("id").cast("double").alias("a"))
    out = resample.smote(d, ["a"])
    assert {r["Class"]: r["count"] for r in out.groupBy("Class").count().collect()} == {0: 59_998, 1: 59_998}
    with pytest.raises(ValueError):
        resample.smote(d.where("id <> 1"), ["a"])


def test_queries_run_from_another_folder(tmp_root):
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate(); "
            "print('ROWS', e.queries()['minority_knn'](s, '/root/testdata/sf0.001').count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_root, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
