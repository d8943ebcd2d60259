"""Quantile sketches: ranks within the bound, whatever the order of merging."""

import pytest
from pyspark.sql import functions as F

from txnlens.operators import sketches as sk

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_ranks_stay_within_the_bound_for_any_parts(spark):
    # a third of the rows are one value; NULL and NaN are left out
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") * 0.01).alias("x"), (F.col("id") % 7).alias("day"),
                                    (F.col("id") % 2).alias("half"))
    df = df.unionByName(spark.createDataFrame([(None, 0, 0), (float("nan"), 1, 1)], "x double, day long, half long"))
    for part in ("day", "half", None):
        q = sk.quantiles(sk.sketches(df, ["x"], part, size=200), PROBS)
        errors = sk.rank_errors(df, "x", q).collect()
        assert len(errors) == len(PROBS) and all(r["n"] == 30_000 for r in errors)
        assert max(r["error"] for r in errors) <= sk.rank_bound(200)
        ends = {r["q"]: r["value"] for r in errors}
        assert ends[0.0] == pytest.approx(0.01) and ends[1.0] == pytest.approx(299.99)  # exact


def test_batches_refresh_the_scaler_without_rereading(spark, tmp_root):
    first, second = spark.range(1000).select(F.col("id").cast("double").alias("x")), spark.range(1000, 3000).select(F.col("id").cast("double").alias("x"))
    sk.write_sketches(first, ["x"], f"{tmp_root}/s", 0)
    sk.write_sketches(second, ["x"], f"{tmp_root}/s", 1)
    sk.write_sketches(second, ["x"], f"{tmp_root}/s", 1)  # a replay
    parts = sk.read_sketches(spark, f"{tmp_root}/s")
    assert sk.merged(parts).first()["n"] == 3000
    median, spread = sk.robust_params(parts, ["x", "none"])["x"]
    assert abs(median - 1500) <= 3000 * sk.rank_bound() and abs(spread - 1500) <= 2 * 3000 * sk.rank_bound()
    assert sk.robust_params(parts, ["none"])["none"] == (None, None)


def test_no_values_leave_no_sketch(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert sk.sketches(df, ["x"]).count() == 0 and sk.quantiles(sk.sketches(df, ["x"]), [0.5]).count() == 0
