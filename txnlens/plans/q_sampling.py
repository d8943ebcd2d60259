"""Sampling, split and fold queries."""

from __future__ import annotations

from ..operators import sampling
from ..sources.tables import txn, with_views
from .catalog import register

HASH = "md5(CAST(id AS VARCHAR) || '-42')"


@register("sample_rows", "R1", with_views(f"""
SELECT id, Time, Amount, Class FROM txn ORDER BY {HASH}, id LIMIT 1000"""))
def sample_rows(spark, sf):
    return sampling.sample_exact(txn(spark, sf), 1000, seed=42).select("id", "Time", "Amount", "Class")


def _split_sql(frac: float, strat: bool) -> str:
    part = "PARTITION BY Class " if strat else ""
    return with_views(f"""
SELECT id, Class, CASE WHEN rn < round({frac} * cnt) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT id, Class, row_number() OVER ({part}ORDER BY {HASH}, id) - 1 AS rn,
         count(*) OVER ({part.strip()}) AS cnt FROM txn) q""")


@register("stratified_split", "R2", _split_sql(0.2, True))
def stratified_split(spark, sf):
    return sampling.stratified_split(txn(spark, sf), 0.2).select("id", "Class", "split")


@register("stratified_split_70_30", "R2", _split_sql(0.3, True))
def stratified_split_70_30(spark, sf):
    return sampling.stratified_split(txn(spark, sf), 0.3).select("id", "Class", "split")


@register("random_split", "R3", _split_sql(0.2, False))
def random_split(spark, sf):
    return sampling.random_split(txn(spark, sf), 0.2).select("id", "Class", "split")


@register("stratified_folds", "R5", with_views(f"""
SELECT id, Class, CAST((row_number() OVER (PARTITION BY Class ORDER BY {HASH}, id) - 1) % 3 AS INTEGER) AS fold
FROM txn"""))
def stratified_folds(spark, sf):
    return sampling.stratified_folds(txn(spark, sf), 3).select("id", "Class", "fold")


# -- R4: minority kNN (exact) and SMOTE -----------------------------------------

def _minority(spark, sf):
    from pyspark.sql import functions as F

    from ..functions.columns import hour_of_day

    t = txn(spark, sf).withColumn("Hour", hour_of_day("Time"))
    return t, t.where(F.col("Class") == 1)


KNN_SQL = with_views("""
WITH m AS (SELECT id, Amount, (Time / 3600.0) % 24.0 AS Hour FROM txn WHERE Class = 1),
p AS (SELECT a.id, b.id AS nn_id,
             (a.Amount - b.Amount) * (a.Amount - b.Amount) + (a.Hour - b.Hour) * (a.Hour - b.Hour) AS d2
      FROM m a JOIN m b ON a.id <> b.id),
r AS (SELECT id, nn_id, d2, row_number() OVER (PARTITION BY id ORDER BY d2, nn_id) AS nn_rank FROM p)
SELECT id, CAST(nn_rank AS INTEGER) AS nn_rank, nn_id, round(sqrt(d2), 6) + 0.0 AS dist FROM r WHERE nn_rank <= 5""")


@register("minority_knn", "R4", KNN_SQL)
def minority_knn(spark, sf):
    from ..functions.columns import rounded
    from ..operators.resample import knn_join

    _, m = _minority(spark, sf)
    nn = knn_join(m, ["Amount", "Hour"], k=5, key="id", cell_size=256)
    return nn.select("id", "nn_rank", "nn_id", rounded("dist").alias("dist"))


@register("minority_knn_tree", "R4", KNN_SQL)
def minority_knn_tree(spark, sf):
    """The same neighbours by the tree of balls (no more than 8 flat cells)."""
    from ..functions.columns import rounded
    from ..operators.resample import knn_join

    _, m = _minority(spark, sf)
    nn = knn_join(m, ["Amount", "Hour"], k=5, key="id", cell_size=32, max_pivots=8)
    return nn.select("id", "nn_rank", "nn_id", rounded("dist").alias("dist"))


@register("smote_balanced", "R4 U3", with_views(f"""
WITH a AS (SELECT id, Class, Amount, (Time / 3600.0) % 24.0 AS Hour FROM txn), m AS (SELECT * FROM a WHERE Class = 1),
p AS (SELECT x.id, y.id AS nn_id, y.Amount AS na, y.Hour AS nh, row_number() OVER (PARTITION BY x.id ORDER BY
        (x.Amount - y.Amount) * (x.Amount - y.Amount) + (x.Hour - y.Hour) * (x.Hour - y.Hour), y.id) AS nn_rank
      FROM m x JOIN m y ON x.id <> y.id QUALIFY nn_rank <= 5),
k AS (SELECT id, count(*) AS k FROM p GROUP BY id),
c AS (SELECT count(*) FILTER (Class <> 1) - count(*) FILTER (Class = 1) AS need, count(*) FILTER (Class = 1) AS n FROM a),
r AS (SELECT m.*, need // n AS per, need % n AS extra, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) - 1 AS rnk FROM m, c),
e AS (SELECT *, unnest(range(1, per + CASE WHEN rnk < extra THEN 1 ELSE 0 END + 1)) AS rep FROM r),
t AS (SELECT e.*, CAST(id AS VARCHAR) || '-' || rep AS tag FROM e),
s AS (SELECT t.*, ('0x' || substr(md5(tag || '-nn-42'), 1, 13))::BIGINT % k + 1 AS nn_rank,
             ('0x' || substr(md5(tag || '-42'), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM t JOIN k USING (id))
SELECT id, Class, round(Amount, 6) + 0.0 AS Amount, round(Hour, 6) + 0.0 AS Hour, false AS synthetic FROM a
UNION ALL SELECT -(rnk * (per + 1) + rep), 1, round(s.Amount + u * (na - s.Amount), 6) + 0.0, round(s.Hour + u * (nh - s.Hour), 6) + 0.0, true
FROM s JOIN p ON p.id = s.id AND p.nn_rank = s.nn_rank"""))
def smote_balanced(spark, sf):
    from ..functions.columns import rounded
    from ..operators.resample import smote

    t, _ = _minority(spark, sf)
    s = smote(t, ["Amount", "Hour"], label="Class", minority=1, k=5, seed=42)
    return s.select("id", "Class", rounded("Amount").alias("Amount"), rounded("Hour").alias("Hour"), "synthetic")
