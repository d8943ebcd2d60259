"""Score-level queries over deterministic model scores derived from txn_ml:
graph_score = V1, reconstruction_score = V2², iso_score = V3, flags by
fixed thresholds (V2² > 0.039, V3 < −0.155; about 10 % each)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import binarize, outlier_flag, rounded
from ..operators import ensemble_features as ef
from ..operators import metrics
from ..sources.tables import txn_ml, with_views
from .catalog import R, register

RECON_T, ISO_T = 0.039, -0.155

SCORES_SQL = f"""scores AS (SELECT id, Class, V1 AS graph_score, V2 * V2 AS reconstruction_score,
  CAST(V2 * V2 > {RECON_T} AS INTEGER) AS reconstruction_pred, V3 AS iso_score,
  CAST(V3 < {ISO_T} AS INTEGER) AS iso_pred FROM txn_ml)"""


def _sql(body: str) -> str:
    return with_views(f"WITH {SCORES_SQL} {body}", ml=True)


def score_parts(spark, sf):
    t = txn_ml(spark, sf)
    g = t.select("id", "Class", F.col("V1").alias("graph_score"))
    r = t.select("id", (F.col("V2") * F.col("V2")).alias("reconstruction_score")) \
         .withColumn("reconstruction_pred", binarize("reconstruction_score", RECON_T))
    i = t.select("id", F.col("V3").alias("iso_score")) \
         .withColumn("iso_pred", (F.col("iso_score") < ISO_T).cast("int"))
    return g, r, i


def scores(spark, sf):
    return ef.align_scores(*score_parts(spark, sf))


@register("score_table", "J4 U2", _sql(f"""
SELECT id, Class, {R('graph_score')} AS graph_score, {R('reconstruction_score')} AS reconstruction_score,
       reconstruction_pred, {R('iso_score')} AS iso_score, iso_pred FROM scores"""))
def score_table(spark, sf):
    s = scores(spark, sf)
    return s.select("id", "Class", rounded("graph_score").alias("graph_score"),
                    rounded("reconstruction_score").alias("reconstruction_score"), "reconstruction_pred",
                    rounded("iso_score").alias("iso_score"), "iso_pred")


@register("ensemble_features", "M5 N3 P8 P9 J4 J5", _sql(f"""
, p AS (SELECT min(graph_score) g0, max(graph_score) g1, min(reconstruction_score) r0,
               max(reconstruction_score) r1, min(-iso_score) i0, max(-iso_score) i1 FROM scores)
SELECT id, Class, {R('(graph_score - g0) / (g1 - g0 + 1e-8)')} AS graph_norm,
       {R('(reconstruction_score - r0) / (r1 - r0 + 1e-8)')} AS reconstruction_norm,
       {R('(-iso_score - i0) / (i1 - i0 + 1e-8)')} AS iso_norm,
       {R('graph_score')} AS graph_score, CAST(reconstruction_pred AS DOUBLE) AS reconstruction_pred,
       CAST(iso_pred AS DOUBLE) AS iso_pred
FROM scores CROSS JOIN p"""))
def ensemble_features(spark, sf):
    e = ef.ensemble_features(scores(spark, sf))
    return e.select("id", "Class", *[rounded(c).alias(c) if c.endswith(("norm", "score")) else F.col(c)
                                     for c in e.columns if c not in ("id", "Class")])


def _auc_sql(expr: str) -> str:
    return f"""(SELECT sum(pos * (neg_below + 0.5 * neg)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
  FROM (SELECT {expr} AS s, sum(CAST(Class = 1 AS BIGINT)) AS pos, sum(CAST(Class <> 1 AS BIGINT)) AS neg
        FROM scores GROUP BY 1) g) c)"""


@register("roc_auc", "M9", _sql(f"SELECT {R(_auc_sql('graph_score'))} AS auc"))
def roc_auc(spark, sf):
    a = metrics.roc_auc(scores(spark, sf), "graph_score")
    return a.select(rounded("auc").alias("auc"))


@register("model_comparison", "M9 M11 P8", _sql(f"""
SELECT 'graph' AS model, {R(_auc_sql('graph_score'))} AS auc
UNION ALL SELECT 'reconstruction', {R(_auc_sql('reconstruction_score'))}
UNION ALL SELECT 'isolation_forest', {R(_auc_sql('-iso_score'))}"""))
def model_comparison(spark, sf):
    c = metrics.model_comparison(scores(spark, sf), {
        "graph": ("graph_score", False),
        "reconstruction": ("reconstruction_score", False),
        "isolation_forest": ("iso_score", True)})
    return c.select("model", rounded("auc").alias("auc"))


def _report_sql(pred: str) -> str:
    return f"""
, c AS (SELECT sum(CAST(Class = 1 AND {pred} = 1 AS BIGINT)) tp, sum(CAST(Class = 0 AND {pred} = 1 AS BIGINT)) fp,
               sum(CAST(Class = 1 AND {pred} = 0 AS BIGINT)) fn, sum(CAST(Class = 0 AND {pred} = 0 AS BIGINT)) tn FROM scores),
k AS (SELECT tp, fp, fn, tn, tp + fp + fn + tn AS total,
        coalesce(tn / nullif(tn + fn, 0), 0) p0, coalesce(tn / nullif(tn + fp, 0), 0) r0,
        coalesce(tp / nullif(tp + fp, 0), 0) p1, coalesce(tp / nullif(tp + fn, 0), 0) r1 FROM c),
m AS (SELECT *, coalesce(2.0 * p0 * r0 / nullif(p0 + r0, 0), 0) f0, coalesce(2.0 * p1 * r1 / nullif(p1 + r1, 0), 0) f1,
             tn + fp AS s0, tp + fn AS s1 FROM k)
SELECT '0' AS metric, {R('p0')} AS precision, {R('r0')} AS recall, {R('f0')} AS f1_score, CAST(s0 AS BIGINT) AS support FROM m
UNION ALL SELECT '1', {R('p1')}, {R('r1')}, {R('f1')}, CAST(s1 AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, {R('(tp + tn) / total')}, CAST(total AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', {R('(p0 + p1) / 2')}, {R('(r0 + r1) / 2')}, {R('(f0 + f1) / 2')}, CAST(total AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', {R('(p0 * s0 + p1 * s1) / total')}, {R('(r0 * s0 + r1 * s1) / total')},
          {R('(f0 * s0 + f1 * s1) / total')}, CAST(total AS BIGINT) FROM m"""


def _report(spark, sf, pred):
    r = metrics.classification_report(scores(spark, sf), pred=pred)
    return r.select("metric", *[rounded(c).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@register("classification_report", "M10", _sql(_report_sql("iso_pred")))
def classification_report(spark, sf):
    return _report(spark, sf, "iso_pred")


@register("classification_report_reconstruction", "M10 P6", _sql(_report_sql("reconstruction_pred")))
def classification_report_reconstruction(spark, sf):
    return _report(spark, sf, "reconstruction_pred")


@register("score_flags", "P6 P7 P8", _sql(f"""
SELECT id, CAST(graph_score > 0.0 AS INTEGER) AS graph_pred,
       CASE WHEN iso_score < {ISO_T} THEN -1 ELSE 1 END AS iso_sign,
       CAST(CASE WHEN iso_score < {ISO_T} THEN 1 ELSE 0 END AS INTEGER) AS iso_flag,
       {R('abs(iso_score)')} AS confidence, {R('-iso_score')} AS iso_neg FROM scores"""))
def score_flags(spark, sf):
    s = scores(spark, sf)
    sign = F.when(F.col("iso_score") < ISO_T, F.lit(-1)).otherwise(F.lit(1))
    return s.select("id", binarize("graph_score", 0.0).alias("graph_pred"), sign.alias("iso_sign"),
                    outlier_flag(sign).alias("iso_flag"), rounded(F.abs("iso_score")).alias("confidence"),
                    rounded(-F.col("iso_score")).alias("iso_neg"))


@register("fallback_scoring", "M8 P10", _sql(f"""
SELECT CAST(id AS VARCHAR) AS transaction_id, iso_pred AS prediction, {R('abs(iso_score)')} AS confidence,
       {R('iso_score')} AS iso_score FROM scores"""))
def fallback_scoring(spark, sf):
    from ..operators.ensemble import fallback_predictions

    s = fallback_predictions(scores(spark, sf))
    return s.select("transaction_id", "prediction", rounded("confidence").alias("confidence"),
                    rounded("iso_score").alias("iso_score"))
