"""Evaluation: ROC AUC (ties averaged), classification report, comparison.

ROC AUC = Σ_s pos(s)·(neg_below(s) + ½·neg(s)) / (P·N), where the scores
are first grouped (one row per distinct score, map-side combined) and
neg_below is a distributed running sum over the score order — no global
single-partition rank. One class only → NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .position import running_sums


def score_counts(df: DataFrame, score: str, label: str = "Class") -> DataFrame:
    y = F.col(label).cast("int")
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col(score).cast("double").alias("_s"))
              .agg(F.sum((y == 1).cast("long")).alias("_pos"), F.sum((y != 1).cast("long")).alias("_neg")))


def roc_auc(df: DataFrame, score: str, label: str = "Class", negate: bool = False) -> DataFrame:
    """One row ``auc``; ``negate`` ranks by −score (lower = more positive)."""
    d = df.withColumn("_score", -F.col(score) if negate else F.col(score))
    g = score_counts(d, "_score", label)
    c = running_sums(g, ["_s"], {"_neg_below": "_neg"}, inclusive=False)
    num = F.sum(F.col("_pos") * (F.col("_neg_below") + F.lit(0.5) * F.col("_neg")))
    den = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return c.agg(F.try_divide(num, den).alias("auc"))


def model_comparison(df: DataFrame, scores: dict[str, tuple[str, bool]], label: str = "Class") -> DataFrame:
    """(model, auc) for several score columns {model: (column, negate)}: the
    columns are unpivoted, so the input runs once, and grouped by (model,
    score); the grouped scores are written once, one distributed running sum
    runs over their order, and each model's negatives-below are rebased by
    those of the models before it (one row per model)."""
    y = F.col(label).cast("int").alias("_y")
    cols = [(-F.col(c) if neg else F.col(c)).cast("double").alias(name) for name, (c, neg) in scores.items()]
    long = df.select(y, *cols).unpivot(["_y"], list(scores), "model", "_s").where("_s IS NOT NULL AND _y IS NOT NULL")
    g = long.groupBy("model", "_s").agg(F.sum((F.col("_y") == 1).cast("long")).alias("_pos"),
                                        F.sum((F.col("_y") != 1).cast("long")).alias("_neg"))
    g = materialize(g, "model-scores")
    c = running_sums(g, ["model", "_s"], {"_nb": "_neg"}, inclusive=False)
    per = g.groupBy("model").agg(F.sum("_neg").alias("_mneg"))
    w = Window.orderBy("model").rowsBetween(Window.unboundedPreceding, -1)
    # one row per model: a proven bound
    start = F.broadcast(per.select("model", F.coalesce(F.sum("_mneg").over(w), F.lit(0)).alias("_m0")))
    c = c.join(start, "model").withColumn("_neg_below", F.col("_nb") - F.col("_m0"))
    num = F.sum(F.col("_pos") * (F.col("_neg_below") + F.lit(0.5) * F.col("_neg")))
    den = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return c.groupBy("model").agg(F.try_divide(num, den).alias("auc"))


def confusion_counts(df: DataFrame, label: str = "Class", pred: str = "prediction") -> DataFrame:
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    return df.agg(F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
                  F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
                  F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
                  F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"))


def _div0(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "Class", pred: str = "prediction") -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' with precision,
    recall, f1_score, support; a zero denominator gives 0."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    per = {}
    for k, (t, f_p, f_n) in {"0": (tn, fn, fp), "1": (tp, fp, fn)}.items():
        prec, rec = _div0(t, t + f_p), _div0(t, t + f_n)
        per[k] = (prec, rec, _div0(F.lit(2.0) * prec * rec, prec + rec), (t + f_n))
    total = tp + fp + fn + tn
    acc = _div0(tp + tn, total)
    rows = [F.struct(F.lit(k).alias("metric"), p.alias("precision"), r.alias("recall"),
                     f.alias("f1_score"), s.cast("long").alias("support")) for k, (p, r, f, s) in per.items()]
    rows.append(F.struct(F.lit("accuracy").alias("metric"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"),
                         total.cast("long").alias("support")))
    (p0, r0, f0, s0), (p1, r1, f1, s1) = per["0"], per["1"]
    rows.append(F.struct(F.lit("macro avg").alias("metric"), ((p0 + p1) / 2).alias("precision"),
                         ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1_score"),
                         total.cast("long").alias("support")))
    wavg = lambda a, b: _div0(a * s0 + b * s1, total)
    rows.append(F.struct(F.lit("weighted avg").alias("metric"), wavg(p0, p1).alias("precision"),
                         wavg(r0, r1).alias("recall"), wavg(f0, f1).alias("f1_score"),
                         total.cast("long").alias("support")))
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
