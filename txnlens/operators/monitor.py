"""Monitoring: alert records, batch statistics, running totals, summaries,
recent alerts and the nested per-batch alert document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import defaulted_id, fixed3, money, safe_ratio
from .position import running_sums


def alert_records(scored: DataFrame, ts_col: str = "timestamp", amount: str = "Amount",
                  pred: str = "prediction", confidence: str = "confidence",
                  iso: str = "iso_score") -> DataFrame:
    """Alert rows (prediction == 1) in the alert-log schema."""
    return scored.where(F.col(pred) == 1).select(
        F.col(ts_col).cast("string").alias("timestamp"),
        defaulted_id(scored).alias("transaction_id"),
        F.col(amount).cast("double").alias("amount"),
        F.col(pred).cast("int").alias("prediction"),
        F.col(confidence).cast("double").alias("confidence"),
        F.col(iso).cast("double").alias("iso_score"))


def batch_stats(scored: DataFrame, pred: str = "prediction", batch: str = "batch_id") -> DataFrame:
    """Per batch: processed, detected, rate = detected / processed."""
    g = scored.groupBy(batch).agg(F.count(F.lit(1)).alias("transactions_processed"),
                                  F.sum(F.col(pred).cast("long")).alias("fraud_detected"))
    return g.withColumn("fraud_rate", F.col("fraud_detected") / F.col("transactions_processed"))


def with_running_totals(stats: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Cumulative processed/detected up to each batch, computed on read so a
    replayed batch cannot be counted twice. Distributed (no single-task
    window): the number of batches grows with the input."""
    return running_sums(stats, [batch], {"total_processed": "transactions_processed",
                                         "total_fraud_detected": "fraud_detected"})


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("n_alerts"),
                      F.avg("confidence").alias("avg_confidence"),
                      F.avg("amount").alias("avg_amount"),
                      F.max("amount").alias("max_amount"))


def overall_rate(stats: DataFrame) -> DataFrame:
    """Weighted rate sum(detected)/sum(processed); 0 when nothing processed."""
    t = stats.agg(F.coalesce(F.sum("transactions_processed"), F.lit(0)).cast("long").alias("total_processed"),
                  F.coalesce(F.sum("fraud_detected"), F.lit(0)).cast("long").alias("total_fraud"))
    return t.withColumn("overall_rate", safe_ratio("total_fraud", "total_processed", zero=0.0))


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Ten most recent alerts (top-k via TakeOrderedAndProject), formatted."""
    top = alerts.orderBy(F.col("timestamp").desc(), F.col("transaction_id")).limit(n)
    return top.select("timestamp", "transaction_id",
                      money("amount").alias("amount"), fixed3("confidence").alias("confidence"))


def alert_documents(cases: DataFrame, batch: str = "batch_id", score: str = "anomaly_score") -> DataFrame:
    """One nested document per batch: count + array of (Time, Amount, score).
    A batch is bounded by the batch size, so each collected list is too."""
    return cases.groupBy(batch).agg(
        F.count(F.lit(1)).alias("fraud_count"),
        F.collect_list(F.struct(F.col("Time").cast("double").alias("Time"),
                                F.col("Amount").cast("double").alias("Amount"),
                                F.col(score).cast("double").alias("anomaly_score"))).alias("cases"))


def flatten_cases(docs: DataFrame) -> DataFrame:
    """Nested documents → one row per case; a missing ``cases`` gives none."""
    return docs.select(F.explode_outer("cases").alias("c")).where(F.col("c").isNotNull()).select("c.*")
