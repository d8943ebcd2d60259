"""Monitoring queries over alerts and batch statistics derived from txn:
alerts are rows with Amount > 147.35 (p95 at sf0.01), iso_score =
147.35/max(Amount, 0.01) − 1 (negative = anomalous), confidence = |iso_score|;
batches are 100 rows in (Time, id) order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import iso_timestamp, rounded
from ..operators import monitor, position, profile
from ..sources.tables import txn, with_views
from .catalog import R, register

THRESHOLD = 147.35
BATCH = 100


def scored_txn(spark, sf):
    t = txn(spark, sf, keep_ts=True)
    iso = F.lit(THRESHOLD) / F.greatest(F.col("Amount"), F.lit(0.01)) - F.lit(1.0)
    return t.select("id", "Time", "Amount", "Class",
                    iso_timestamp("ts").alias("timestamp"),
                    (F.col("Amount") > F.lit(THRESHOLD)).cast("int").alias("prediction"),
                    iso.alias("iso_score"), F.abs(iso).alias("confidence"))


def alerts(spark, sf):
    return monitor.alert_records(scored_txn(spark, sf))


def stats(spark, sf):
    b = position.row_batches(scored_txn(spark, sf), BATCH)
    return monitor.batch_stats(b)


SCORED_SQL = f"""scored AS (
  SELECT id, Time, Amount, Class, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
         CAST(Amount > {THRESHOLD} AS INTEGER) AS prediction,
         {THRESHOLD} / greatest(Amount, 0.01) - 1.0 AS iso_score,
         abs({THRESHOLD} / greatest(Amount, 0.01) - 1.0) AS confidence,
         CAST(floor((row_number() OVER (ORDER BY Time, id) - 1) / {BATCH}) AS BIGINT) AS batch_id
  FROM txn JOIN events ON events.event_id = txn.id),
alerts AS (SELECT timestamp, CAST(id AS VARCHAR) AS transaction_id, Amount AS amount, prediction,
                  confidence, iso_score FROM scored WHERE prediction = 1),
stats AS (SELECT batch_id, count(*) AS transactions_processed,
                 CAST(sum(prediction) AS BIGINT) AS fraud_detected,
                 sum(prediction) / count(*) AS fraud_rate FROM scored GROUP BY batch_id)"""


def _sql(body: str) -> str:
    return with_views(f"WITH {SCORED_SQL} {body}")


@register("batch_stats", "W2 A11 P5", _sql(f"""
SELECT batch_id, transactions_processed, fraud_detected, {R('fraud_rate')} AS fraud_rate FROM stats"""))
def batch_stats(spark, sf):
    s = stats(spark, sf)
    return s.select("batch_id", "transactions_processed", "fraud_detected", rounded("fraud_rate").alias("fraud_rate"))


@register("batch_running_totals", "W3 X5", _sql("""
SELECT batch_id, transactions_processed, fraud_detected,
       CAST(sum(transactions_processed) OVER (ORDER BY batch_id) AS BIGINT) AS total_processed,
       CAST(sum(fraud_detected) OVER (ORDER BY batch_id) AS BIGINT) AS total_fraud_detected
FROM stats"""))
def batch_running_totals(spark, sf):
    s = monitor.with_running_totals(stats(spark, sf))
    return s.select("batch_id", "transactions_processed", "fraud_detected",
                    F.col("total_processed").cast("long").alias("total_processed"),
                    F.col("total_fraud_detected").cast("long").alias("total_fraud_detected"))


@register("alert_summary", "A12 P10", _sql(f"""
SELECT count(*) AS n_alerts, {R('avg(confidence)')} AS avg_confidence,
       {R('avg(amount)')} AS avg_amount, {R('max(amount)')} AS max_amount FROM alerts"""))
def alert_summary(spark, sf):
    s = monitor.alert_summary(alerts(spark, sf))
    return s.select("n_alerts", *[rounded(c).alias(c) for c in ("avg_confidence", "avg_amount", "max_amount")])


@register("overall_rate", "A13", _sql(f"""
SELECT CAST(sum(transactions_processed) AS BIGINT) AS total_processed,
       CAST(sum(fraud_detected) AS BIGINT) AS total_fraud,
       {R('CASE WHEN sum(transactions_processed) > 0 THEN sum(fraud_detected) / sum(transactions_processed) ELSE 0 END')} AS overall_rate
FROM stats"""))
def overall_rate(spark, sf):
    o = monitor.overall_rate(stats(spark, sf))
    return o.select("total_processed", "total_fraud", rounded("overall_rate").alias("overall_rate"))


@register("recent_alerts", "T1 P11 P12 P13", _sql("""
SELECT timestamp, transaction_id, printf('$%.2f', amount) AS amount, printf('%.3f', confidence) AS confidence
FROM alerts ORDER BY timestamp DESC, transaction_id LIMIT 10"""))
def recent_alerts(spark, sf):
    return monitor.recent_alerts(alerts(spark, sf))


@register("alert_confidence_histogram", "A8", _sql(f"""
, r AS (SELECT CASE WHEN min(confidence) = max(confidence) THEN min(confidence) - 0.5 ELSE min(confidence) END AS lo,
              CASE WHEN min(confidence) = max(confidence) THEN max(confidence) + 0.5 ELSE max(confidence) END AS hi FROM alerts),
b AS (SELECT CAST(least(floor((confidence - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, lo, hi FROM alerts CROSS JOIN r)
SELECT bin, {R('lo + bin * ((hi - lo) / 20.0)')} AS bin_lo, count(*) AS n FROM b GROUP BY bin, lo, hi"""))
def alert_confidence_histogram(spark, sf):
    h = profile.histogram(alerts(spark, sf), "confidence", 20)
    return h.select("bin", rounded("bin_lo").alias("bin_lo"), "n")


@register("alert_documents", "A14 S5 U2", _sql(f"""
SELECT batch_id, count(*) AS fraud_count, {R('sum(Amount)')} AS cases_amount, {R('min(Time)')} AS first_case_time
FROM scored WHERE prediction = 1 GROUP BY batch_id"""))
def alert_documents(spark, sf):
    b = position.row_batches(scored_txn(spark, sf), BATCH)
    cases = b.where(F.col("prediction") == 1).withColumn("anomaly_score", F.col("iso_score"))
    docs = monitor.alert_documents(cases)
    amount = F.aggregate("cases", F.lit(0.0), lambda acc, c: acc + c["Amount"])
    first = F.array_min(F.transform("cases", lambda c: c["Time"]))
    return docs.select("batch_id", "fraud_count", rounded(amount).alias("cases_amount"),
                       rounded(first).alias("first_case_time"))


_PARSED = "strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')"


@register("alert_timeline", "P13 A12", _sql(f"""
SELECT CAST(date_trunc('day', {_PARSED}) AS VARCHAR) AS day,
       count(*) AS n_alerts, {R('avg(confidence)')} AS avg_confidence,
       {R(f'avg(epoch_us({_PARSED}) / 1e6)')} AS mean_epoch
FROM alerts GROUP BY 1"""))
def alert_timeline(spark, sf):
    from ..functions.columns import epoch_seconds, parse_iso

    a = alerts(spark, sf).withColumn("_ts", parse_iso("timestamp"))
    g = a.groupBy(F.date_format(F.date_trunc("day", "_ts"), "yyyy-MM-dd HH:mm:ss").alias("day")) \
         .agg(F.count(F.lit(1)).alias("n_alerts"), F.avg("confidence").alias("avg_confidence"),
              F.avg(epoch_seconds("_ts")).alias("mean_epoch"))
    return g.select("day", "n_alerts", rounded("avg_confidence").alias("avg_confidence"),
                    rounded("mean_epoch").alias("mean_epoch"))
