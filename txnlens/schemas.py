"""Declared schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


TXN = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("Time", T.DoubleType(), True),
    T.StructField("Amount", T.DoubleType(), True),
    T.StructField("Class", T.IntegerType(), True),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])

ALERTS = T.StructType([
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("prediction", T.IntegerType(), True),
    T.StructField("confidence", T.DoubleType(), True),
    T.StructField("iso_score", T.DoubleType(), True),
])

STATS = T.StructType([
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("transactions_processed", T.LongType(), True),
    T.StructField("fraud_detected", T.LongType(), True),
    T.StructField("fraud_rate", T.DoubleType(), True),
    T.StructField("total_processed", T.LongType(), True),
    T.StructField("total_fraud_detected", T.LongType(), True),
])

CASE = T.StructType([
    T.StructField("Time", T.DoubleType(), True),
    T.StructField("Amount", T.DoubleType(), True),
    T.StructField("anomaly_score", T.DoubleType(), True),
])

BATCH_ALERT_DOC = T.StructType([
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("fraud_count", T.LongType(), True),
    T.StructField("cases", T.ArrayType(CASE), True),
])

# Ensemble feature order is part of the model contract.
ENSEMBLE_FEATURES = ["graph_norm", "reconstruction_norm", "iso_norm",
                     "graph_score", "reconstruction_pred", "iso_pred"]

ENGINEERED = ["Amount_scaled", "Time_scaled", "Hour", "Amount_log"]
