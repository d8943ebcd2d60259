"""Streaming queries over the events table: as a file stream, scored per
micro-batch by the forest or a fixed rule, sunk to replay-safe alert, stat and
document tables and read back with running totals; and as a stream of rows in
order, with batches of so many rows, totals as keyed state, and the similarity
graph carried across micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hour_of_day, rounded
from ..operators.common import attach_params
from ..operators.features import engineer_features, feature_columns, fit_feature_scaler
from ..operators.forest import fit_isolation_forest
from ..schemas import EVENTS
from ..session import scratch_path
from ..sources.files import is_folder
from ..sources.rowstream import index_rows, row_stream, run_to_end
from ..sources.tables import TXN_SQL, txn, txn_from_events
from ..streaming.graph_tail import GraphTail, edges_sink, features_sink, flush
from ..streaming.scoring import ScoringModels, read_committed_monitoring, read_monitoring, score_row_batches, start_scoring, transaction_stream
from ..streaming.totals import read_totals, running_totals, start_totals
from .catalog import R, register
from .q_graph import _HOP
from .q_graph import _sql as _graph_sql


def events_stream(spark, sf):
    """The events as a file stream of one batch, whether the table is a file
    or a folder of part files."""
    path = f"{sf.rstrip('/')}/events.parquet"
    if is_folder(spark, path):
        return transaction_stream(spark, path, EVENTS, max_files_per_trigger=2 ** 31 - 1)
    return transaction_stream(spark, sf, EVENTS, glob="events.parquet")


def run_stream(spark, sf):
    static = txn(spark, sf)
    scaler = fit_feature_scaler(static)
    feats = engineer_features(static, scaler, keep=["id", "Class"])
    forest = fit_isolation_forest(feats, feature_columns(feats), n_trees=100, max_samples=256, seed=42)
    models = ScoringModels(scaler=scaler, forest=forest)
    root = scratch_path(spark, "stream-sink")
    stream = txn_from_events(events_stream(spark, sf))
    q = start_scoring(stream, models, root, f"{root}/_checkpoint", available_now=True)
    q.awaitTermination()
    return read_monitoring(spark, root)


@register("stream_batch_stats", "S9 X1 X2 X3 X4 X5 S6 S7 S8 S4 W3")
def stream_batch_stats(spark, sf):
    _, stats, _ = run_stream(spark, sf)
    return stats.select("batch_id", "transactions_processed", "fraud_detected",
                        "total_processed", "total_fraud_detected")


@register("stream_alert_cases", "S5 A14 U2")
def stream_alert_cases(spark, sf):
    alerts, _, cases = run_stream(spark, sf)
    return cases.agg(F.count(F.lit(1)).alias("n_cases"),
                     F.sum("Amount").alias("cases_amount")).withColumn("n_alerts", F.lit(alerts.count()).cast("long"))


# -- the same streaming path with a fixed rule as scorer (oracle-checkable) -------

RULE_T = 147.35


def rule_scorer(df):
    """Fixture rule: alert when Amount > 147.35; iso_score = 147.35/max(Amount, 0.01) − 1."""
    iso = F.lit(RULE_T) / F.greatest(F.col("Amount"), F.lit(0.01)) - F.lit(1.0)
    return df.withColumn("iso_score", iso).withColumn("confidence", F.abs(iso)) \
             .withColumn("prediction", (F.col("Amount") > F.lit(RULE_T)).cast("int"))


def run_rule_stream(spark, sf):
    root = scratch_path(spark, "rule-stream-sink")
    stream = txn_from_events(events_stream(spark, sf))
    q = start_scoring(stream, None, root, f"{root}/_checkpoint", available_now=True, scorer=rule_scorer)
    q.awaitTermination()
    return read_monitoring(spark, root)


_RULE_SQL = f"""WITH {{views}}
s AS (SELECT count(*) AS n, CAST(sum(CAST(Amount > {RULE_T} AS INTEGER)) AS BIGINT) AS d,
             sum(CASE WHEN Amount > {RULE_T} THEN Amount END) AS amt FROM txn)"""


def _rule_sql(body: str) -> str:
    return _RULE_SQL.format(views=f"txn AS ({TXN_SQL}),") + " " + body


@register("stream_rule_stats", "S9 X1 X2 X3 X5 S7 S4 W3", _rule_sql("""
SELECT CAST(0 AS BIGINT) AS batch_id, n AS transactions_processed, d AS fraud_detected,
       n AS total_processed, d AS total_fraud_detected FROM s"""))
def stream_rule_stats(spark, sf):
    _, stats, _ = run_rule_stream(spark, sf)
    return stats.select(F.col("batch_id").cast("long").alias("batch_id"),
                        F.col("transactions_processed").cast("long").alias("transactions_processed"),
                        F.col("fraud_detected").cast("long").alias("fraud_detected"),
                        F.col("total_processed").cast("long").alias("total_processed"),
                        F.col("total_fraud_detected").cast("long").alias("total_fraud_detected"))


@register("stream_rule_alerts", "S6 S8 S5 X4 A14 U2", _rule_sql("""
SELECT d AS n_alerts, d AS n_cases, round(amt, 4) + 0.0 AS cases_amount FROM s"""))
def stream_rule_alerts(spark, sf):
    alerts, _, cases = run_rule_stream(spark, sf)
    return cases.agg(F.count(F.lit(1)).alias("n_cases"), rounded(F.sum("Amount"), 4).alias("cases_amount")) \
                .withColumn("n_alerts", F.lit(alerts.count()).cast("long"))


@register("stream_committed_alerts", "S6 S7 S8 X4 X5 A14", _rule_sql("""
SELECT CAST(0 AS BIGINT) AS batch_id, n AS transactions_processed, d AS total_fraud_detected,
       d AS n_alerts, d AS n_cases, round(amt, 4) + 0.0 AS cases_amount FROM s"""))
def stream_committed_alerts(spark, sf):
    """The rule stream through the sink of whole batches."""
    root = scratch_path(spark, "committed-sink")
    stream = txn_from_events(events_stream(spark, sf))
    q = start_scoring(stream, None, root, f"{root}/_checkpoint", available_now=True, scorer=rule_scorer, commit=True)
    q.awaitTermination()
    alerts, stats, cases = read_committed_monitoring(spark, root)
    one = cases.agg(F.count(F.lit(1)).alias("n_cases"), rounded(F.sum("Amount"), 4).alias("cases_amount"))
    both = alerts.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_alerts"))
    return attach_params(stats.join(both, "batch_id").select("batch_id", "transactions_processed", "total_fraud_detected", "n_alerts"), one)


@register("stream_three_files", "S9 X1 X3 X5 S7 U2", _rule_sql(f"""
, b AS (SELECT CAST(id % 3 AS BIGINT) AS batch_id, count(*) AS n, CAST(sum(CAST(Amount > {RULE_T} AS INTEGER)) AS BIGINT) AS d FROM txn GROUP BY 1)
SELECT batch_id, n AS transactions_processed, d AS fraud_detected, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS total_processed,
       CAST(sum(d) OVER (ORDER BY batch_id) AS BIGINT) AS total_fraud_detected FROM b"""))
def stream_three_files(spark, sf):
    """The events as three folders of files that arrive one after another, a
    batch each: the stream takes all new files and stops before the next arrive."""
    from ..sources.tables import table

    root = scratch_path(spark, "three-files")
    events = table(spark, sf, "events")
    for i in range(3):
        events.where(F.col("event_id") % 3 == i).write.mode("append").parquet(f"{root}/in")
        stream = txn_from_events(transaction_stream(spark, f"{root}/in", EVENTS, max_files_per_trigger=2 ** 31 - 1, glob="*.parquet"))
        q = start_scoring(stream, None, f"{root}/out", f"{root}/out/_checkpoint", available_now=True, scorer=rule_scorer)
        q.awaitTermination()
    _, stats, _ = read_monitoring(spark, f"{root}/out")
    return stats.select(*[F.col(c).cast("long").alias(c) for c in ("batch_id", "transactions_processed", "fraud_detected",
                                                                   "total_processed", "total_fraud_detected")])


# -- the events as a stream of rows in (Time, id) order -------------------------

BATCH_ROWS = 3000     # of a batch with sinks
BATCHES_AT_ONCE = 100  # of them, in a micro-batch
TOTALS_ROWS = 100     # of a batch of the totals; micro-batches of TOTALS_ADMITTED rows end inside some
TOTALS_ADMITTED = 4050
GRAPH_ROWS = 4000      # of a batch of the graph; a micro-batch of it or of the totals takes 1, 2, 4, ... BATCHES_AT_ONCE of theirs


@register("stream_row_batches", "S9 W2 X1 X3 X5", _rule_sql(f"""
, p AS (SELECT Amount, CAST(floor((row_number() OVER (ORDER BY Time, id) - 1) / {BATCH_ROWS}) AS BIGINT) AS batch_id FROM txn),
b AS (SELECT batch_id, count(*) AS n, CAST(sum(CAST(Amount > {RULE_T} AS INTEGER)) AS BIGINT) AS d FROM p GROUP BY 1)
SELECT batch_id, n AS transactions_processed, d AS fraud_detected, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS total_processed,
       CAST(sum(d) OVER (ORDER BY batch_id) AS BIGINT) AS total_fraud_detected FROM b"""))
def stream_row_batches(spark, sf):
    """Batches of exactly BATCH_ROWS rows, the last one short, through the
    scoring sinks; a micro-batch takes as many as are waiting, up to BATCHES_AT_ONCE."""
    root = scratch_path(spark, "row-batches")
    stream = row_stream(spark, index_rows(txn(spark, sf)), BATCH_ROWS, batches_at_once=BATCHES_AT_ONCE)
    process = score_row_batches(root, rule_scorer, BATCH_ROWS)
    run_to_end(stream.writeStream.foreachBatch(process).option("checkpointLocation", f"{root}/_checkpoint").start())
    _, stats, _ = read_monitoring(spark, root)
    return stats.select(*[F.col(c).cast("long").alias(c) for c in ("batch_id", "transactions_processed", "fraud_detected",
                                                                   "total_processed", "total_fraud_detected")])


@register("stream_keyed_totals", "X5 W3 W2", _rule_sql(f"""
, p AS (SELECT Amount, CAST(floor((row_number() OVER (ORDER BY Time, id) - 1) / {TOTALS_ROWS}) AS BIGINT) AS batch_id FROM txn),
b AS (SELECT batch_id, count(*) AS n, CAST(sum(CAST(Amount > {RULE_T} AS INTEGER)) AS BIGINT) AS d FROM p GROUP BY 1)
SELECT batch_id, n AS transactions_processed, d AS fraud_detected, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS total_processed,
       CAST(sum(d) OVER (ORDER BY batch_id) AS BIGINT) AS total_fraud_detected FROM b"""))
def stream_keyed_totals(spark, sf):
    """Running totals of batches of TOTALS_ROWS rows, held in the state store."""
    root = scratch_path(spark, "keyed-totals")
    rows = rule_scorer(row_stream(spark, index_rows(txn(spark, sf)), TOTALS_ADMITTED, batches_at_once=BATCHES_AT_ONCE, growing=True))
    totals = running_totals(rows.withColumn("batch_id", F.floor(F.col("pos") / F.lit(TOTALS_ROWS))))
    run_to_end(start_totals(totals, f"{root}/out", f"{root}/_checkpoint", partitions=1))  # totals of one key
    return read_totals(spark, f"{root}/out").drop("key")


def run_graph_stream(spark, sf, hops: int, sink) -> str:
    root = scratch_path(spark, "graph-stream")
    rows = txn(spark, sf).select("id", "Time", "Amount").withColumn("Hour", hour_of_day("Time"))
    tail = GraphTail(f"{root}/state", ["Amount", "Hour"], hops=hops)
    stream = row_stream(spark, index_rows(rows), GRAPH_ROWS, batches_at_once=BATCHES_AT_ONCE, growing=True).drop("pos")
    process = sink(tail, f"{root}/out")
    run_to_end(stream.writeStream.foreachBatch(process).option("checkpointLocation", f"{root}/_checkpoint").start())
    if hops:
        flush(spark, tail, process, stream.schema)
    return f"{root}/out"


@register("stream_band_edges", "X1 J1 S9", _graph_sql("SELECT src, dst FROM fwd"))
def stream_band_edges(spark, sf):
    """The edges of the whole graph, found micro-batch by micro-batch."""
    return spark.read.schema("src long, dst long").parquet(run_graph_stream(spark, sf, 0, edges_sink)).select("src", "dst")


@register("stream_graph_features", "X1 J1 J3 M3", _graph_sql(", deg AS (SELECT dst AS id, count(*) AS d FROM sym GROUP BY dst), " + ", ".join(
    _HOP.format(i=i, src="pos" if i == 1 else f"h{i - 1}") for i in (1, 2, 3)) + f"""
SELECT id, {R('Amount', 5)} AS Amount_h, {R('Hour', 5)} AS Hour_h FROM h3"""))
def stream_graph_features(spark, sf):
    """Three hops of propagation over micro-batches: the features of the graph of all rows."""
    h = spark.read.schema("id long, Amount double, Hour double").parquet(run_graph_stream(spark, sf, 3, features_sink))
    return h.select("id", rounded("Amount", 5).alias("Amount_h"), rounded("Hour", 5).alias("Hour_h"))
