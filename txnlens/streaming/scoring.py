"""Structured Streaming scorer.

``readStream`` of transaction files → ``foreachBatch(score_batch)``; inside
each micro-batch one DataFrame plan does feature engineering, forest,
reconstruction and graph scoring and the ensemble over them (with the
functions and parameters of the training), and writes the alert rows, the batch
statistics and the nested alert document, all keyed by ``batch_id`` so a
replayed batch (after a failure, from the checkpoint) rewrites the same
files. Running totals are computed when the stats are read, never carried
in driver memory.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import defaulted_id, iso_timestamp
from ..operators import ensemble as ens
from ..operators.ensemble_features import apply_score_range
from ..operators.features import engineer_features, feature_columns
from ..operators.forest import IsolationForestModel, score_isolation_forest
from ..operators.graph_model import graph_features, graph_scores
from ..operators.monitor import batch_stats, with_running_totals
from ..operators.reconstruct import ReconstructionModel, reconstruction_score
from ..schemas import ALERTS, BATCH_ALERT_DOC, STATS
from ..sources.commits import read_committed, write_batch
from ..sources.files import (DOCUMENTS, alert_documents, batches_documents, flatten_cases, read_alerts, read_batch_alerts, read_stats, write_alert_document,
                             write_batch_rows, write_batches)
from .graph_tail import GraphTail


@dataclass
class ScoringModels:
    scaler: DataFrame                # one-row robust-scaler parameters
    forest: IsolationForestModel
    ensemble: PipelineModel | None = None
    reconstruction: ReconstructionModel | None = None
    graph: PipelineModel | None = None
    score_range: DataFrame | None = None  # one-row min-max parameters of the scores

    def whole(self) -> bool:
        return None not in (self.ensemble, self.reconstruction, self.graph, self.score_range)


def transaction_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                       max_files_per_trigger: int = 1, glob: str | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if fmt == "csv":
        r = r.option("header", True)
    return r.format(fmt).load(path)


def score_frame(df: DataFrame, models: ScoringModels, tail: GraphTail | None = None, batch_id: int = 0, last: bool = False) -> DataFrame:
    """Features → forest, reconstruction and graph scores → the ensemble, as
    in training; the forest alone while any of the other models is absent.
    With ``tail`` the graph spans micro-batches: the rows scored are those that
    are ready in this one, with the graph features of the whole stream."""
    if "id" not in df.columns:
        df = df.withColumn("id", F.monotonically_increasing_id())
    keep = [c for c in df.columns if not c.startswith("V")]
    f = engineer_features(df, models.scaler, keep=keep)
    if not models.whole():
        return ens.score_ensemble(score_isolation_forest(f, models.forest), None)
    cols = models.forest.features
    if tail is None:
        h = graph_features(f.select("id", "Time", "Amount", *[c for c in cols if c not in ("Time", "Amount")]), cols, hops=3)
    else:
        f, h = tail.advance(f, batch_id, last)
    s = reconstruction_score(score_isolation_forest(f, models.forest), models.reconstruction)
    g = graph_scores(models.graph, h).select("id", "graph_score")
    return ens.score_ensemble(apply_score_range(s.join(g, "id"), models.score_range), models.ensemble)


def serving_tail(models: ScoringModels, root: str) -> GraphTail:
    """The graph state of a serving stream, under the sink's folder."""
    return GraphTail(f"{root}/_graph", list(models.forest.features), hops=3)


def score_batch(models: ScoringModels | None, sink_root: str, scorer=None, tail: GraphTail | None = None, commit: bool = False):
    """The ``foreachBatch`` callback. ``scorer`` (DataFrame → DataFrame with
    prediction, confidence, iso_score) replaces the model scorer when given,
    e.g. a fixed rule; the sinks are the same. With ``tail`` a batch writes
    the rows that have become ready, and ``flush`` the last of them. With
    ``commit`` the three tables of a batch go through the sink of whole batches
    (``commits``): a crash leaves all of the batch or nothing."""
    def process(batch_df: DataFrame, batch_id: int, last: bool = False) -> None:
        batch_df = batch_df.persist()
        try:
            if batch_df.isEmpty() and not last:
                return
            now = time.time()
            scored = scorer(batch_df) if scorer else score_frame(batch_df, models, tail, batch_id, last)
            scored = scored.withColumn("anomaly_score", F.col("iso_score")).persist()
            if tail is not None and scored.isEmpty():  # all its rows wait for their followers
                scored.unpersist()
                return
            ts = iso_timestamp(F.current_timestamp())
            alerts = scored.where(F.col("prediction") == 1)
            rows = alerts.select(ts.alias("timestamp"), defaulted_id(scored).alias("transaction_id"),
                                 F.col("Amount").alias("amount"), F.col("prediction").cast("int"),
                                 F.col("confidence").cast("double"), F.col("iso_score"))
            stats = scored.agg(F.count(F.lit(1)).alias("transactions_processed"),
                               F.sum(F.col("prediction").cast("long")).alias("fraud_detected"))
            # batch_id is the partition folder of the row, not a data column
            stats = stats.select(ts.alias("timestamp"),
                                 "transactions_processed", "fraud_detected",
                                 (F.col("fraud_detected") / F.col("transactions_processed")).alias("fraud_rate"))
            if commit:
                write_batch({"alerts": rows, "stats": stats, "documents": alert_documents(alerts, batch_id, now)}, sink_root, batch_id)
            else:
                write_batch_rows(rows, sink_root, "alerts", batch_id)
                write_batch_rows(stats, sink_root, "stats", batch_id)
                write_alert_document(alerts, batch_id, sink_root, now)
            scored.unpersist()
        finally:
            batch_df.unpersist()

    return process


def score_row_batches(sink_root: str, scorer, rows_per_batch: int):
    """The ``foreachBatch`` callback over a ``row_stream`` that admits several
    batches at once: every batch (``pos div rows_per_batch``) gets the alert
    rows, statistics and documents that it has as a micro-batch of its own,
    each table in one write."""
    def process(df: DataFrame, _: int) -> None:
        scored = scorer(df.withColumn("batch_id", F.floor(F.col("pos") / F.lit(rows_per_batch)).cast("long")))
        scored = scored.withColumn("anomaly_score", F.col("iso_score")).persist()
        try:
            ends = scored.agg(F.min("batch_id"), F.max("batch_id")).first()
            if ends[0] is None:
                return
            batches, now, ts = range(ends[0], ends[1] + 1), time.time(), iso_timestamp(F.current_timestamp())
            alerts = scored.where(F.col("prediction") == 1)
            rows = alerts.select(ts.alias("timestamp"), defaulted_id(scored).alias("transaction_id"),
                                 F.col("Amount").alias("amount"), F.col("prediction").cast("int"),
                                 F.col("confidence").cast("double"), F.col("iso_score"), "batch_id")
            stats = batch_stats(scored).select(ts.alias("timestamp"), "transactions_processed", "fraud_detected", "fraud_rate", "batch_id")
            write_batches(rows, sink_root, "alerts", batches)
            write_batches(stats, sink_root, "stats", batches)
            documents = batches_documents(alerts, rows_per_batch, now)
            write_batches(documents.withColumn("batch", F.col("batch_id")), sink_root, DOCUMENTS, batches, by="batch")
        finally:
            scored.unpersist()

    return process


def start_scoring(stream: DataFrame, models: ScoringModels | None, sink_root: str, checkpoint: str,
                  available_now: bool = True, processing_time: str | None = None, scorer=None, tail: GraphTail | None = None, commit: bool = False):
    """Start the scorer; ``available_now`` processes what is there and stops
    (a ``row_stream`` is ended by ``run_to_end`` instead)."""
    w = stream.writeStream.foreachBatch(score_batch(models, sink_root, scorer, tail, commit)) \
              .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def read_monitoring(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(alerts, stats with running totals, flattened batch-document cases)."""
    alerts = read_alerts(spark, root)
    stats = read_stats(spark, root)
    base = stats.drop("total_processed", "total_fraud_detected")
    if "batch_id" in base.columns:
        base = base.withColumn("batch_id", F.col("batch_id").cast("long"))
    return alerts, with_running_totals(base), read_batch_alerts(spark, root)


def read_committed_monitoring(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tables of ``read_monitoring``, of the committed batches alone."""
    stats = read_committed(spark, root, "stats", STATS).drop("total_processed", "total_fraud_detected")
    cases = flatten_cases(read_committed(spark, root, "documents", BATCH_ALERT_DOC))
    return read_committed(spark, root, "alerts", ALERTS), with_running_totals(stats), cases
