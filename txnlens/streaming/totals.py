"""Running totals as keyed state.

Rows are counted by key and batch where they are read (a map-side combine: a
few rows a task are shuffled, whatever the rows), and a stateful processor
holds, for each key, the totals before its open batch and the counts of that
batch. A micro-batch may end inside a batch: the batch is reported again when
more of it comes, so output mode is update and the latest report holds.

The state is Spark's state store: a replayed micro-batch starts from the
state that the one before it committed, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "batch_id long, processed long, detected long, processed_before long, detected_before long"
TOTALS = "key string, batch_id long, transactions_processed long, fraud_detected long, total_processed long, total_fraud_detected long"
PARTIAL = "key string, batch_id long, processed long, detected long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHUFFLE = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class RunningTotals(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counts: dict[int, list[int]] = {}
        for b in rows:
            for batch, n, d in zip(b["batch_id"].tolist(), b["processed"].tolist(), b["detected"].tolist()):
                c = counts.setdefault(int(batch), [0, 0])
                c[0], c[1] = c[0] + int(n), c[1] + int(d)
        held = self.open.get() if self.open.exists() else None
        batch, n, d, before_n, before_d = held if held else (min(counts), 0, 0, 0, 0)
        if min(counts) < batch:
            raise ValueError(f"rows of batch {min(counts)} after batch {batch} of {key[0]!r} was opened")
        out = []
        for b in sorted(counts):
            if b != batch:
                batch, before_n, before_d, n, d = b, before_n + n, before_d + d, 0, 0
            n, d = n + counts[b][0], d + counts[b][1]
            out.append((key[0], b, n, d, before_n + n, before_d + d))
        self.open.update((batch, n, d, before_n, before_d))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in TOTALS.split(", ")])

    def close(self) -> None:
        pass


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: pd.DataFrame | None = None
    for b in batches:
        s = b.groupby(["key", "batch_id"], as_index=False, dropna=False).agg(processed=("prediction", "size"), detected=("prediction", "sum"))
        held = s if held is None else pd.concat([held, s]).groupby(["key", "batch_id"], as_index=False, dropna=False).sum()
        if len(held) > 100_000:
            yield held
            held = None
    if held is not None:
        yield held


def running_totals(scored: DataFrame, batch: str = "batch_id", prediction: str = "prediction", key: str | None = None) -> DataFrame:
    """Streaming totals of ``scored`` for every batch that a micro-batch adds
    to, by ``key`` (default: one for the stream). Batches of a key have to
    come in order, as ``row_stream`` gives them."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("")) if key else F.lit("all")
    rows = scored.select(k.alias("key"), F.col(batch).cast("long").alias("batch_id"), F.coalesce(F.col(prediction).cast("long"), F.lit(0)).alias("prediction"))
    partial = rows.mapInPandas(_partial, PARTIAL)
    return partial.groupBy("key").transformWithStateInPandas(RunningTotals(), outputStructType=TOTALS, outputMode="Update", timeMode="None")


def write_epochs(path: str):
    """``foreachBatch`` sink: a folder for each micro-batch, overwritten by a replay."""
    def write(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return write


def start_totals(totals: DataFrame, path: str, checkpoint: str, sink=None, partitions: int | None = None):
    """Starts the query; the state store's provider is set for it alone, and so
    is the number of its ``partitions``: every micro-batch opens and commits
    each of them, so totals of few keys want few (one key has one anyway)."""
    conf = totals.sparkSession.conf
    settings = {PROVIDER: ROCKS, **({SHUFFLE: str(partitions)} if partitions else {})}
    before = {name: conf.get(name, None) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)  # the query keeps the settings it starts with
    try:
        return (totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                .foreachBatch(sink or write_epochs(path)).start())
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The latest report of each batch."""
    names = [c.split()[0] for c in TOTALS.split(", ")]
    rows = spark.read.option("basePath", path).parquet(path)
    last = F.max_by(F.struct(*names[2:]), "epoch").alias("r")
    return rows.groupBy("key", "batch_id").agg(last).select("key", "batch_id", "r.*")

