"""The similarity graph across micro-batches.

A row is joined with the ``band`` rows before and after it, so a graph of one
micro-batch lacks the edges over its ends. ``GraphTail`` carries the last rows
of the stream from one micro-batch to the next:

* edges: the tail's last ``band`` rows and the new ones are paired, and the
  pairs whose later row is new are the edges that this micro-batch adds;
* features after ``hops`` rounds of propagation depend on rows up to
  ``hops * band`` places away and, through their degrees, one band further. A
  row is ready once that many rows follow it, or at the end of the stream;
  then it is given out with the features it has in the graph of all rows.

The state is a table of at most 2 * band * (hops + 1) rows, one folder for
each micro-batch. Micro-batch n reads the folder of n - 1 and overwrites its
own, so a replay gives the same rows and edges again. Micro-batches have to
come in the order of the rows (``row_stream``, or files cut along the order).
The work on a micro-batch is distributed; only the tail is of a fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import banded_pairs, propagate, symmetric_edges
from ..operators.position import with_position
from ..session import materialize
from ..sources.files import names_like, path_exists

PLACED_ROWS = 1 << 15  # of a window, in one task of its sort
READY = "_given"  # state column: the row has been given out


@dataclass
class GraphTail:
    root: str                             # folder of the state, shared
    features: list[str] = field(default_factory=list)
    hops: int = 3                         # 0: edges only
    band: int = 19
    time_window: float = 3600.0
    amount_window: float = 100.0
    order_by: tuple[str, ...] = ("Time", "id")
    key: str = "id"
    time_col: str = "Time"
    amount_col: str = "Amount"

    @property
    def reach(self) -> int:
        """Places that a ready row's features depend on, to either side."""
        return self.band * (self.hops + 1) if self.hops else 0

    def _path(self, batch_id: int) -> str:
        return f"{self.root.rstrip('/')}/tail-{int(batch_id)}"

    def latest(self, spark: SparkSession) -> int:
        """Number of the last micro-batch that has left its state; -1 for none."""
        return max((int(n.rsplit("-", 1)[1]) for n in names_like(spark, f"{self.root.rstrip('/')}/tail-*")), default=-1)

    def _window(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Tail and new rows with their places ``_i`` in the window."""
        spark, new = batch.sparkSession, batch.withColumn(READY, F.lit(False)).withColumn("_new", F.lit(True))
        before = self._path(batch_id - 1)
        if batch_id > 0 and path_exists(spark, before):
            new = spark.read.parquet(before).withColumn("_new", F.lit(False)).unionByName(new)
        new = new.persist()
        try:  # tasks by the rows of the window, most of them a few thousand
            return with_position(new, [*self.order_by], "_i", -(-max(new.count(), 1) // PLACED_ROWS))
        finally:
            new.unpersist()

    def _pairs(self, window: DataFrame) -> DataFrame:
        return banded_pairs(window, self.key, self.time_col, self.amount_col, self.band, self.time_window, self.amount_window)

    def _keep(self, window: DataFrame, batch_id: int, n: int, given: int) -> None:
        """Rows that later ones may need: a band, and ``reach`` rows before
        the first that is not given out."""
        first = max(min(n - self.band, given - self.reach), 0)
        out = window.where(F.col("_i") >= first).withColumn(READY, F.col("_i") < given).drop("_i", "_new")
        out.coalesce(1).write.mode("overwrite").parquet(self._path(batch_id))  # at most 2 * reach rows

    def edges(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """(src, dst) of the forward edges that this micro-batch adds."""
        window = self._window(batch.select(*dict.fromkeys([self.key, *self.order_by, self.time_col, self.amount_col])), batch_id)
        n, old = window.agg(F.count(F.lit(1)), F.count(F.when(~F.col("_new"), 1))).first()
        self._keep(window, batch_id, n, n)
        return self._pairs(window).where(F.col("j") >= old).select("src", "dst")

    def advance(self, batch: DataFrame, batch_id: int, last: bool = False) -> tuple[DataFrame, DataFrame]:
        """(ready rows with the columns of ``batch``; their key and propagated
        features). ``last`` also gives out the rows that nothing follows."""
        window = self._window(batch, batch_id)
        n, given = window.agg(F.count(F.lit(1)), F.count(F.when(F.col(READY), 1))).first()
        ready = n if last else max(n - self.reach, given)
        edges = symmetric_edges(materialize(self._pairs(window), "tail-edges"), window, self.key, places=True)
        h = propagate(window, edges, self.features, hops=self.hops, key=self.key, band=self.band)
        if not last:
            self._keep(window, batch_id, n, ready)
        rows = window.where((F.col("_i") >= given) & (F.col("_i") < ready)).drop(READY, "_i", "_new")
        return rows, rows.select(self.key).join(h, self.key)


def edges_sink(tail: GraphTail, path: str):
    """``foreachBatch`` sink of the edges, a folder for each micro-batch."""
    def write(df: DataFrame, batch_id: int) -> None:
        tail.edges(df, batch_id).write.mode("overwrite").parquet(f"{path}/epoch={batch_id}")
    return write


def features_sink(tail: GraphTail, path: str):
    """``foreachBatch`` sink of the ready rows' propagated features."""
    def write(df: DataFrame, batch_id: int, last: bool = False) -> None:
        _, h = tail.advance(df, batch_id, last)
        h.write.mode("overwrite").parquet(f"{path}/epoch={batch_id}")
    return write


def flush(spark: SparkSession, tail: GraphTail, process, schema) -> None:
    """At the end of the stream: one more batch without rows, which gives out
    what was held back. It leaves the state alone: repeated, it gives the same,
    and if the stream goes on, its next batch overwrites this one."""
    process(spark.createDataFrame([], schema), tail.latest(spark) + 1, last=True)
