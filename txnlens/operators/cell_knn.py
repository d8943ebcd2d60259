"""k nearest neighbours inside cells: the last step of the kNN joins.

Queries and candidates of a cell are brought together by one shuffle, sorted
so that a cell's queries come first; then its candidates stream past them in
Arrow batches, and of every query only the k nearest met so far are held. No
pair is written or shuffled: what leaves a task are k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLACK = 1e-7
PAIRS = 1 << 20       # distances held at once
CANDIDATES = 1 << 12  # of a cell, met by its queries at once


class _Cell:
    """The queries of one cell and the nearest candidates met so far."""

    def __init__(self, k: int):
        self.k, self.parts, self.waiting, self.n_waiting = k, [], [], 0
        self.best = None  # (query's place, squared distance, candidate)

    def ask(self, keys, x, theta) -> None:
        self.parts.append((keys, x, theta))

    def meet(self, keys, x) -> None:
        self.waiting.append((keys, x))
        self.n_waiting += len(keys)
        if self.n_waiting >= CANDIDATES:
            self._flush()

    def _flush(self) -> None:
        if not self.waiting or not self.parts:
            self.waiting, self.n_waiting = [], 0
            return
        if len(self.parts) > 1:
            self.parts = [tuple(np.concatenate(c) for c in zip(*self.parts))]
        keys, x, theta = self.parts[0]
        with_keys, with_x = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        step, found = max(1, PAIRS // len(with_keys)), [] if self.best is None else [self.best]
        for lo in range(0, len(keys), step):
            q, own = x[lo:lo + step], keys[lo:lo + step]
            d2 = np.zeros((len(q), len(with_x)))
            for j in range(x.shape[1]):
                diff = q[:, j, None] - with_x[None, :, j]
                d2 += diff * diff
            near = np.sqrt(d2) <= (theta[lo:lo + step] * (1 + SLACK) + SLACK)[:, None]
            near &= own[:, None] != with_keys[None, :]
            d2[~near] = np.inf
            if d2.shape[1] > self.k:
                near &= d2 <= np.partition(d2, self.k - 1, axis=1)[:, self.k - 1, None]  # with all ties
            row, col = np.nonzero(near)
            found.append((row + lo, d2[row, col], with_keys[col]))
        self.best = self._first(*(np.concatenate(c) for c in zip(*found)))

    def _first(self, row, d2, key):
        order = np.lexsort((key, d2, row))
        row, d2, key = row[order], d2[order], key[order]
        new = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, int)
        rank = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))
        keep = rank < self.k
        return row[keep], d2[keep], key[keep]

    def end(self):
        """(query, candidate, squared distance) of the nearest ones."""
        self._flush()
        if self.best is None:
            return None
        row, d2, key = self.best
        return self.parts[0][0][row], key, d2


def _nearest(features: list[str], k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, cell, out, held = None, None, [], 0

        def rows():
            q, x, d2 = (np.concatenate(c) for c in zip(*out))
            return pd.DataFrame({"_q": q, "_x": x, "_d2": d2})
        for b in batches:
            names, asks = b["cell"].to_numpy(), b["_asks"].to_numpy()
            keys, theta, x = b["_key"].to_numpy(), b["_theta"].to_numpy(dtype=float), b[features].to_numpy(dtype=float)
            cuts = np.flatnonzero((names[1:] != names[:-1]) | (asks[1:] != asks[:-1])) + 1 if len(b) else []
            for lo, hi in zip([0, *cuts], [*cuts, len(b)]):
                if lo == hi:
                    continue
                if cell is None or names[lo] != now:
                    done = cell.end() if cell else None
                    if done:
                        out.append(done)
                        held += len(done[0])
                    now, cell = names[lo], _Cell(k)
                    if held >= 10_000:
                        yield rows()
                        out, held = [], 0
                if asks[lo]:
                    cell.ask(keys[lo:hi], x[lo:hi], theta[lo:hi])
                else:
                    cell.meet(keys[lo:hi], x[lo:hi])
        done = cell.end() if cell else None
        if done:
            out.append(done)
        if out:
            yield rows()
    return run


def nearest_in_cells(asked: DataFrame, met: DataFrame, features: list[str], k: int) -> DataFrame:
    """(_q, _x, _d2, nn_rank): the k nearest candidates of every query key, no
    farther than the query's theta; ties go to the lower key. ``asked`` has
    (cell, _q, theta, features), ``met`` (cell, _x, features). A NULL key equals
    and differs from nothing, so it takes no part."""
    kind = asked.schema["_q"].dataType
    one = asked.where(F.col("_q").isNotNull()).select("cell", F.lit(True).alias("_asks"), F.col("_q").alias("_key"),
                                                      F.col("theta").cast("double").alias("_theta"), *features)
    other = met.where(F.col("_x").isNotNull()).select("cell", F.lit(False).alias("_asks"), F.col("_x").alias("_key"),
                                                      F.lit(0.0).alias("_theta"), *features)
    rows = one.unionByName(other).repartition("cell").sortWithinPartitions("cell", F.col("_asks").desc())
    schema = T.StructType([T.StructField("_q", kind), T.StructField("_x", kind), T.StructField("_d2", T.DoubleType())])
    near = rows.mapInPandas(_nearest(features, k), schema)
    w = Window.partitionBy("_q").orderBy("_d2", "_x")  # k rows of each row of a key
    return near.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k).select("_q", "_x", "_d2", "nn_rank")
