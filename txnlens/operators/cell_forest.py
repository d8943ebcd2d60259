"""Random forests grown from counted cells, judged on folds.

A histogram forest sees of a row only its bins (at most BINS a feature), its
label and how often the bootstrap drew it. Rows of equal bins and label are
therefore one cell, and the draws of a cell of w rows, Poisson(1) each, are one
draw of Poisson(w): trees grown from the cells have the distribution of trees
grown from the rows, and no row is kept, drawn for or walked again. A forest
over n rows kept a count and a node for each of n rows and its trees.

One pass gives the thresholds (quantiles of the training rows of each fold), one
the cells of each fold: their number is at most the product of the bins,
whatever the rows, and far less where features depend on each other; more than
CELLS_MOST are refused, and the caller takes the forest over rows. The cells
go to the tasks by a broadcast; a task grows some trees and adds up what they
say of the held-out cells, and the AUC of a forest is computed where the sums
of its tasks meet.

Trees are those of Spark's classifier: Gini gain, sqrt of the features a node,
at least one drawn row a side, leaves that are pure, without gain or at the
greatest depth, two leaves of one predicted class joined; a forest's score is the
mean of its leaves' shares. NULL and NaN features lie right of all thresholds, with
the greatest values. Draws depend on the seed, the tree and the cells alone, not on
partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
CELLS_MOST = 1 << 20  # of all folds: 16 bytes each
HELD_CELLS = 100_000  # that a task holds before it hands them on
TREES_A_TASK = 10
ACCURACY = 10_000


def _thresholds(data: DataFrame, folds: list, fold_col: str, features: list[str]) -> dict:
    """{fold: [thresholds of each feature]} of the rows outside the fold; a
    value goes left of a threshold that is not below it."""
    probs, aggs = [i / BINS for i in range(1, BINS)], []
    for k, fold in enumerate(folds):
        for i, c in enumerate(features):
            x = F.col(c).cast("double")
            x = F.when((F.col(fold_col) != F.lit(fold)) & ~F.isnan(x), x)
            aggs += [F.percentile_approx(x, probs, ACCURACY).alias(f"q{k}_{i}"), F.max(x).alias(f"m{k}_{i}")]
    r = data.agg(*aggs).first()
    return {fold: [np.array(sorted({*(r[f"q{k}_{i}"] or ())} - {r[f"m{k}_{i}"]}), dtype=float) for i in range(len(features))]
            for k, fold in enumerate(folds)}


def _merged(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(code, return_inverse=True)
    return code, np.bincount(at, weights=n).astype(np.int64)


class FoldCells:
    """Cells of the training and the held-out rows of each fold; see ``of``."""

    def __init__(self, spark, cells: dict, bins: list[int]):
        self.spark, self.folds, self.n_bins = spark, list(cells), bins
        self.cells = spark.sparkContext.broadcast(cells)

    @staticmethod
    def of(data: DataFrame, folds: list, fold_col: str, features: list[str], label: str, most: int = CELLS_MOST) -> FoldCells | None:
        """None if there are more than ``most`` cells, or labels other than 0 and 1."""
        features = list(features)
        bits = (BINS - 1).bit_length()
        if bits * len(features) + 2 > 62:
            return None
        if not data.where(F.col(label).isNull() | ~F.col(label).isin(0.0, 1.0)).isEmpty():
            return None
        cuts = _thresholds(data, folds, fold_col, features)

        def codes(b: pd.DataFrame, fold) -> np.ndarray:
            code = np.zeros(len(b), np.int64)
            for c, t in zip(features, cuts[fold]):
                x = b[c].to_numpy(dtype=float, na_value=np.nan)
                code = code << bits | np.searchsorted(t, x, side="left")
            return code << 2 | b[label].to_numpy(np.int64) << 1 | (b[fold_col] == fold).to_numpy(np.int64)

        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = {fold: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for fold in folds}

            def handed():
                return pd.concat([pd.DataFrame({"k": np.int32(k), "code": held[f][0], "n": held[f][1]}) for k, f in enumerate(folds)])
            for b in batches:
                for fold in folds:
                    code, n = _merged(codes(b, fold), np.ones(len(b)))
                    held[fold] = _merged(np.concatenate([held[fold][0], code]), np.concatenate([held[fold][1], n]))
                if sum(len(c) for c, _ in held.values()) > HELD_CELLS:
                    yield handed()
                    held = {fold: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for fold in folds}
            yield handed()
        rows = data.select(fold_col, F.col(label).cast("double").alias(label), *[F.col(c).cast("double").alias(c) for c in features])
        counts = rows.mapInPandas(counted, "k int, code long, n long").groupBy("k", "code").agg(F.sum("n").alias("n"))
        got = counts.limit(most + 1).toArrow()  # numbers of cells, not rows
        if got.num_rows > most:
            return None
        k, code, n = (got.column(c).to_numpy() for c in ("k", "code", "n"))
        cells = {}
        for i, fold in enumerate(folds):
            order = np.argsort(code[k == i])
            own, w = code[k == i][order], n[k == i][order]
            out = own & 1 == 1
            bins = np.stack([(own >> (2 + bits * (len(features) - 1 - f)) & (1 << bits) - 1).astype(np.uint8) for f in range(len(features))], axis=1)
            y = (own >> 1 & 1).astype(float)
            cells[fold] = tuple((bins[m], y[m], w[m]) for m in (~out, out))
        return FoldCells(data.sparkSession, cells, [BINS] * len(features))

    def release(self) -> None:
        self.cells.destroy()

    def aucs(self, forests: list[tuple[dict, object]], seed: int) -> list[float]:
        """AUC on the held-out rows of ``fold`` for each (setting, fold)."""
        cells, n_bins = self.cells, self.n_bins
        forests = [(int(s["n_estimators"]), int(s["max_depth"]), fold) for s, fold in forests]
        # deep forests first
        units = sorted(((i, lo, min(lo + TREES_A_TASK, trees)) for i, (trees, _, _) in enumerate(forests) for lo in range(0, trees, TREES_A_TASK)),
                       key=lambda u: -forests[u[0]][1])

        def grown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for u in b["id"]:
                    i, lo, hi = units[u]
                    trees, depth, fold = forests[i]
                    train, test = cells.value[fold]
                    votes = sum(tree_votes(train, test[0], n_bins, depth, np.random.default_rng([seed, t]), trees > 1) for t in range(lo, hi))
                    yield pd.DataFrame({"i": [i], "lo": [lo], "votes": [votes.tobytes()]})

        def judged(g: pd.DataFrame) -> pd.DataFrame:
            i = int(g["i"].iloc[0])
            _, y, w = cells.value[forests[i][2]][1]
            votes = sum(np.frombuffer(v) for v in g.sort_values("lo")["votes"])
            return pd.DataFrame({"i": [i], "auc": [weighted_auc(votes, y, w)]})
        parts = self.spark.range(0, len(units), 1, max(len(units), 1)).mapInPandas(grown, "i int, lo int, votes binary")
        found = {r["i"]: r["auc"] for r in parts.groupBy("i").applyInPandas(judged, "i int, auc double").collect()}  # a number for each forest
        return [found[i] for i in range(len(forests))]


def _gini(n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    p = pos / n
    return 2 * p * (1 - p)


def _levels(train: tuple, n_bins: list[int], depth: int, rng: np.random.Generator | None, some_features: bool) -> list[tuple]:
    """(rows, positives, leaf?, feature, cut, left child) of the nodes of each level."""
    bins, y, w = train
    c = rng.poisson(w).astype(float) if rng else w.astype(float)
    drawn = c > 0
    bins, c, cy = bins[drawn], c[drawn], (c * y)[drawn]
    node, features, out = np.zeros(len(c), np.int64), len(n_bins), []
    take = math.ceil(math.sqrt(features)) if some_features else features
    while len(c):
        k = int(node.max()) + 1
        n, pos = np.bincount(node, c, k), np.bincount(node, cy, k)
        impurity = _gini(n, pos)
        best, feature, cut = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64)
        if len(out) < depth:
            chosen = np.ones((k, features), bool) if take == features else rng.random((k, features)).argsort(axis=1).argsort(axis=1) < take
            for f in range(features):
                key = node * n_bins[f] + bins[:, f]
                left, left_pos = (np.bincount(key, v, k * n_bins[f]).reshape(k, -1).cumsum(axis=1)[:, :-1] for v in (c, cy))
                right, right_pos = n[:, None] - left, pos[:, None] - left_pos
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = impurity[:, None] - (left * _gini(left, left_pos) + right * _gini(right, right_pos)) / n[:, None]
                gain = np.where((left >= 1) & (right >= 1) & chosen[:, [f]] & (impurity > 0)[:, None], gain, -1.0)
                top = gain.argmax(axis=1)
                g = gain[np.arange(k), top]
                better = g > best
                best[better], feature[better], cut[better] = g[better], f, top[better]
        leaf = feature < 0
        first = 2 * (np.cumsum(~leaf) - 1)
        out.append((n, pos, leaf, feature, cut, first))
        stay = ~leaf[node]
        bins, c, cy, node = bins[stay], c[stay], cy[stay], node[stay]
        node = first[node] + (bins[np.arange(len(c)), feature[node]] > cut[node])
    return out


def tree_votes(train: tuple, test: np.ndarray, n_bins: list[int], depth: int, rng: np.random.Generator | None, some_features: bool = True) -> np.ndarray:
    """Share of positives in the leaf of each row of ``test`` (bins) of a tree
    grown level by level from ``train`` (bins, labels, numbers of rows), of
    which the bootstrap draws; without ``rng`` each row counts once."""
    levels = _levels(train, n_bins, depth, rng, some_features)
    votes, at, open_ = np.zeros(len(test)), np.zeros(len(test), np.int64), np.arange(len(test))
    for (n, pos, leaf, _, _, first), (n_, pos_, leaf_, *_) in zip(levels[-2::-1], levels[:0:-1]):
        # two leaves that predict the same class become one
        yes, inner = 2 * pos_ > n_, np.flatnonzero(~leaf)
        a, b = first[inner], first[inner] + 1
        leaf[inner[leaf_[a] & leaf_[b] & (yes[a] == yes[b])]] = True
    for n, pos, leaf, feature, cut, first in levels:
        ends = leaf[at]
        votes[open_[ends]] = (pos / n)[at[ends]]
        open_, at = open_[~ends], at[~ends]
        at = first[at] + (test[open_, feature[at]] > cut[at])
    return votes


def weighted_auc(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """AUC of rows counted ``w`` times, ties half."""
    values, at = np.unique(score, return_inverse=True)
    pos, neg = np.bincount(at, w * y, len(values)), np.bincount(at, w * (1 - y), len(values))
    total = pos.sum() * neg.sum()
    return float(np.sum(pos * (np.cumsum(neg) - 0.5 * neg)) / total) if total else float("nan")
