"""Adaptive search of classifier settings.

Proposals come from a ratio of Parzen densities: the settings tried so far
are parted into the best share and the rest, each part gives a density (a
share for the family, for each number a mixture of one uniform and a truncated
normal around every setting), and of some candidates drawn from the density of
the best the one with the largest ratio is tried next.

Poor settings are stopped by successive halving: a setting is first judged on
a hash sample of the rows, and goes on to the next, larger sample (which holds
the smaller one) when it is among the best 1/eta of all settings judged on its
own; only settings judged on all rows can win. Settings of a round, and their
folds, are fitted side by side. A round depends on the finished rounds alone, so the search
does not depend on timing or partitions.

Defined results: settings still running count among the rest; equal values are
ordered by trial number; a sample without both labels in a fold has no value
there, and a setting without any value ranks last.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENSEMBLE_FEATURES
from .cell_forest import FoldCells
from .ensemble import fit_auc, fits_at_once, forest_cells

SAMPLE_BITS = 1 << 40


@dataclass(frozen=True)
class Number:
    name: str
    lo: float
    hi: float
    log: bool = False
    whole: bool = False

    def _ends(self) -> tuple[float, float]:
        half = 0.5 if self.whole else 0.0
        lo, hi = self.lo - half, self.hi + half
        return (math.log(lo), math.log(hi)) if self.log else (lo, hi)

    def unit(self, x: float) -> float:
        lo, hi = self._ends()
        return ((math.log(x) if self.log else x) - lo) / (hi - lo)

    def value(self, u: float) -> float | int:
        lo, hi = self._ends()
        x = lo + u * (hi - lo)
        x = math.exp(x) if self.log else x
        x = min(max(round(x) if self.whole else x, self.lo), self.hi)
        return int(x) if self.whole else x


Space = dict[str, tuple[Number, ...]]  # numbers of each family
ENSEMBLE_SPACE: Space = {"rf": (Number("n_estimators", 50, 200, whole=True), Number("max_depth", 3, 10, whole=True)),
                         "lr": (Number("C", 0.01, 10.0, log=True),)}


@dataclass
class Trial:
    trial: int
    setting: dict
    values: dict[int, float] = field(default_factory=dict)  # by rung

    def at(self, rung: int) -> tuple[float, int]:
        """Sort key: larger values first, then smaller trial numbers."""
        v = self.values.get(rung, -math.inf)
        return -(v if v == v else -math.inf), self.trial


def _bell(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


class Density:
    """Parzen density of the settings of one part."""

    def __init__(self, space: Space, settings: list[dict]):
        self.space, self.settings = space, settings
        self.of = {f: [s for s in settings if s["model"] == f] for f in space}

    def _width(self, n: int) -> float:
        return max(0.05, (n + 1) ** -0.8)

    def draw(self, rng: random.Random) -> dict:
        families = list(self.space)
        family = rng.choices(families, [len(self.of[f]) + 1 for f in families])[0]
        out = {"model": family}
        for number in self.space[family]:
            at = [number.unit(s[number.name]) for s in self.of[family]]
            i = rng.randrange(len(at) + 1)
            u = rng.random()
            if i < len(at):
                u = rng.gauss(at[i], self._width(len(at)))
                while not 0 <= u <= 1:
                    u = rng.gauss(at[i], self._width(len(at)))
            out[number.name] = number.value(u)
        return out

    def log(self, setting: dict) -> float:
        family = setting["model"]
        own = self.of[family]
        total = math.log((len(own) + 1) / (len(self.settings) + len(self.space)))
        width = self._width(len(own))
        for number in self.space[family]:
            u, p = number.unit(setting[number.name]), 1.0
            for s in own:
                c = number.unit(s[number.name])
                inside = _bell((1 - c) / width) - _bell(-c / width)
                p += math.exp(-0.5 * ((u - c) / width) ** 2) / (width * math.sqrt(2 * math.pi) * inside)
            total += math.log(p / (len(own) + 1))
        return total


def propose(trials: list[Trial], rng: random.Random, space: Space = ENSEMBLE_SPACE, startup: int = 6, share: float = 0.25,
            candidates: int = 24) -> dict:
    """The next setting; drawn evenly until ``startup`` settings have values
    on a rung. The highest such rung ranks the settings."""
    rungs = sorted({r for t in trials for r in t.values}, reverse=True)
    rung = next((r for r in rungs if sum(r in t.values for t in trials) >= startup), None)
    if rung is None:
        return Density(space, []).draw(rng)
    known = sorted((t for t in trials if rung in t.values), key=lambda t: t.at(rung))
    best = known[:math.ceil(share * len(known))]
    rest = [t.setting for t in trials if t not in best]
    good, bad = Density(space, [t.setting for t in best]), Density(space, rest)
    return max((good.draw(rng) for _ in range(candidates)), key=lambda s: good.log(s) - bad.log(s))


def promoted(trials: list[Trial], rungs: int, eta: int = 3) -> list[tuple[Trial, int]]:
    """(trial, next rung) of settings that may go on, best first."""
    out = []
    for rung in range(rungs - 2, -1, -1):
        known = sorted((t for t in trials if rung in t.values), key=lambda t: t.at(rung))
        out += [(t, rung + 1) for t in known[:math.ceil(len(known) / eta)] if rung + 1 not in t.values]
    return out


def halving_search(evaluate: Callable[[dict, int], float], rungs: int, n_trials: int = 20, seed: int = 42, parallelism: int = 4,
                   space: Space = ENSEMBLE_SPACE, eta: int = 3, **how) -> list[Trial]:
    """All trials; ``evaluate(setting, rung)`` runs in threads."""
    rng, trials = random.Random(seed), []
    with ThreadPool(parallelism) as pool:
        while True:
            jobs = promoted(trials, rungs, eta)[:parallelism]
            while len(jobs) < parallelism and len(trials) < n_trials:
                trials.append(Trial(len(trials), propose(trials, rng, space, **how)))
                jobs.append((trials[-1], 0))
            if not jobs:
                return trials
            for (t, rung), v in zip(jobs, pool.map(lambda j: evaluate(j[0].setting, j[1]), jobs)):
                t.values[rung] = v


def sample_shares(rarest: int, folds: int, rungs: int = 3, eta: int = 3, least: int = 30) -> list[float]:
    """Growing shares of the rows, the last 1; the first leaves about
    ``least`` rows of the rarest label a fold."""
    need = least * folds / max(rarest, 1)
    return sorted({min(1.0, max(float(eta) ** -k, need)) for k in range(rungs)})


def in_sample(key: str, share: float, seed: int):
    """Whether a row is in the hash sample; smaller samples lie in larger ones."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(SAMPLE_BITS)) < F.lit(int(share * SAMPLE_BITS))


def fold_sizes(df: DataFrame, fold_col: str, label: str) -> dict:
    """(rows, positive rows) of each fold."""
    return {r[0]: (r["n"], r["p"]) for r in df.groupBy(fold_col).agg(F.count("*").alias("n"), F.sum(label).alias("p")).collect()}


def fold_auc(df: DataFrame, sizes: dict, setting: dict, fold_col: str, features, label: str, seed: int, each: Callable = map,
             cells: FoldCells | None = None) -> float:
    """Mean AUC over the folds that hold both labels; ``each`` maps a fit over
    the folds; forests are grown from ``cells`` if there are any."""
    total = sum(n for n, _ in sizes.values())
    judged = [(fold, total - n) for fold, (n, p) in sorted(sizes.items())
              if 0 < p < n and 0 < sum(q for f, (_, q) in sizes.items() if f != fold) < total - n]
    if cells and setting["model"] == "rf" and judged:
        out = cells.aucs([(setting, fold) for fold, _ in judged], seed)
    else:
        out = list(each(lambda j: fit_auc(df, setting, j[1], j[0], fold_col, features, label, seed), judged))
    return sum(out) / len(out) if out else math.nan


def adaptive_search(df: DataFrame, n_trials: int = 20, fold_col: str = "fold", features=ENSEMBLE_FEATURES, label: str = "Class",
                    key: str = "id", seed: int = 42, parallelism: int = 4, space: Space = ENSEMBLE_SPACE) -> DataFrame:
    """Trial table (trial, model, n_estimators, max_depth, C, share, auc): a
    row for every sample on which a setting was judged."""
    data = df.where(F.col(label).isNotNull()).select(F.col(key), F.col(fold_col), F.col(label).cast("double").alias(label), *features)
    data, cells = data.persist(StorageLevel.MEMORY_AND_DISK), []
    try:
        labels = data.groupBy(label).count().collect()  # a row a label
        folds = data.agg(F.countDistinct(fold_col)).first()[0]
        shares = sample_shares(min((r["count"] for r in labels), default=0), folds)
        n, samples = sum(r["count"] for r in labels), []
        for share in shares if len(labels) > 1 else ():
            part = data if share >= 1 else data.where(in_sample(key, share, seed))
            sizes = fold_sizes(part, fold_col, label)
            samples.append((part, sizes))
            cells.append(forest_cells(part, n, sorted(f for f in sizes if f is not None), fold_col, features, label) if "rf" in space else None)
        with ThreadPool(fits_at_once(df.sparkSession, n, parallelism)) as fits:
            def evaluate(setting: dict, rung: int) -> float:
                return fold_auc(*samples[rung], setting, fold_col, features, label, seed, lambda run, of: fits.map(run, of, chunksize=1), cells[rung])

            trials = halving_search(evaluate, len(shares), n_trials, seed, parallelism, space) if len(labels) > 1 else []
    finally:
        data.unpersist()
        for c in filter(None, cells):
            c.release()
    rows = [(t.trial, t.setting["model"], t.setting.get("n_estimators"), t.setting.get("max_depth"), t.setting.get("C"), shares[r], v if v == v else None)
            for t in trials for r, v in sorted(t.values.items())]
    return df.sparkSession.createDataFrame(rows, "trial int, model string, n_estimators int, max_depth int, C double, share double, auc double")
