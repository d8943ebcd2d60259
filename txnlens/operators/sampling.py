"""Sampling and splitting with hash-derived randomness.

``md5(key ‖ '-' ‖ seed)`` gives every row a reproducible pseudo-random
order that does not depend on partitioning, so results are the same on
any cluster size and on re-execution after an executor loss.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach_params, join_small
from .position import with_position

HEX_STEP = 3  # hex digits told apart by one counting pass: 4096 buckets
FETCH_ROWS = 10_000  # rows of one hash prefix that may be fetched and sorted


def hash_order(key: str = "id", seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def hash_uniform(key: str = "id", seed: int = 42) -> Column:
    """Uniform double in [0, 1) from the first 52 bits of the md5 hash."""
    h = F.conv(F.substring(hash_order(key, seed), 1, 13), 16, 10).cast("double")
    return h / F.lit(float(1 << 52))


def sample_exact(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """Exactly min(n, rows) rows, seeded (per-partition top-n, then merge)."""
    return df.orderBy(hash_order(key, seed), F.col(key)).limit(n)


def stratum_positions(df: DataFrame, label: str | None, seed: int = 42, key: str = "id") -> DataFrame:
    """Adds ``_rank`` (0-based position inside the stratum in hash order)
    and ``_stratum_n``. Distributed: a range sort on (label, hash, key) and
    the per-stratum start/count table (one row per stratum, size-checked)."""
    lab = [F.col(label)] if label else []
    d = df.withColumn("_h", hash_order(key, seed))
    pos = with_position(d, [*lab, F.col("_h"), F.col(key)], "_gpos")
    if label:
        starts = pos.groupBy(F.col(label).alias("_lab")).agg(F.min("_gpos").alias("_start"), F.count(F.lit(1)).alias("_stratum_n"))
        pos = join_small(pos, starts, pos[label].eqNullSafe(starts["_lab"])).drop("_lab")
    else:
        starts = pos.agg(F.min("_gpos").alias("_start"), F.count(F.lit(1)).alias("_stratum_n"))
        pos = attach_params(pos, starts)
    return pos.withColumn("_rank", F.col("_gpos") - F.col("_start")).drop("_gpos", "_start", "_h")


def hash_cuts(df: DataFrame, label: str | None, frac: float, seed: int, key: str) -> list[tuple]:
    """Per stratum (label value, hash, key): the first row in hash order that
    is no longer among the first round(frac * n) ones; hash None if all are.

    Found by counting rows by a prefix of the hash and going down into the
    prefix that holds the rank: each pass is a partial aggregate of at most
    4096 rows a stratum, and only the rows of one short prefix are fetched."""
    lab = F.col(label) if label else F.lit(None).cast("string")
    rows = df.select(lab.alias("_lab"), hash_order(key, seed).alias("_h"), F.col(key).alias("_k"))
    open_ = {None: ("", None, None)}  # label -> (prefix, rank in it, rows in it)
    cuts, first = {}, True
    while open_:
        size = len(next(iter(open_.values()))[0]) + HEX_STEP
        part = rows
        if not first:
            cond = F.lit(False)
            for v, (prefix, _, _) in open_.items():
                cond = cond | (F.col("_lab").eqNullSafe(F.lit(v)) & F.col("_h").startswith(prefix))
            part = rows.where(cond)
        counts: dict = {}
        for r in part.groupBy("_lab", F.substring("_h", 1, size).alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect():
            counts.setdefault(r["_lab"], []).append((r["_p"] or "", r["_n"]))
        state = open_ if not first else {v: ("", None, None) for v in counts}
        open_, fetch = {}, {}
        for v, (_, rank, _) in state.items():
            if rank is None:
                n = sum(c for _, c in counts[v])
                rank = int(math.floor(frac * n + 0.5))
                if rank >= n:
                    cuts[v] = (None, None)
                    continue
            for prefix, c in sorted(counts[v]):
                if rank < c:
                    (fetch if c <= FETCH_ROWS or size >= 32 else open_)[v] = (prefix, rank, c)
                    break
                rank -= c
        first = False
        for v, (prefix, rank, _) in fetch.items():
            got = rows.where(F.col("_lab").eqNullSafe(F.lit(v)) & (F.coalesce(F.col("_h"), F.lit("")).startswith(prefix)))
            at = got.orderBy(F.col("_h").asc_nulls_first(), "_k").limit(rank + 1).collect()[rank]
            cuts[v] = (at["_h"], at["_k"])
    return [(v, *c) for v, c in cuts.items()]


def _apply_cuts(df: DataFrame, cuts: list[tuple], label: str | None, seed: int, key: str, col: str) -> DataFrame:
    """Label rows by comparing their hash with the cut of their stratum."""
    h, test = hash_order(key, seed), F.lit(False)
    for v, ch, ck in cuts:
        mine = F.col(label).eqNullSafe(F.lit(v)) if label else F.lit(True)
        before = F.lit(True) if ch is None else (h < F.lit(ch)) | ((h == F.lit(ch)) & (F.col(key) < F.lit(ck)))
        test = F.when(mine, F.coalesce(before, F.lit(False))).otherwise(test)
    return df.withColumn(col, F.when(test, F.lit("test")).otherwise(F.lit("train")))


def stratified_split(df: DataFrame, test_frac: float = 0.2, label: str | None = "Class",
                     seed: int = 42, key: str = "id", col: str = "split") -> DataFrame:
    """Exact per-stratum split: the first round(test_frac·n_c) rows of each
    stratum in hash order are 'test', the rest 'train'; a NULL label is a
    stratum of its own. Labelling is map-only and depends on the key alone,
    so rows that share a key are never parted (the cut then falls before
    them); use ``grouped_split`` to cut by the number of distinct keys."""
    return _apply_cuts(df, hash_cuts(df, label, test_frac, seed, key), label, seed, key, col)


def grouped_split(df: DataFrame, group: str, test_frac: float = 0.2, label: str | None = "Class",
                  seed: int = 42, col: str = "split") -> DataFrame:
    """Split by distinct values of ``group``: round(test_frac·groups) of each
    stratum's groups are 'test' with all their rows. The label must be the
    same in all rows of a group."""
    names = [group, *([label] if label else [])]
    groups = df.select(*names).distinct().persist(StorageLevel.MEMORY_AND_DISK)  # read by each pass of the cuts
    try:
        if label and groups.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            raise ValueError(f"{label} differs inside a {group}: split with label=None")
        cuts = hash_cuts(groups, label, test_frac, seed, group)
    finally:
        groups.unpersist()
    return _apply_cuts(df, cuts, label, seed, group, col)


def random_split(df: DataFrame, test_frac: float = 0.2, seed: int = 42, key: str = "id",
                 col: str = "split") -> DataFrame:
    """Plain split (a single stratum)."""
    return stratified_split(df, test_frac, None, seed, key, col)


def stratified_folds(df: DataFrame, k: int = 3, label: str | None = "Class", seed: int = 42,
                     key: str = "id", col: str = "fold") -> DataFrame:
    """Stratified k-fold assignment: fold = rank in stratum mod k."""
    p = stratum_positions(df, label, seed, key)
    return p.withColumn(col, F.pmod(F.col("_rank"), F.lit(k)).cast("int")).drop("_rank", "_stratum_n")
