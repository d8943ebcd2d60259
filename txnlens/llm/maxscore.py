"""Operator 6: exact top-k search by inner product with MaxScore.

Components are the terms of a query, vectors the documents, and a posting
holds the vectors of a shard whose component has the query component's sign.
Per shard a query's terms get score bounds. Terms of the largest bounds are
essential: vectors outside all their postings cannot reach the current k-th
score. The essential postings are traversed first, then the other terms are
probed in order of their bounds, and a vector is dropped as soon as its score
plus the bounds left is below the k-th score. Shards answer independently and
their answers are merged; the result is exact, ties go to smaller ids.

Queries meet shards in blocks: a task holds one shard of vectors and one
block of queries, both of bounded size. Vectors that are null or hold a null
or non-finite component, and rows without an id, take no part; vectors of
unequal lengths are compared as if the shorter one ended in zeros; rows
sharing a query's vec_id are not its candidates. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, QUERY_ROWS, LEAST_SHARDS = 16_384, 2_048, 12
OUT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """(vec_id, v array<long>): floor(factor * component), valid rows only."""
    ok = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
          & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long")).alias("v"))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def search_shard(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Top k of one shard for each query; ``x`` is rows by terms."""
    order = np.argsort(ids, kind="stable")
    ids, terms = ids[order], np.ascontiguousarray(x[order].T)
    if not len(ids) or not len(q_ids):
        return []
    if float(np.abs(terms).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, len(terms)) < 2 ** 31:
        terms, q = terms.astype(np.int32), q.astype(np.int32)
    hi, lo = terms.max(axis=1), terms.min(axis=1)
    by_impact = np.argsort(terms, axis=1, kind="stable")
    head, tail = by_impact[:, :4 * k], by_impact[:, -4 * k:]
    found = []
    for qid, w in zip(q_ids.tolist(), q):
        bound = np.maximum(w * hi, w * lo).astype(np.int64)
        rank = np.argsort(-bound, kind="stable")
        bound = bound[rank]
        left = np.append(np.cumsum(bound[::-1])[::-1], 0)  # bounds from a term on
        # a first k-th score, from the vectors of most impact in the leading terms
        seed = np.unique(np.concatenate([(tail if w[t] > 0 else head)[t] for t in rank[:8]]))
        seed = seed[ids[seed] != qid]
        s = w @ terms[:, seed]
        least = np.partition(s, len(s) - k)[len(s) - k] if len(s) >= k else None
        essential = len(rank) if least is None else max(1, int(np.searchsorted(-left, -int(least), side="right")))
        # traverse the essential postings
        alive, score, t = None, None, 0
        if least is not None:
            seen = np.zeros(len(ids), bool)
            for t in rank[:essential]:
                seen |= terms[t] * w[t] > 0
                if seen.all():
                    break
            alive = np.flatnonzero(seen) if not seen.all() else None
            if left[essential] >= least:
                alive = None  # the bounds let nothing be left out
        part = terms if alive is None else terms[:, alive]
        alive = np.arange(len(ids)) if alive is None else alive
        score, done = np.zeros(len(alive), terms.dtype), 0
        while done < len(rank):
            upto = min(len(rank), done + 8)
            cols = rank[done:upto]
            score = score + w[cols] @ part[cols]
            done = upto
            if least is not None and done < len(rank):
                keep = score + left[done] >= least
                if keep.sum() < 0.7 * len(keep):
                    alive, score = alive[keep], score[keep]
                    part = terms[:, alive]
        own = ids[alive] != qid
        alive, score = alive[own], score[own].astype(np.int64)
        if len(alive) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            at = score >= kth
            alive, score = alive[at], score[at]
        best = np.lexsort((ids[alive], -score))[:k]
        found += [(qid, int(ids[alive[i]]), int(score[i])) for i in best]
    return found


def _search(k: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        is_q = rows["is_query"].to_numpy(bool)
        width = max(map(len, rows["v"]), default=0)
        x, q = rows[~is_q], rows[is_q]
        found = search_shard(x["vec_id"].to_numpy(np.int64), _matrix(x["v"], width), q["vec_id"].to_numpy(np.int64), _matrix(q["v"], width), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")
    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score for quantised ``queries`` and ``vectors``."""
    n, n_q = vectors.count(), queries.count()
    shards, blocks = max(LEAST_SHARDS, -(-n // shard_rows)), max(1, -(-n_q // query_rows))
    of = lambda seed, m: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    x = vectors.select("vec_id", "v", F.lit(False).alias("is_query"), of("shard", shards).alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    q = queries.select("vec_id", "v", F.lit(True).alias("is_query"),
                       F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), of("block", blocks).alias("block"))
    q = q.select(*x.columns)
    found = x.unionByName(q).groupBy("shard", "block").applyInPandas(_search(k), OUT)
    # merge: Spark keeps k rows a query in each task before it moves them
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
