"""Global row positions and running totals without a single-partition window.

``row_number() OVER (ORDER BY …)`` plans an Exchange SinglePartition: the
whole table in one task. Instead:

1. range-partition on the (total) order and sort within partitions;
2. stamp each row with its partition id and ``monotonically_increasing_id``
   and write the stamped rows as a Parquet table under the cluster's
   checkpoint folder (the stamps must not change on re-evaluation, and an
   executor loss must not lose them; the stamps are columns, so the file
   order of the table does not matter, and the data is computed once);
3. count rows per partition (one row per partition → a proven small
   table), turn the counts into offsets, and broadcast them back.

A composite order with a unique tie-breaker (e.g. ``Time, id``) lets the
range partitioner split a hot value across partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, materialize

_PID, _MID = "_pos_pid", "_pos_mid"


def _order_cols(order_by) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def row_parts(df: DataFrame, rows: int) -> int:
    """Number of partitions that hold at most ``rows`` rows on average, and at least the session's."""
    return max(default_parallelism(df.sparkSession), -(-df.count() // rows))


def sorted_stamped(df: DataFrame, order_by, num_partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted and stamped copy of ``df``, written once
    to the shared checkpoint folder and read back."""
    spark = df.sparkSession
    n = num_partitions or default_parallelism(spark)
    cols = _order_cols(order_by)
    s = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    s = s.withColumn(_PID, F.spark_partition_id()).withColumn(_MID, F.monotonically_increasing_id())
    return materialize(s, "stamped")


def _offsets(stamped: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per-partition totals turned into exclusive prefix sums (tiny table)."""
    aggs = [F.min(_MID).alias("_m0"), F.count(F.lit(1)).alias("_cnt")]
    aggs += [F.sum(v).alias(f"_tot_{k}") for k, v in sums.items()]
    part = stamped.groupBy(_PID).agg(*aggs)
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(_PID), F.col("_m0"), F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off_cnt")]
    cols += [F.coalesce(F.sum(f"_tot_{k}").over(w), F.lit(0)).alias(f"_off_{k}") for k in sums]
    # at most one row per range partition: a proven bound for the broadcast
    return F.broadcast(part.select(*cols))


def with_position(df: DataFrame, order_by, name: str = "pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Adds the 0-based position of each row in the total order ``order_by``."""
    s = sorted_stamped(df, order_by, num_partitions)
    out = s.join(_offsets(s, {}), _PID)
    out = out.withColumn(name, F.col("_off_cnt") + F.col(_MID) - F.col("_m0"))
    return out.drop(_PID, _MID, "_m0", "_off_cnt")


def running_sums(df: DataFrame, order_by, sums: dict[str, Column | str], inclusive: bool = True,
                 num_partitions: int | None = None) -> DataFrame:
    """Adds ``name = sum(expr)`` over all rows up to this one in ``order_by``
    (``inclusive=False``: strictly before it)."""
    sums = {k: (F.col(v) if isinstance(v, str) else v) for k, v in sums.items()}
    base = df.withColumns({f"_v_{k}": v for k, v in sums.items()})
    s = sorted_stamped(base, order_by, num_partitions)
    offs = _offsets(s, {k: F.col(f"_v_{k}") for k in sums})
    end = 0 if inclusive else -1
    # within one range partition (bounded by the partitioning, not by a key)
    w = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, end)
    local = s.withColumns({f"_loc_{k}": F.coalesce(F.sum(f"_v_{k}").over(w), F.lit(0)) for k in sums})
    out = local.join(offs, _PID)
    out = out.withColumns({k: F.col(f"_off_{k}") + F.col(f"_loc_{k}") for k in sums})
    drop = [_PID, _MID, "_m0", "_off_cnt"] + [f"_{p}_{k}" for k in sums for p in ("v", "loc", "off")]
    return out.drop(*drop)


def row_batches(df: DataFrame, size: int, order_by=("Time", "id"), max_batches: int | None = None,
                pos: str = "pos") -> DataFrame:
    """Fixed-size batches in order: ``batch_id = pos div size``; the last
    batch may be short; ``max_batches`` keeps the first batches only."""
    out = with_position(df, list(order_by), pos)
    out = out.withColumn("batch_id", F.floor(F.col(pos) / F.lit(size)).cast("long"))
    if max_batches is not None:
        out = out.where(F.col("batch_id") < max_batches)
    return out


def head_rows(df: DataFrame, n: int, order_by=("Time", "id")) -> DataFrame:
    """First n rows in order (TakeOrderedAndProject: per-partition top-n)."""
    return df.orderBy(*_order_cols(order_by)).limit(n)


def page(df: DataFrame, start: int, size: int, order_by=("Time", "id")) -> DataFrame:
    """Skip ``start`` rows then take ``size`` (offset before limit). Only the
    order columns are positioned; they give the page's first and last key,
    and the wide rows between them are read by a filter and sorted, without a
    shuffle of the table. Rows of one key stand in any order."""
    cols = _order_cols(order_by)
    keys = [f"_k{i}" for i in range(len(cols))]
    narrow = df.select(*[c.alias(k) for c, k in zip(cols, keys)])
    at = materialize(with_position(narrow, keys, "_page_pos"), "page-keys")
    ends = {r["_page_pos"]: r["_key"] for r in at.where(F.col("_page_pos").between(start, start + size - 1)).groupBy().agg(
        F.min(F.struct("_page_pos", F.struct(*keys).alias("_key"))).alias("lo"), F.max(F.struct("_page_pos", F.struct(*keys).alias("_key"))).alias("hi"))
        .select(F.explode(F.array("lo", "hi")).alias("_e")).select("_e.*").where("_page_pos IS NOT NULL").collect()}  # two rows at most
    if not ends:
        return df.limit(0)
    kinds = narrow.schema
    first, last = (F.struct(*[F.lit(key[k]).cast(kinds[k].dataType).alias(k) for k in keys]) for key in (ends[min(ends)], ends[max(ends)]))
    before = at.where(F.struct(*keys) < first).count()  # the rows of smaller keys; the others tie with the page's first
    own = F.struct(*[c.alias(k) for c, k in zip(cols, keys)])
    return df.where((own >= first) & (own <= last)).orderBy(*cols).offset(start - before).limit(size)
