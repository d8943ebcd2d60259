"""Small shared helpers for plans: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only below this many bytes; above it the plain join
# (sort-merge / AQE) is used.
BROADCAST_MAX_BYTES = 64 << 20


def size_in_bytes(df: DataFrame) -> int:
    """Spark's own size of a plan: exact for a cached table that was run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def checked_broadcast(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Cache a derived table (typically an aggregate), run it, and mark it
    for broadcast only when it is under ``max_bytes``."""
    small = small.cache()
    small.count()
    return F.broadcast(small) if size_in_bytes(small) <= max_bytes else small


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join against a derived small table with a size-checked broadcast."""
    if on is None or isinstance(on, list) and on == []:
        return attach_params(big, small)
    return big.join(checked_broadcast(small, max_bytes), on, how)


def attach_params(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach a one-row parameter table to every row as literals: the single
    row is read once (a checked size of one) and Catalyst folds the values
    into the projection; no join is planned."""
    rows = params.take(2)
    if len(rows) != 1:
        raise ValueError(f"parameter table must have exactly one row, got {len(rows)}")
    fields = {f.name: f.dataType for f in params.schema.fields}
    return df.withColumns({k: F.lit(v).cast(fields[k]) for k, v in rows[0].asDict().items()})


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows without NULL or NaN in ``cols``, one condition a column (a single
    condition over many columns multiplies with every alias of them when the
    optimizer derives constraints)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(cond)
