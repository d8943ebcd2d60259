"""Transaction views over the given parquet tables.

``txn``    : events → (id, Time, Amount, Class)
``txn_ml`` : txn + all components of a vector (V1..Vn) taken from ``embeddings``
             by ``vec_id = id % count(embeddings)``; Class = (label == 0).

Both are lazy DataFrames: Catalyst prunes the scan to the columns used and
pushes filters into the parquet reader.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..session import default_parallelism, materialize

ORACLE_WIDTH = 64  # components of the given vectors, for SQL texts; Spark takes the width from the data
VECTOR_BROADCAST_BYTES = 32 << 20
ORIGIN = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def txn_from_events(events: DataFrame, keep_ts: bool = False) -> DataFrame:
    """Seconds since the origin as ``Time`` (time-zone independent)."""
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{ORIGIN}', ts)")
    cols = [
        F.col("event_id").alias("id"),
        (micros / F.lit(1e6)).alias("Time"),
        nan_to_null(F.col("value")).alias("Amount"),
        (F.col("event_type") == F.lit("error")).cast("int").alias("Class"),
    ]
    return events.select(*cols, *(["ts"] if keep_ts else []))


def txn(spark: SparkSession, sf_dir: str, keep_ts: bool = False) -> DataFrame:
    return txn_from_events(table(spark, sf_dir, "events"), keep_ts)


def vector_width(emb: DataFrame) -> int:
    return emb.agg(F.max(F.size("embedding"))).first()[0] or 0


def vectors(spark: SparkSession, sf_dir: str, n: int | None = None) -> DataFrame:
    """(vec_id, V1..Vn, vec_label) from the embeddings table; by default all
    components (NULL where a vector is shorter)."""
    emb = table(spark, sf_dir, "embeddings")
    n = vector_width(emb) if n is None else n
    cols = [nan_to_null(F.get("embedding", F.lit(i)).cast("double")).alias(f"V{i + 1}") for i in range(n)]
    return emb.select(F.col("vec_id"), *cols, F.col("label").alias("vec_label"))


def txn_ml(spark: SparkSession, sf_dir: str, n: int | None = None) -> DataFrame:
    """Every txn row with a feature vector; Class = 1 for vector label 0.

    The number of vectors is one scalar (a parquet count, answered from
    file metadata). It is also the size check of the join: the vector table
    is broadcast (events stream through without a shuffle) only while its
    rows of doubles take at most ``VECTOR_BROADCAST_BYTES``; above that it is
    a plain shuffled equi-join.
    """
    return _txn_ml(spark, sf_dir, n, kept=False)[0]


def txn_ml_kept(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """``txn_ml`` for a job that reads it many times: while the vectors are
    broadcast, the narrow events are spread over the tasks and kept, and each
    reader attaches the vectors by that join, so the wide rows are neither
    shuffled nor held. Also whether it is so."""
    return _txn_ml(spark, sf_dir, None, kept=True)


def txn_ml_keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame] | None:
    """``txn_ml`` without its vectors, with ``vec_row`` in their place, and the
    vectors by ``vec_row``, marked for broadcast: attached later, they give the
    rows of ``txn_ml``. None if the vectors are too large to be broadcast."""
    vec = vectors(spark, sf_dir)
    n_vec = table(spark, sf_dir, "embeddings").count()
    if n_vec * 8 * len(vec.columns) + n_vec * 8 > VECTOR_BROADCAST_BYTES:
        return None
    vec = materialize(vec.withColumn("vec_row", F.monotonically_increasing_id()), "vectors")  # numbers must not change
    keyed = txn(spark, sf_dir).drop("Class").withColumn("vec_key", F.pmod(F.col("id"), F.lit(max(n_vec, 1))))
    rows = keyed.repartition(default_parallelism(spark)).join(F.broadcast(vec.select("vec_id", "vec_label", "vec_row")), F.col("vec_key") == F.col("vec_id"), "inner")
    rows = rows.select("id", "vec_id", "Time", "Amount", (F.col("vec_label") == 0).cast("int").alias("Class"), "vec_row")
    return rows, F.broadcast(vec.drop("vec_id", "vec_label"))


def _txn_ml(spark: SparkSession, sf_dir: str, n: int | None, kept: bool) -> tuple[DataFrame, bool]:
    t = txn(spark, sf_dir).drop("Class")
    vec = vectors(spark, sf_dir, n)
    n_vec = table(spark, sf_dir, "embeddings").count()
    keyed = t.withColumn("vec_key", F.pmod(F.col("id"), F.lit(max(n_vec, 1))))
    names = [c for c in vec.columns if c not in ("vec_id", "vec_label")]
    small = n_vec * 8 * (len(names) + 3) <= VECTOR_BROADCAST_BYTES
    if kept and small:
        keyed = keyed.repartition(default_parallelism(spark)).persist(StorageLevel.MEMORY_AND_DISK)
    side = F.broadcast(vec) if small else vec
    out = keyed.join(side, keyed["vec_key"] == vec["vec_id"], "inner")
    return out.select("id", "vec_id", "Time", "Amount",
                      (F.col("vec_label") == 0).cast("int").alias("Class"),
                      *names), kept and small


# ---- the same views as DuckDB SQL (oracle side) --------------------------

TXN_SQL = (
    "SELECT event_id AS id, (epoch_us(ts) - 1704067200000000) / 1e6 AS Time, "
    "value AS Amount, CAST(event_type = 'error' AS INTEGER) AS Class FROM events"
)


def txn_ml_sql(n: int = ORACLE_WIDTH) -> str:
    vcols = ", ".join(f"CAST(e.embedding[{i + 1}] AS DOUBLE) AS V{i + 1}" for i in range(n))
    return (
        "SELECT t.id, e.vec_id, t.Time, t.Amount, CAST(e.label = 0 AS INTEGER) AS Class, "
        f"{vcols} FROM (SELECT x.*, x.id % k.n AS vkey FROM txn x "
        "CROSS JOIN (SELECT count(*) AS n FROM embeddings) k) t "
        "JOIN embeddings e ON e.vec_id = t.vkey"
    )


def with_views(body: str, ml: bool = False, n: int = ORACLE_WIDTH) -> str:
    """Prefix a DuckDB query with the txn (and txn_ml) CTEs."""
    ctes = [f"txn AS ({TXN_SQL})"]
    if ml:
        ctes.append(f"txn_ml AS ({txn_ml_sql(n)})")
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[5:]
    return "WITH " + ", ".join(ctes) + " " + body


def txn_between(spark: SparkSession, sf_dir: str, start_s: float, end_s: float, keep_ts: bool = False) -> DataFrame:
    """txn rows with start_s <= Time < end_s, filtered on the raw ``ts``
    column so the predicate reaches the parquet reader (row-group pruning);
    a filter on the derived ``Time`` column cannot be pushed down."""
    lo = F.expr(f"TIMESTAMP_NTZ'{ORIGIN}' + make_dt_interval(0, 0, 0, {float(start_s)!r})")
    hi = F.expr(f"TIMESTAMP_NTZ'{ORIGIN}' + make_dt_interval(0, 0, 0, {float(end_s)!r})")
    ev = table(spark, sf_dir, "events").where((F.col("ts") >= lo) & (F.col("ts") < hi))
    return txn_from_events(ev, keep_ts)
