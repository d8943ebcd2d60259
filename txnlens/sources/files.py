"""File sources and sinks: transactions CSV, feature tables, JSON logs,
nested per-batch alert documents, report tables. Every reader declares its
schema (no inference pass); every sink is keyed so a replay overwrites.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..operators.monitor import flatten_cases
from ..schemas import ALERTS, BATCH_ALERT_DOC, STATS

DOCUMENT_CASES = 10_000  # cases of one nested alert document
DOCUMENTS = "fraud_alerts"  # folder of the documents of micro-batches of several batches


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path, or anything that fits the pattern, is there, in any store of Spark's."""
    fs, p = _file_system(spark, path)
    found = fs.globStatus(p)
    return bool(found) and len(found) > 0


def names_like(spark: SparkSession, pattern: str) -> list[str]:
    """Last parts of the paths that fit the pattern."""
    fs, p = _file_system(spark, pattern)
    return [f.getPath().getName() for f in (fs.globStatus(p) or [])]


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def read_transactions_csv(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """CSV with a header that names Time, V1..Vn, Amount, Class[, id] in any
    order, with any number of V columns; further columns stay text. NaN and
    empty values are NULL. Without an id column one is attached from file
    order (``monotonically_increasing_id``); write the table to Parquet once
    (``write_features``) to freeze it."""
    names = spark.read.option("header", True).csv(path).columns  # reads the header line only
    kinds = {"Class": "int", id_col or "id": "long", "Time": "double", "Amount": "double"}
    number = {c: "double" for c in names if re.fullmatch(r"V\d+", c)}
    kind = {c: kinds.get(c, number.get(c, "string")) for c in names}
    schema = ", ".join(f"`{c}` {kind[c]}" for c in names)
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)
    df = df.withColumns({c: nan_to_null(c) for c in names if kind[c] == "double"})
    own = id_col or "id"
    if own in names:
        return df.withColumnRenamed(own, "id") if own != "id" else df
    return df.withColumn("id", F.monotonically_increasing_id())


def write_features(df: DataFrame, path: str, partition_by: str | None = "split") -> None:
    """Feature / score tables as Parquet keyed by ``id`` (partitioned by split)."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def read_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def read_json_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON-lines log; a missing path gives an empty table of the schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    return read_json_log(spark, f"{root}/alerts", ALERTS)


def read_stats(spark: SparkSession, root: str) -> DataFrame:
    return read_json_log(spark, f"{root}/stats", STATS)


def read_batch_alerts(spark: SparkSession, root: str) -> DataFrame:
    """All per-batch documents → one row per case (missing ``cases`` → none)."""
    patterns = [p for p in (f"{root}/fraud_alerts_batch_*.json", f"{root}/{DOCUMENTS}/batch=*") if path_exists(spark, p)]
    if not patterns:
        return spark.createDataFrame([], BATCH_ALERT_DOC).select(F.explode("cases").alias("c")).select("c.*")
    docs = spark.read.schema(BATCH_ALERT_DOC).option("multiLine", True).json(patterns)
    return flatten_cases(docs)


def write_batches(df: DataFrame, root: str, table: str, batches: range, by: str = "batch_id") -> None:
    """The rows of several batches in one write, in the folders that
    ``write_batch_rows`` would give each. A replay overwrites them, also the
    folder of a batch that has no rows now."""
    spark, df = df.sparkSession, df.persist()
    try:
        df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
            "maxRecordsPerFile", 1 if table == DOCUMENTS else 0).partitionBy(by).json(f"{root}/{table}")
        some = {r[0] for r in df.select(by).distinct().collect()}  # at most the batches of a micro-batch
    finally:
        df.unpersist()
    for i in batches:
        if i not in some:
            fs, p = _file_system(spark, f"{root}/{table}/{by}={i}")
            fs.delete(p, True)


def write_batch_rows(df: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Append sink made replay-safe: each batch owns ``batch_id=<id>`` and a
    replay overwrites it instead of appending a second copy."""
    df.write.mode("overwrite").json(f"{root}/{table}/batch_id={int(batch_id)}")


def _cases(cases: DataFrame) -> DataFrame:
    case = F.struct(F.col("Time").cast("double").alias("Time"), F.col("Amount").cast("double").alias("Amount"),
                    F.col("anomaly_score").cast("double").alias("anomaly_score")).alias("case")
    return cases.select(case, *([F.col("batch_id")] if "batch_id" in cases.columns else []))


def alert_documents(cases: DataFrame, batch_id: int, epoch_seconds: float, chunk: int = DOCUMENT_CASES) -> DataFrame:
    """Nested documents of a batch: one for every ``chunk`` of its cases at
    most, so no row grows with the batch; none without cases."""
    cases = _cases(cases.drop("batch_id"))
    n = cases.count()
    # by the count: about half a chunk a document, never dealt by one key
    part = F.pmod(F.xxhash64("case", F.monotonically_increasing_id()), F.lit(max(1, -(-2 * n // chunk)) if n > chunk else 1))
    doc = cases.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("fraud_count"), F.collect_list("case").alias("cases"))
    return doc.select(F.lit(int(batch_id)).cast("long").alias("batch_id"), F.lit(float(epoch_seconds)).alias("timestamp"), "fraud_count", "cases")


def batches_documents(cases: DataFrame, rows_per_batch: int, epoch_seconds: float, chunk: int = DOCUMENT_CASES) -> DataFrame:
    """The same of each ``batch_id`` of cases of several batches of at most
    ``rows_per_batch`` rows."""
    part = F.pmod(F.xxhash64("case", F.monotonically_increasing_id()), F.lit(max(1, -(-2 * rows_per_batch // chunk)) if rows_per_batch > chunk else 1))
    doc = _cases(cases).groupBy("batch_id", part.alias("part")).agg(F.count(F.lit(1)).alias("fraud_count"), F.collect_list("case").alias("cases"))
    return doc.select("batch_id", F.lit(float(epoch_seconds)).alias("timestamp"), "fraud_count", "cases")


def write_alert_document(cases: DataFrame, batch_id: int, root: str, epoch_seconds: float,
                         chunk: int = DOCUMENT_CASES) -> None:
    """The documents of the batch as JSON, overwritten on replay. A batch
    without cases has none, also if an earlier run of it had some."""
    spark, path = cases.sparkSession, f"{root}/fraud_alerts_batch_{int(batch_id)}.json"
    cases = cases.persist()
    if not cases.isEmpty():
        doc = alert_documents(cases, batch_id, epoch_seconds, chunk)
        doc.write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)
    elif path_exists(spark, path):
        fs, p = _file_system(spark, path)
        fs.delete(p, True)
    cases.unpersist()


def write_report(df: DataFrame, root: str, name: str) -> None:
    """The table behind a chart, as Parquet under ``reports/<name>``."""
    df.write.mode("overwrite").parquet(f"{root}/reports/{name}")
