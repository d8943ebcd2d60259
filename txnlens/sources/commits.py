"""A sink whose batches appear as a whole or not at all.

A batch is one frame of (table, payload): the JSON rows of all its tables.
Each task writes a file a table under a name of its own and reports the names
in its message; the commit writes one manifest, ``commits/<batch>.json``, with
the files of all tasks. Readers read the files that manifests name and nothing
else, so

* a crash before the manifest leaves files that nobody reads (an abort
  removes those it knows of);
* a crash after it leaves a whole batch, and its replay finds the manifest,
  drops its own files and changes nothing: the first commit of a batch stands.

The manifest is written under a hidden name and renamed; object stores,
which show an object only when it is complete, get it directly. A manifest holds
one entry for each task and table; reading collects one name a file, as
any file listing does. Files are written by Arrow, so the folder must be a
mounted folder, HDFS, S3 or GCS. Batches without rows commit an empty list.

The same writer serves ``df.write`` (inside ``foreachBatch``, with the option
``batch_id``) and ``df.writeStream`` (batch ids from the stream).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import ship_package
from .files import path_exists
from .rowstream import _opened

FORMAT = "txnlens_commits"
PAYLOAD = "table string, payload string"


@dataclass
class Files(WriterCommitMessage):
    names: list  # [table, name, rows]


class Committer:
    """What batch and stream writers share."""

    def __init__(self, options):
        self.root = options["path"].rstrip("/")

    def _manifest(self, batch_id: int):
        files, root = _opened(self.root)
        return files, f"{root}/commits/{int(batch_id):020d}.json"

    def write(self, batches: Iterator) -> Files:
        files, root = _opened(self.root)
        task, out, rows = uuid.uuid4().hex, {}, {}
        try:
            for b in batches:
                for table, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if table not in out:
                        files.create_dir(f"{root}/{table}", recursive=True)
                        out[table], rows[table] = files.open_output_stream(f"{root}/{table}/{task}.json"), 0
                    out[table].write(payload.encode("utf-8", "surrogatepass") + b"\n")
                    rows[table] += 1
        finally:
            for stream in out.values():
                stream.close()
        return Files([[t, f"{t}/{task}.json", n] for t, n in rows.items()])

    def _commit(self, messages: list, batch_id: int) -> None:
        from pyarrow import fs

        files, path = self._manifest(batch_id)
        if files.get_file_info(path).type != fs.FileType.NotFound:
            self.abort(messages)
            return
        names = [{"table": t, "name": n, "rows": k} for m in messages if m is not None for t, n, k in m.names]
        folder, name = path.rsplit("/", 1)
        files.create_dir(folder, recursive=True)
        direct = files.type_name in ("s3", "gcs", "abfs")
        first = path if direct else f"{folder}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(first) as f:
            f.write(json.dumps({"batch_id": int(batch_id), "files": names}).encode())
        if not direct:
            files.move(first, path)

    def abort(self, messages: list, *_) -> None:
        files, root = _opened(self.root)
        for m in messages:
            for _, name, _ in m.names if m is not None else []:
                try:
                    files.delete_file(f"{root}/{name}")
                except FileNotFoundError:
                    pass


class BatchWriter(Committer, DataSourceArrowWriter):
    def __init__(self, options):
        super().__init__(options)
        self.batch_id = int(options["batch_id"])

    def commit(self, messages: list) -> None:
        self._commit(messages, self.batch_id)


class StreamWriter(Committer, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803 (Spark's name)
        self._commit(messages, batchId)


class CommitSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PAYLOAD

    def writer(self, schema: StructType, overwrite: bool):
        return BatchWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool):
        return StreamWriter(self.options)


def register_sink(spark: SparkSession, source: type[DataSource] = CommitSink) -> None:
    ship_package(spark)
    spark.dataSource.register(source)


def payload(df: DataFrame, table: str) -> DataFrame:
    """The rows of ``df`` as JSON payloads of one table; its column names
    are kept, and NULLs are left out as JSON writers do."""
    return df.select(F.lit(table).alias("table"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("payload"))


def write_batch(tables: dict[str, DataFrame], root: str, batch_id: int, source: type[DataSource] = CommitSink) -> None:
    """All tables of a batch in one write and one commit."""
    one = None
    for name, df in tables.items():
        p = payload(df, name)
        one = p if one is None else one.unionByName(p)
    register_sink(one.sparkSession, source)
    one.write.format(source.name()).option("batch_id", int(batch_id)).mode("append").save(root)


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, table, name, rows): the files of all committed batches."""
    schema = "batch_id long, files array<struct<table: string, name: string, rows: long>>"
    pattern = f"{root.rstrip('/')}/commits/*.json"
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], schema).select("batch_id", F.inline("files"))
    return spark.read.schema(schema).json(pattern).select("batch_id", F.inline("files"))


def read_committed(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """The rows of a table of all committed batches, with their batch_id."""
    root = root.rstrip("/")
    files = committed_batches(spark, root).where(F.col("table") == table)
    names = [f"{root}/{r['name']}" for r in files.select("name").collect()]  # one a file
    plain = StructType([f for f in schema.fields if f.name != "batch_id"])
    if not names:
        return spark.createDataFrame([], plain).withColumn("batch_id", F.lit(None).cast("long"))
    rows = spark.read.schema(plain).json(names)
    rows = rows.withColumn("_name", F.concat(F.lit(f"{table}/"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)))
    return rows.join(files.select(F.col("name").alias("_name"), "batch_id"), "_name").drop("_name")
