"""A stream whose offsets are row numbers.

``index_rows`` writes a table once in its row order, range-partitioned and
sorted, under the shared checkpoint folder, and counts the rows of its files;
row n of the stream is row n of that order, whatever files the table came in.
``row_stream`` reads it as micro-batches of exactly ``rows_per_batch`` rows:

* the offset is {"row": n}, kept in Spark's offset log. A restarted query is
  told the last offset of its checkpoint before it asks for more, so it goes
  on there, and a batch that was planned but not committed is read again with
  the same bounds;
* a micro-batch ends at the next multiple of ``rows_per_batch`` or at the last
  row, so ``batch_id = pos div rows_per_batch`` of ``row_batches`` is the
  number of the micro-batch, and only the last one is short;
* with ``batches_at_once`` a micro-batch admits up to so many of these batches,
  whole ones but for the last, as far as rows are waiting: the number of
  micro-batches and their fixed cost fall, and ``pos div rows_per_batch``
  still tells the batches apart. With ``growing`` it starts with one batch and
  admits as many more as came before, and one, up to that number: short streams
  have several micro-batches, long ones few. The offset alone decides it;
* ``max_batches`` ends the stream after so many of them;
* a batch is cut into pieces of files, one task each, which read only the row
  groups they touch, up to their last row, as Arrow batches;
* ``append_rows`` adds rows that come after all others: a restarted query
  goes on with them.

The input is read by Spark, from any store; the files of the index are read
by Arrow, from the folder that ``spark.checkpoint.dir`` names (a local or
mounted folder, HDFS, S3 or GCS).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StructType

from ..session import default_parallelism, scratch_path, ship_package

FORMAT = "txnlens_rows"
TASK_ROWS = 1 << 16  # rows that one task of a micro-batch reads at most
GROUP_BYTES = 4 << 20  # of a row group of the index, unless the session sets its size
ARROW_ROWS = 10_000


@dataclass(frozen=True)
class RowIndex:
    """Files in row order with their numbers of rows, and the table's schema."""
    files: tuple[tuple[str, int], ...]
    schema: StructType

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.files)


def _written(df: DataFrame, order_by) -> tuple[tuple[str, int], ...]:
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    group = spark.conf.get("parquet.block.size", str(GROUP_BYTES))
    df.repartitionByRange(default_parallelism(spark), *order_by).sortWithinPartitions(*order_by).write.option("parquet.block.size", group).parquet(path)
    counts = spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).count().collect()  # a row for each file
    return tuple(sorted(((r["file"], r["count"]) for r in counts), key=lambda f: _place(f[0])))


def _place(uri: str) -> tuple[int, str]:
    """Order of a written file: the number of its task, then its name."""
    name = uri.rsplit("/", 1)[-1]
    found = re.match(r"part-(\d+)", name)
    return int(found[1]) if found else 0, name


def index_rows(df: DataFrame, order_by=("Time", "id")) -> RowIndex:
    return RowIndex(_written(df, order_by), df.schema)


def append_rows(index: RowIndex, df: DataFrame, order_by=("Time", "id")) -> RowIndex:
    """The index with the rows of ``df`` after all it has."""
    return replace(index, files=index.files + _written(df.select(*index.schema.names), order_by))


class Piece(InputPartition):
    """Rows [lo, hi) of a file; row 0 of it is row ``first`` of the stream."""

    def __init__(self, uri: str, lo: int, hi: int, first: int):
        self.uri, self.lo, self.hi, self.first = uri, lo, hi, first


class RowStreamReader(DataSourceStreamReader):
    def __init__(self, options, schema: StructType):
        self.files = [(u, int(n)) for u, n in json.loads(options["files"])]
        self.size, self.at_once = int(options["rows_per_batch"]), int(options.get("batches_at_once") or 1)
        self.growing = str(options.get("growing") or "").lower() == "true"
        rows = sum(n for _, n in self.files)
        most = options.get("max_batches")
        self.end = rows if most in (None, "") else min(rows, int(most) * self.size)
        self.schema, self.at = schema, 0

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        """Admission: up to the next multiple of the batch size, or the ``batches_at_once``-th one."""
        before = self.at // self.size
        at_once = min(self.at_once, before + 1) if self.growing else self.at_once
        return {"row": max(self.at, min((before + at_once) * self.size, self.end))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Also called with start = end after a restart, which tells where the checkpoint is."""
        self.at = max(self.at, int(end["row"]))
        lo, hi, first, out = int(start["row"]), int(end["row"]), 0, []
        for uri, n in self.files:
            a, b = max(lo - first, 0), min(hi - first, n)
            out += [Piece(uri, x, min(x + TASK_ROWS, b), first) for x in range(a, b, TASK_ROWS)]
            first += n
        return out

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        p, names = partition, self.schema.names[:-1]
        wanted = to_arrow_schema(self.schema)
        files, path = _opened(p.uri)
        with files.open_input_file(path) as f:
            parquet, first = pq.ParquetFile(f), 0
            for g in range(parquet.num_row_groups):
                n = parquet.metadata.row_group(g).num_rows
                if first < p.hi and first + n > p.lo:
                    at = first
                    for b in parquet.iter_batches(ARROW_ROWS, row_groups=[g], columns=names):
                        if at >= p.hi:
                            break
                        a, z = max(p.lo - at, 0), min(p.hi - at, len(b))
                        if a < z:
                            pos = pa.array(range(p.first + at + a, p.first + at + z), pa.int64())
                            t = pa.Table.from_batches([b]).slice(a, z - a).select(names).append_column("pos", pos)
                            yield from t.cast(wanted).to_batches()
                        at += len(b)
                first += n


def _opened(uri: str):
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if not rest or scheme == "file":
        return fs.LocalFileSystem(), re.sub(r"^/+", "/", _unquoted(rest or uri))
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def _unquoted(path: str) -> str:
    from urllib.parse import unquote

    return unquote(path)


class RowSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return RowStreamReader(self.options, schema)


def row_stream(spark: SparkSession, index: RowIndex, rows_per_batch: int, max_batches: int | None = None, batches_at_once: int = 1, growing: bool = False) -> DataFrame:
    """The indexed rows and their number ``pos``, as a streaming DataFrame."""
    ship_package(spark)
    spark.dataSource.register(RowSource)
    schema = StructType([*index.schema.fields]).add("pos", LongType())
    r = spark.readStream.format(FORMAT).schema(schema).option("files", json.dumps(index.files)).option("rows_per_batch", rows_per_batch).option("batches_at_once", batches_at_once).option("growing", growing)
    if max_batches is not None:
        r = r.option("max_batches", max_batches)
    return r.load()


def run_to_end(query) -> None:
    """Lets a started query take all rows there are, then stops it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
