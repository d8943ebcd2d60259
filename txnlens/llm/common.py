"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import hashing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = 1000, size: int = 4 << 20) -> None:
    """Let Arrow hand over at most so many rows, or about so many bytes, at a
    time in this session. Rows hold whole texts or blobs here, so the defaults
    of 10,000 rows and 64 MB make batches of tens of megabytes, held several
    times over by the JVM and by the worker."""
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{name}"
        now = conf.get(name).rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):  # anything else is not compared
            conf.set(name, str(most))


def ascii_lower(col):
    """A-Z only, so that both engines agree on every other letter."""
    return F.translate(col, UPPER, LOWER)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage's result into the shared checkpoint folder and read it
    back: it is computed once, and a lost executor loses nothing of it."""
    return materialize(df, f"llm-{name}")


def column_or(df: DataFrame, name: str, default=None):
    """The column, or a literal when an input table lacks it."""
    return F.col(name) if name in df.columns else F.lit(default)


def slices(texts: list[str], chars: int) -> Iterator[slice]:
    """Runs of texts of about so many characters, one text at least."""
    lo = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield slice(lo, i + 1)
            lo, held = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def release() -> None:
    """Hand freed memory back to the system: a worker lives on in other stages."""
    hashing.forget_long()
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that releases its memory at its end."""
    @wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return wrapped


def each_bucket(batches: Iterator) -> Iterator[list[bytes]]:
    """The blobs of each bucket of a task, one bucket after another; rows
    (bucket, blob) are sorted by bucket."""
    held: list[bytes] = []
    now = None
    for b in batches:
        for bucket, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if held and bucket != now:
                yield held
                held = []
            now = bucket
            held.append(blob)
    if held:
        yield held


def gathered(parts: Iterator[tuple[np.ndarray, ...]], rows: int = 1 << 18) -> Iterator[tuple[np.ndarray, ...]]:
    """Parts of columns put together until they have so many rows."""
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += len(p[0])
        if n >= rows:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(c) for c in zip(*held))
