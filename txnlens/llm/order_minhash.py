"""Operator 5: document fingerprints by Order MinHash.

The k-mers of a text (k code points) are numbered by occurrence, so a
repeated k-mer counts as often as it stands there. For each of M hash
functions the L smallest numbered k-mers are selected, put back into the
order of the text and hashed as a tuple. Two texts agree in a component when
the same k-mers were selected in the same order, so the share of equal
components (``likeness``) falls with the edit distance and not only with the
set of k-mers lost.

Defined results: a null text is empty; the empty text has the fingerprint
``""`` (likeness 1 to another empty text, else 0); k - 1 blanks are put before
a text, so it has a k-mer for each code point however short it is, and with
fewer than L k-mers all are selected.
Equal texts have equal fingerprints. Rows equal in doc_id are ordered by a
hash of their text; repeated rows count as one document in the order and each
is returned; a null doc_id comes first. One document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

K, L, M = 8, 2, 64
POSITION_BITS = 20  # a k-mer's hash keeps the other 44
BLOCK = 4096  # numbered k-mers hashed at a time: M rows of them stay in cache
DIGITS = 4  # hex digits of a component


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _family(m: int) -> tuple[np.ndarray, np.ndarray]:
    """m pairs (xor word, odd multiplier) of 32 bits from a counter."""
    w = _mix(np.arange(1, 2 * m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    w = (w >> np.uint64(32)).astype(np.uint32)
    return w[:m, None], (w[m:, None] | np.uint32(1))


_FAMILY: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def kmer_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit hash for each of the k-mers that end at a code point, by
    doubling the length of hashed runs; before the text stand k - 1 zeros."""
    points = np.concatenate([np.zeros(k - 1, points.dtype), points])
    h, size = _mix(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    out, have, p, left = None, 0, h, k
    n = len(points) - k + 1
    while left:
        if left & size:
            piece = p[have:have + n]
            out = piece if out is None else out * np.uint64(0x9FB21C651E98DF25) + piece
            have += size
            left -= size
        if left:
            p = _mix_pair(p[:-size], p[size:])
            size *= 2
    return _mix(out)


def _mix_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0xFF51AFD7ED558CCD) + b
    return x ^ (x >> np.uint64(29))


def numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of k-mer and occurrence number, position), in any order."""
    n, low = len(h), np.uint64((1 << POSITION_BITS) - 1)
    if n <= 1 << POSITION_BITS:  # one sort of hash and position together
        s = np.sort((h & ~low) | np.arange(n, dtype=np.uint64))
        key, pos = s & ~low, (s & low).astype(np.int64)
    else:
        pos = np.argsort(h & ~low, kind="stable")
        key = h[pos] & ~low
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    if new.all():
        return _mix(key), pos
    first = np.flatnonzero(new)
    occ = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return _mix(key + occ.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), pos


def components(text: str, k: int = K, l: int = L, m: int = M) -> np.ndarray:  # noqa: E741
    """The m tuple hashes of a text that is not empty."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    x, pos = numbered(kmer_hashes(points, k))
    if m not in _FAMILY:
        _FAMILY[m] = _family(m)
    flip, times = _FAMILY[m]
    small = (x >> np.uint64(32)).astype(np.uint32)
    n, rows = len(x), np.arange(m)
    if n <= l:
        at = np.broadcast_to(np.arange(n), (m, n))
    else:
        values, places = [], []
        for lo in range(0, n, BLOCK):
            h = small[None, lo:lo + BLOCK] ^ flip
            h *= times
            for _ in range(min(l, h.shape[1])):
                i = h.argmin(axis=1)
                values.append(h[rows, i].astype(np.uint64))
                places.append(i + lo)
                h[rows, i] = 0xFFFFFFFF
        if len(values) == l:
            at = np.stack(places, 1)
        else:
            v, p = np.stack(values, 1), np.stack(places, 1)
            at = np.take_along_axis(p, np.argsort(v, axis=1, kind="stable")[:, :l], 1)
    order = np.argsort(pos[at], axis=1)
    chosen = np.take_along_axis(x[at], order, 1)
    t = np.zeros(m, np.uint64)
    for j in range(chosen.shape[1]):
        t = _mix(t * np.uint64(0x9E3779B97F4A7C15) + chosen[:, j])
    return t


def fingerprint(text: str | None, **kw) -> str:
    """Hex string: DIGITS digits for each component."""
    if not text:
        return ""
    t = components(text, **kw) >> np.uint64(64 - 4 * DIGITS)
    return t.astype(">u2").tobytes().hex()


def likeness(a: str | None, b: str | None) -> float:
    """Share of equal components, 0 to 1."""
    a, b = a or "", b or ""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(bytes.fromhex(a), ">u2") == np.frombuffer(bytes.fromhex(b), ">u2")).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row of ``docs``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "fingerprint": [fingerprint(t) for t in b["text"]]})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, fingerprint string")


# ---- each document against its edited text and the next document -----------

def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted within the task -> (task, rid, n_chars, next): the next
    different rid, null for the task's last one."""
    from pyspark import TaskContext

    task, held = TaskContext.get().partitionId(), None
    for b in batches:
        out = []
        for rid, n in zip(b["rid"], b["n_chars"]):
            if held is None:
                held = (rid, n)
            elif rid != held[0]:
                out.append((task, held[0], held[1], rid))
                held = (rid, n)
        yield pd.DataFrame(out, columns=["task", "rid", "n_chars", "next"])
    if held is not None:
        yield pd.DataFrame([(task, held[0], held[1], None)], columns=["task", "rid", "n_chars", "next"])


def next_documents(rows: DataFrame) -> DataFrame:
    """rid, n_chars, next for rows (doc_id, rid, n_chars): the rid that
    follows in the order of doc_id, the first one after the last. Only these
    narrow columns are sorted; tasks are joined by one row each."""
    ranged = rows.repartitionByRange("doc_id", "rid").sortWithinPartitions("doc_id", "rid")
    links = stored(ranged.select("rid", "n_chars").mapInPandas(_links, "task int, rid string, n_chars long, next string"), "omh-links")
    inner = links.where("next IS NOT NULL").select(F.col("next").alias("rid"))
    first = links.join(inner, "rid", "left_anti").select("task", F.col("rid").alias("first"))  # a row for each task that has rows
    heads = [r for r in first.orderBy("task").collect()]  # as many as tasks
    after = {a["task"]: b["first"] for a, b in zip(heads, heads[1:] + heads[:1])}
    if not after:
        return links.select("rid", "n_chars", "next")
    table = links.sparkSession.createDataFrame(list(after.items()), "task int, head string")
    return links.join(F.broadcast(table), "task").select("rid", "n_chars", F.coalesce("next", "head").alias("next"))


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, text) -> (rid, compressed text), before texts are moved."""
    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([z.compress(t.encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()], pa.binary())],
                                         names=["rid", "z"])


def _text(z: zstandard.ZstdDecompressor, data: bytes) -> str:
    return z.decompress(data).decode("utf-8", "surrogatepass")


def _hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, z, to, cut) -> a row for the document before it, with the
    characters that replace its end and this fingerprint, and a row for the
    document itself with its fingerprint."""
    z, c = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
    for b in batches:
        rid, tail, nxt, own = [], [], [], []
        for r, data, to, cut in zip(*[x.to_pylist() for x in b.columns]):
            text = _text(z, data)
            print_ = bytes.fromhex(fingerprint(text))
            rid += [to, r]
            tail += [c.compress(text[:cut].encode("utf-8", "surrogatepass")), None]
            nxt += [print_, None]
            own += [None, print_]
        yield pa.RecordBatch.from_arrays([pa.array(rid, pa.string()), *[pa.array(x, pa.binary()) for x in (tail, nxt, own)]],
                                         names=["rid", "tail", "next_print", "own_print"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdDecompressor()
    for b in batches:
        out = ([], [], [], [], [], [], [])
        for rid, data, tail, nxt, own in zip(*[x.to_pylist() for x in b.columns]):
            text, doc_id = _text(z, data), rid.partition(":")[0]
            edited = text[:len(text) - len(text) // 4] + _text(z, tail)
            a, e = own.hex(), fingerprint(edited)
            row = (int(doc_id) if doc_id else None, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), a, e,
                   likeness(a, e), likeness(a, nxt.hex()))
            for column, value in zip(out, row):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=[f.split()[0] for f in COMPARED.split(", ")])


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """COMPARED for every row. Both joins below ask for the same distribution
    of the same compressed texts, so these are moved once; of the next
    document only the characters needed and its fingerprint are moved on."""
    text = F.coalesce("text", F.lit(""))
    rid = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.hex(F.xxhash64(text)))
    t = docs.select(rid.alias("rid"), text.alias("text")).mapInArrow(_squeezed, "rid string, z binary")
    order = next_documents(docs.select(F.col("doc_id").cast("long").alias("doc_id"), rid.alias("rid"), F.length(text).cast("long").alias("n_chars")))
    need = order.select(F.col("next").alias("rid"), F.col("rid").alias("to"), F.floor(F.col("n_chars") / 4).cast("int").alias("cut"))
    sent = (t.join(need.hint("merge"), "rid").select("rid", "z", "to", "cut")
            .mapInArrow(_hand_on, "rid string, tail binary, next_print binary, own_print binary"))
    # a document may be stored twice: one of each suffices
    sent = sent.groupBy("rid").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("tail", "next_print", "own_print")])
    return t.join(sent.hint("merge"), "rid").select("rid", "z", "tail", "next_print", "own_print").mapInArrow(_compare, COMPARED)
