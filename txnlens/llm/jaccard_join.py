"""Operator 9: n-gram Jaccard join as a join of metric spaces.

Documents are sets of word shingles; their distance is 1 - Jaccard, and two
link when it is at most r = 1 - similarity. The join is exact.

1. Equal sets are one class, named by its smallest doc_id.
2. Pruning. A set of n shingles that links with anything misses at most
   n - ceil(s n) of them in the other. Shingles that no other class has are
   such misses: a class with more of them than that links with nothing. They
   are counted first in a hash-chosen share of the shingle space (the same for
   all classes, so counts in it are exact), then, for what is left, in all.
3. Voronoi regions. The first pivots are the one-shingle sets {x}, rarest x
   first: all pivots inside a set are its nearest ones, and the first of them
   in the order is its home. By the triangle inequality (on the symmetric
   difference) a partner's home lies among the first n - ceil(s n) + 1, so a
   set is replicated to the regions of these boundary pivots and no others.
4. Inside a region a document becomes the pivot: the one with the fewest
   shingles of its own. Its distances are verified, and links to it contract
   the region: what has one component needs no more pairs.
5. Regions that still hold several components are joined in blocks of bounded
   size, on pairs of different components only, of fitting sizes and places,
   whose distances to the region's pivot differ by r at most (triangle
   inequality), and whose parity sketches, which bound the symmetric
   difference from below, leave a link possible. Those pairs are verified.
6. Connected components of all links.

Document pivots and region sizes are found by aggregates, so a hot region is
never gathered: its pairs with the pivot are spread by the join, its blocks
are tasks of their own. Only class sets that pass the pruning are moved.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased;
with fewer words than a shingle has, the whole sequence is the only shingle;
null, empty or wordless texts have the empty set, link with nothing and are
components of their own. Rows are judged by their own text, and a component
is named by its smallest doc_id; a null doc_id comes last in that order.
Shingles and classes are 64-bit hashes (of classes, of their 128-bit
digests); words of more than LONG_WORD bytes enter by a cryptographic digest,
since a polynomial modulo 2**64 has long words that every base makes equal.
Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, each_bucket, gathered, released, slices, small_batches, stored
from .components import components
from .hashing import BYTE, Prefix, from_planes, mix, planes

SLICE_CHARS = 1 << 18
LONG_WORD = 32
SKETCH_WORDS = 4  # 256 bits
BLOCK_ROWS = 256
BROADCAST_IDS = 500_000  # of 24 bytes
LAST_ID = 2 ** 63 - 1  # stands for a null doc_id

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = BYTE.copy()
_LOWER[ord("A"):ord("Z") + 1] = BYTE[ord("a"):ord("z") + 1]
_LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    size = np.array([len(b) + 1 for b in raw])
    end_of = np.cumsum(size)
    sep = _SEPARATOR[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], sep, [True]]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    p = Prefix(data, _LOWER)
    word = mix(p.of(start, end) + (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        own = data[start[i]:end[i]].tobytes().translate(_LOWER_BYTES)
        word[i] = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little")
    upto = np.searchsorted(start, end_of)  # words before each text's end
    many = np.zeros(0, np.uint64)
    if len(word) >= k:
        n = len(word) - k + 1
        many = word[:n].copy()
        for j in range(1, k):
            many = mix(many * np.uint64(0xFF51AFD7ED558CCD) + word[j:j + n])
    out, lo = [], 0
    for hi in upto.tolist():
        if hi - lo >= k:
            s = np.sort(many[lo:hi - k + 1])
            s = s[np.append(True, s[1:] != s[:-1])]
        elif hi > lo:
            h = mix(np.array([hi - lo], np.uint64))
            for w in word[lo:hi]:
                h = mix(h * np.uint64(0xC4CEB9FE1A85EC53) + w)
            s = h
        else:
            s = np.zeros(0, np.uint64)
        out.append(s)
        lo = hi
    return out


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _class_id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _sampled(s: np.ndarray, share: float) -> np.ndarray:
    return s[:np.searchsorted(s, np.uint64(min(1.0, share) * (2 ** 64 - 2 ** 11)))]


def _each_set(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of a batch whose last column is the text."""
    texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
    for part in slices(texts, SLICE_CHARS):
        yield from zip(range(part.start, part.stop), shingle_sets(texts[part], k))


def _describe(k: int, share: float):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ns, d, cid = [], [], [], []
            for _, s in _each_set(b, k):
                n.append(len(s))
                ns.append(len(_sampled(s, share)))
                d.append(_digest(s))
                cid.append(_class_id(d[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ns, pa.int64()), pa.array(d, pa.binary()),
                                              pa.array(cid, pa.int64())], names=["doc_id", "n", "n_sampled", "digest", "cid"])
    return run


def _rows(bucket: list[int], blob: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(blob, pa.binary())], names=["bucket", "blob"])


def _dealt(key: np.ndarray, blobs, buckets: int, bits: int) -> pa.RecordBatch:
    """Rows (bucket, blob) of entries dealt by the top bits of ``key``;
    ``blobs(order slice)`` packs entries."""
    order = np.argsort(key, kind="stable")
    top = (key[order] >> np.uint64(bits - (buckets - 1).bit_length())).astype(np.int64) if buckets > 1 else np.zeros(len(key), np.int64)
    cut = np.searchsorted(top, np.arange(buckets + 1))
    used = [i for i in range(buckets) if cut[i] < cut[i + 1]]
    return _rows(used, [blobs(order[cut[i]:cut[i + 1]]) for i in used])


def _sample_entries(k: int, share: float, buckets: int):
    """Text -> blobs of (48 bits of a sampled shingle, 48 bits of the class);
    a class is sent once by a task's batch however many copies it holds."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen, shingles, owners = set(), [], []
            for _, s in _each_set(b, k):
                d = _digest(s)
                if d not in seen:
                    seen.add(d)
                    shingles.append(_sampled(s, share))
                    owners.append(d)
            if not shingles:
                continue
            x = np.concatenate(shingles) & np.uint64(2 ** 48 - 1)
            cid = np.frombuffer(b"".join(owners), "<u8")[::2] & np.uint64(2 ** 48 - 1)
            own = np.repeat(cid, [len(s) for s in shingles])
            yield _dealt(x, lambda o: planes(x[o], 6) + planes(own[o], 6), buckets, 48)
    return run


def _halves(blob: bytes, first: int, second: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // (first + second)
    return from_planes(blob[:n * first], first), from_planes(blob[n * first:], second)


def _gather(blobs: list[bytes], first: int, second: int) -> tuple[np.ndarray, np.ndarray]:
    """The entries of one bucket."""
    parts = [_halves(x, first, second) for x in blobs]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _shared_counts(buckets: int):
    """Entries of a task -> blobs of (class, number of its sampled shingles
    that another class has too) of classes with any, dealt by class."""
    def counts(blobs):
        x, own = _gather(blobs, 6, 6)
        order = np.lexsort((own, x))
        x, own = x[order], own[order]
        keep = np.append(True, (x[1:] != x[:-1]) | (own[1:] != own[:-1]))
        x, own = x[keep], own[keep]
        same = x[1:] == x[:-1]
        shared = np.append(same, False) | np.append(False, same)
        return np.unique(own[shared], return_counts=True)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cid, n in gathered(map(counts, each_bucket(batches))):
            yield _dealt(cid, lambda o: planes(cid[o], 6) + planes(n[o], 4), buckets, 48)
    return run


@released
def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blobs dealt by class -> one row (class, sum of its counts)."""
    for blobs in each_bucket(batches):
        cid, n = _gather(blobs, 6, 4)
        one, at = np.unique(cid, return_inverse=True)
        total = np.bincount(at, weights=n.astype(np.float64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(one.astype(np.int64)), pa.array(total)], names=["low", "n_shared"])


def _set_entries(k: int, buckets: int):
    """(digest, text) -> blobs of (shingle, class) with all shingles of the
    rows whose set has the digest."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = b.column(0).to_pylist()
            sets = [(want[i], s) for i, s in _each_set(b, k) if _digest(s) == want[i]]
            if not sets:
                continue
            cid = np.array([_class_id(d) for d, _ in sets], np.int64).view(np.uint64)
            x, own = np.concatenate([s for _, s in sets]), np.repeat(cid, [len(s) for _, s in sets])
            yield _dealt(x, lambda o: planes(x[o], 8) + planes(own[o], 8), buckets, 64)
    return run


def _count_and_return(buckets: int):
    """Blobs of (shingle, class) -> blobs of (class, shingle, number of
    classes) of the shingles that several classes have, dealt by class."""
    def counted(blobs):
        x, own = _gather(blobs, 8, 8)
        order = np.lexsort((own, x))
        x, own = x[order], own[order]
        keep = np.append(True, (x[1:] != x[:-1]) | (own[1:] != own[:-1]))  # a class may be stored twice
        x, own = x[keep], own[keep]
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        df = np.repeat(np.diff(np.append(first, len(x))), np.diff(np.append(first, len(x)))).astype(np.uint64)
        many = df > 1
        return own[many], x[many], df[many]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, x, df in gathered(map(counted, each_bucket(batches))):
            yield _dealt(mix(own), lambda o: planes(own[o], 8) + planes(x[o], 8) + planes(df[o], 8), buckets, 64)
    return run


@released
def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blobs dealt by class -> rid (the class), its shared shingles in the
    order of (number of classes, hash), and their parity sketch."""
    for blobs in each_bucket(batches):
        sizes = [len(blob) // 24 for blob in blobs]
        own, x, df = (np.concatenate([from_planes(blob[8 * i * n:8 * (i + 1) * n], 8) for blob, n in zip(blobs, sizes)]) for i in range(3))
        order = np.lexsort((x, df, own))
        own, x = own[order], x[order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        last = np.append(first[1:], len(own))
        bit = np.uint64(1) << (x & np.uint64(63))
        word = ((x >> np.uint64(6)) & np.uint64(SKETCH_WORDS - 1)).astype(np.int64)
        sketch = [np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), first).view(np.int64) for w in range(SKETCH_WORDS)]
        signed = x.view(np.int64)
        for lo in range(0, len(first), 1000):
            part = slice(lo, lo + 1000)
            offsets = np.append(first[part], last[part][-1]) - first[lo]
            shared = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(signed[first[lo]:last[part][-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(own[first[part]].view(np.int64)), shared, *[pa.array(s[part]) for s in sketch]],
                                             names=["rid", "shared", *[f"w{i}" for i in range(SKETCH_WORDS)]])


def _buckets(df: DataFrame) -> tuple[int, int]:
    """(tasks, buckets): a power of two of buckets, two or more for each task
    of a shuffle. A batch makes a row for each bucket, so more would cost rows."""
    tasks = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    return tasks, 1 << (2 * tasks - 1).bit_length()


def _by_bucket(df: DataFrame, tasks: int) -> DataFrame:
    """Dealt to tasks and sorted by bucket: a task takes one bucket at a time."""
    return df.repartition(tasks, "bucket").sortWithinPartitions("bucket")


def described(docs: DataFrame, k: int, share: float) -> DataFrame:
    """doc_id, n, n_sampled, digest of every row's shingle set; written."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), "text")
    return stored(rows.mapInArrow(_describe(k, share), "doc_id long, n long, n_sampled long, digest binary, cid long"), "jaccard-sets")


def _misses(n: Column, num: int, den: int) -> Column:
    """Shingles of n that a partner may lack: n - ceil(s n)."""
    return n - F.ceil(n * F.lit(num) / F.lit(den)).cast("long")


def survivors(docs: DataFrame, members: DataFrame, k: int, share: float, num: int, den: int) -> DataFrame:
    """Per class that may link: rid (the class), n, n_unique, shared (in
    pivot order) and the sketch words; written."""
    tasks, buckets = _buckets(docs)
    text = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), "text")
    sampled = _by_bucket(text.select("text").mapInArrow(_sample_entries(k, share, buckets), "bucket int, blob binary"), tasks)
    counted = _by_bucket(sampled.mapInArrow(_shared_counts(buckets), "bucket int, blob binary"), tasks)
    counts = counted.mapInArrow(_sum_counts, "low long, n_shared long")
    classes = members.where("n > 0").groupBy("digest", "cid", "n", "n_sampled").agg(F.min("doc_id").alias("doc_id"))
    left = classes.withColumn("low", F.col("cid").bitwiseAND(F.lit(2 ** 48 - 1))).join(counts, "low", "left")
    alone = F.col("n_sampled") - F.coalesce("n_shared", F.lit(0))
    left = stored(left.where(alone <= _misses(F.col("n"), num, den)).select("doc_id", "n", "digest", "cid"), "jaccard-left")
    small = left.count() <= BROADCAST_IDS
    hint = F.broadcast if small else (lambda df: df)
    own = text.join(hint(left.select("doc_id", "digest")), "doc_id").select("digest", "text")
    entries = _by_bucket(own.mapInArrow(_set_entries(k, buckets), "bucket int, blob binary"), tasks)
    back = _by_bucket(entries.mapInArrow(_count_and_return(buckets), "bucket int, blob binary"), tasks)
    words = ", ".join(f"w{i} long" for i in range(SKETCH_WORDS))
    sets = back.mapInArrow(_assemble, f"rid long, shared array<long>, {words}")
    sets = sets.join(left.select(F.col("cid").alias("rid"), "n"), "rid").withColumn("n_unique", F.col("n") - F.size("shared"))
    return stored(sets.where(F.col("n_unique") <= _misses(F.col("n"), num, den)), "jaccard-survivors")


def _least_overlap(na: Column, nb: Column, num: int, den: int) -> Column:
    return F.ceil((na + nb) * F.lit(num) / F.lit(num + den)).cast("long")


def _possible(num: int, den: int) -> Column:
    """Whether rows with columns x_* and y_* of one region may link."""
    nx, ny = F.col("x_n"), F.col("y_n")
    o = _least_overlap(nx, ny, num, den)
    apart = F.col("x_n_unique") + F.col("y_n_unique")
    for i in range(SKETCH_WORDS):
        apart = apart + F.bit_count(F.col(f"x_w{i}").bitwiseXOR(F.col(f"y_w{i}")))
    fits = (F.least(nx, ny) * den >= F.greatest(nx, ny) * num) & (F.least(nx - F.col("x_place"), ny - F.col("y_place")) >= o)
    return fits & (apart <= nx + ny - 2 * o)


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, distance, linked) of distinct pairs (a, b), exactly."""
    one = sets.select(F.col("rid"), F.col("n"), F.col("shared"))
    j = pairs.join(one.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb")), "b")
    j = j.join(one.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa")), "a")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    j = j.select("a", "b", "na", "nb", both.alias("both"))
    return j.select("a", "b", (1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("distance"),
                    (F.col("both") * (num + den) >= (F.col("na") + F.col("nb")) * num).alias("linked"))


def _side(df: DataFrame, side: str, but: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(c) if c in but else F.col(c).alias(f"{side}_{c}") for c in df.columns])


def links(sets: DataFrame, num: int, den: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all links."""
    words = [f"w{i}" for i in range(SKETCH_WORDS)]
    window = (_misses(F.col("n"), num, den) + 1 - F.col("n_unique")).cast("int")
    entries = sets.select("rid", "n", "n_unique", *words, F.posexplode(F.slice("shared", F.lit(1), window)).alias("pos", "pivot"))
    entries = stored(entries.withColumn("place", F.col("n_unique") + F.col("pos")).drop("pos"), "jaccard-entries")
    # the region's document: the fewest shingles of its own
    row = F.struct("n_unique", "rid", "place", "n", *words)
    regions = stored(entries.groupBy("pivot").agg(F.count("*").alias("rows"), F.min(row).alias("doc")).where("rows > 1"), "jaccard-regions")
    centre = regions.select("pivot", *[F.col(f"doc.{c}").alias(f"y_{c}") for c in ("rid", "n", "n_unique", "place", *words)])
    star = _side(entries, "x", ("pivot",)).join(centre, "pivot").where((F.col("x_rid") != F.col("y_rid")) & _possible(num, den))
    star = stored(verify(star.select(F.col("y_rid").alias("a"), F.col("x_rid").alias("b")).distinct(), sets, num, den), "jaccard-star")
    linked = star.where("linked").select("a", "b")
    comp = components(linked)
    # boundary pairs of regions with several components left
    e = entries.join(regions.select("pivot", "rows", F.col("doc.rid").alias("centre")), "pivot")
    e = e.join(comp.select(F.col("id").alias("rid"), "comp"), "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    e = stored(e.join(star.select(F.col("a").alias("centre"), F.col("b").alias("rid"), "distance"), ["centre", "rid"], "left")
               .withColumn("distance", F.when(F.col("centre") == F.col("rid"), 0.0).otherwise(F.col("distance"))), "jaccard-labelled")
    open_ = e.groupBy("pivot").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("pivot")
    e = e.join(open_, "pivot").withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("int"))
    e = e.withColumn("block", F.pmod(F.xxhash64("rid"), "blocks").cast("int")).drop("rows", "centre")
    x = _side(e, "x", ("pivot",)).withColumn("j", F.explode(F.sequence(F.col("x_block"), F.col("x_blocks") - 1))).withColumn("i", F.col("x_block"))
    y = _side(e, "y", ("pivot",)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("y_block")))).withColumn("j", F.col("y_block"))
    r = 1 - num / den
    near = F.coalesce(F.abs(F.col("x_distance") - F.col("y_distance")) <= r + 1e-9, F.lit(True))
    once = (F.col("x_block") < F.col("y_block")) | (F.col("x_rid") < F.col("y_rid"))
    pairs = x.join(y, ["pivot", "i", "j"]).where(once & (F.col("x_comp") != F.col("y_comp")) & near & _possible(num, den))
    pairs = pairs.select(F.least("x_rid", "y_rid").alias("a"), F.greatest("x_rid", "y_rid").alias("b")).distinct()
    rest = stored(verify(pairs, sets, num, den).where("linked").select("a", "b"), "jaccard-rest")
    return linked.unionByName(rest)


def named(docs: DataFrame, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """doc_id (LAST_ID: null), n, digest and name, the smallest doc_id of the
    component, of every row."""
    small_batches(docs)
    num, den = similarity
    share = min(1.0, 2.0 * (1 - num / den))
    members = described(docs, shingle, share)
    sets = survivors(docs, members, shingle, share, num, den)
    comp = components(links(sets, num, den))
    classes = members.where("n > 0").groupBy("digest", "cid").agg(F.min("doc_id").alias("first"))
    linked = stored(classes.join(comp.withColumnRenamed("id", "cid"), "cid"), "jaccard-linked")
    least = linked.groupBy("comp").agg(F.min("first").alias("name"))
    names = classes.join(linked.join(least, "comp").select("digest", "name"), "digest", "left").select("digest", F.coalesce("name", "first").alias("name"))
    out = members.join(names, "digest", "left")
    return out.select("doc_id", "n", "digest", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("name")).alias("name"))


def jaccard_components(docs: DataFrame, shingle: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id of every row. ``similarity`` is the
    least Jaccard similarity of a link as a fraction of integers."""
    back = lambda c: F.nullif(c, F.lit(LAST_ID).cast("long"))
    return named(docs, shingle, similarity).select(back(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
                                                   back(F.col("name")).alias("component_id"))


def keep_first(docs: DataFrame, shingle: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest
    doc_id (rows that share it stay). Rows are judged by their own text: an
    id goes as a whole if all its rows go, else those of its texts that go.
    The ids and texts to drop are broadcast while they are few, else joined."""
    rows = named(docs, shingle, similarity).groupBy("doc_id", "digest").agg(F.max(F.col("doc_id") != F.col("name")).alias("goes"))
    rows = stored(rows, "jaccard-named")
    ids = rows.groupBy("doc_id").agg(F.min("goes").alias("every"), F.max("goes").alias("some")).where("some")
    ids = stored(ids.select(F.col("doc_id").alias("_gone"), "every"), "jaccard-gone")
    few = lambda df: F.broadcast(df) if df.count() <= BROADCAST_IDS else df
    doc_id, text = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID)), F.coalesce(docs["text"], F.lit(""))
    key = {"_gone": doc_id, "_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit("again"), text)}
    whole = few(ids.where("every").select("_gone"))
    out = docs.join(whole, doc_id == whole["_gone"], "left_anti")
    parted = ids.where("NOT every").select("_gone")
    if parted.isEmpty():
        return out
    # texts of ids of which some rows go and some stay
    own = docs.select(*[c.alias(k) for k, c in key.items()], text.alias("text")).join(few(parted), "_gone", "left_semi")
    own = own.select(F.struct(*key).alias("doc_id"), "text").mapInArrow(
        _describe(shingle, 1.0), "doc_id struct<_gone: long, _h1: long, _h2: long>, n long, n_sampled long, digest binary, cid long")
    goes = rows.where("goes").select(F.col("doc_id").alias("_gone"), "digest")
    texts = few(stored(own.select("doc_id.*", "digest").join(goes, ["_gone", "digest"]).select(*key).distinct(), "jaccard-gone-texts"))
    same = [c == texts[k] for k, c in key.items()]
    return out.join(texts, same[0] & same[1] & same[2], "left_anti")
