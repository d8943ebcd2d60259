"""Operator 10: toxicity by a convolutional text classifier.

A word's embedding is the sum of the hashed embeddings of the word and of its
first letters, so inflected forms share what they have in common. Filters of
several widths run over the words of the whole text; each gives its largest
response (max pooling) and the logarithm of its summed response. A logistic
layer turns these into a logit. The net is trained in numpy over all labelled
rows outside the held-out third (crc32 of the decimal doc_id, modulo 3, is 1),
in tasks, and applied in tasks by batches.

Training: rows are dealt by hash to shards of about SHARD_ROWS. In a round every
shard goes through its rows once, in mini-batches that are read one after
another, from the weights of the round's start; then the weights of the shards
are averaged (an embedding over the shards that changed it), in tasks by
blocks of embeddings. So a task holds the weights and one mini-batch, and the
driver the weights alone. The number of shards and rounds follows from the number of
rows: EPOCHS rounds while there is one shard, later fewer, at least one and
as many row visits. Labels count alike, whatever their shares. A fifth of the
rows is not trained on but calibrates: the logit is shifted so that the score
0.7 parts their labels best, and each language gets a threshold of its own, on
the score, for callers that flag by language; for both the rows are counted by
logit in steps of 1 / STEPS. Neither language nor source nor id enters a score.
``fit`` with ``rows`` trains on a hash sample instead, on the driver.

Defined results: a null or empty text has no words and gets the score of a
text whose filters are silent; without both labels in the rows every score
is 0; repeated rows are scored one by one; labels without a document and
null labels are ignored; only the columns named here are read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from itertools import count, groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import release, released, slices, small_batches, stored

BUCKETS, DIM = 1 << 20, 8
WIDTHS, FILTERS = (1, 2, 3, 5), 6
PREFIXES = (3, 4, 5, 6)
TRAIN_ROWS, TRAIN_CHARS, TRAIN_TOTAL = 4096, 60_000, 1 << 26
EPOCHS, BATCH, RATE, LEAST_DOCS = 8, 32, 0.02, 4
SHARD_ROWS, BATCH_WORDS = 4096, 1 << 17
BLOCK, STEPS, BROADCAST_LABELS = 1 << 14, 256, 1_000_000
THRESHOLD = 0.7
CACHE_WORDS, SLICE_CHARS, LEARN_CHARS = 400_000, 1 << 20, 1 << 18
LONG_WORD = 64  # bytes
_LETTERS = re.compile(r"[\W\d_]+")
_NO_LETTERS = re.compile(r"(?:[^\w\n]|[\d_])+")


def word_features(chunk: str) -> tuple[int, ...]:
    """Buckets of a white-space separated chunk: of its lower-cased letters
    and of their first few; none if it has no letters."""
    w = _LETTERS.sub("", chunk.lower())
    if not w:
        return ()
    parts = [w, *(f"^{w[:n]}" for n in PREFIXES if len(w) >= n)]
    return tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts)


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = crc >> np.uint32(1) ^ np.where(crc & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return crc


_CRC = _crc_table()
_FULL = np.uint32(0xFFFFFFFF)


def features_of(chunks: Sequence[str]) -> np.ndarray:
    """``word_features`` of white-space separated chunks, a row each; -1 where
    a chunk has fewer. Bytes are taken column by column of all words."""
    out = np.full((len(chunks), 1 + len(PREFIXES)), -1, np.int32)
    if not len(chunks):
        return out
    data = np.frombuffer((_NO_LETTERS.sub("", "\n".join(chunks).lower()) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    end = np.flatnonzero(data == 10)
    start = np.append(0, end[:-1] + 1)
    long = end - start > LONG_WORD
    for i in np.flatnonzero(long).tolist():
        f = word_features(chunks[i])
        out[i, :len(f)] = f
    todo = np.flatnonzero(~long & (end > start))
    todo = todo[np.argsort(start[todo] - end[todo], kind="stable")]  # long ones first
    at, size = start[todo], (end - start)[todo]
    own = np.full(len(todo), _FULL)
    head = np.full(len(todo), _CRC[(int(_FULL) ^ ord("^")) & 255] ^ _FULL >> np.uint32(8))
    letters = np.zeros(len(todo), np.int8)
    for j in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -j))  # words of more than j bytes
        byte = data[at[:n] + j]
        own[:n] = _CRC[(own[:n] ^ byte) & 255] ^ own[:n] >> np.uint32(8)
        if j < 4 * max(PREFIXES):
            head[:n] = _CRC[(head[:n] ^ byte) & 255] ^ head[:n] >> np.uint32(8)
            whole = data[at[:n] + j + 1] & 0xC0 != 0x80  # the last byte of a letter
            letters[:n] += whole
            for k, length in enumerate(PREFIXES, 1):
                if j + 1 >= length:
                    hit = np.flatnonzero(whole & (letters[:n] == length))
                    out[todo[hit], k] = (head[hit] ^ _FULL) % BUCKETS
    out[todo, 0] = (own ^ _FULL) % BUCKETS
    return out


@dataclass
class Model:
    """Embeddings of the buckets kept, filters and the logistic layer."""
    row: dict[int, int] = field(default_factory=dict)  # bucket -> row of emb; row 0 is zero
    emb: np.ndarray = field(default_factory=lambda: np.zeros((1, DIM), np.float32))
    conv: list[np.ndarray] = field(default_factory=list)  # per width: (width, DIM, FILTERS)
    bias: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    out_bias: float = 0.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    name: str = ""


def _pool(x: np.ndarray, word: np.ndarray, starts: np.ndarray, conv, bias):
    """Features of documents laid one after another in ``x`` (each followed
    by zero rows, where no window starts); also what the gradient needs."""
    feats, state = [], []
    for w, b in zip(conv, bias):
        width = len(w)
        n = len(x) - width + 1
        a = x[:n] @ w[0]
        for j in range(1, width):
            a += x[j:j + n] @ w[j]
        a += b
        np.maximum(a, 0, out=a)
        a[~word[:n]] = 0
        top = np.maximum.reduceat(a, starts)
        total = np.add.reduceat(a, starts)
        feats += [top, np.log1p(total)]
        state.append((a, top, total))
    return np.concatenate(feats, axis=1), state


def _lay_out(docs: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows of documents, each with its closing zero rows -> (rows,
    whether a row is a word, starts)."""
    pad, width = max(WIDTHS) - 1, docs[0].shape[1]
    gap = np.zeros((pad + 1, width), np.int64)
    lengths = np.array([len(d) for d in docs])
    starts = np.cumsum(lengths + len(gap)) - lengths - len(gap)
    rows = np.concatenate([x for d in docs for x in (d, gap)] + [gap])
    word = np.zeros(len(rows), bool)
    step = np.zeros(len(rows) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    word[:] = np.cumsum(step)[:-1] > 0
    return rows, word, starts


class Net:
    """The net while it is trained, by Adagrad. Parameters: embeddings of the
    buckets ``keys`` (row 0 is zero), filters, their biases, logistic layer."""

    def __init__(self, keys: np.ndarray, params: list[np.ndarray] | None = None, square: list[np.ndarray] | None = None,
                 rng: np.random.Generator | None = None):
        self.keys = keys
        if params is None:
            emb = rng.normal(0, 0.1, (len(keys) + 1, DIM)).astype(np.float32)
            emb[0] = 0
            conv = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) / w for w in WIDTHS]
            bias = [np.full(FILTERS, -0.05, np.float32) for _ in WIDTHS]
            params = [emb, *conv, *bias, rng.normal(0, 0.1, 2 * FILTERS * len(WIDTHS)).astype(np.float32), np.zeros(1, np.float32)]
            square = [np.full(p.shape, 1e-6, np.float32) for p in params]
        self.params, self.square = params, square

    def rows_of(self, buckets: np.ndarray) -> np.ndarray:
        """Rows of the embeddings; 0 for a bucket that has none."""
        if not len(self.keys):
            return np.zeros(buckets.shape, np.int64)
        i = np.searchsorted(self.keys, buckets)
        i[i == len(self.keys)] = 0
        return np.where(self.keys[i] == buckets, i + 1, 0)

    def step(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        """One mini-batch of documents as rows of embeddings; the rows changed."""
        params, square, n = self.params, self.square, len(WIDTHS)
        emb, conv, bias, out, out_b = params[0], params[1:1 + n], params[1 + n:1 + 2 * n], params[-2], params[-1]
        words, word, starts = _lay_out(docs)
        x = emb[words].sum(axis=1)
        feats, state = _pool(x, word, starts, conv, bias)
        z = feats @ out + out_b[0]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(docs)
        if weight is not None:
            g = g * weight
        grads = {len(params) - 2: feats.T @ g + 1e-4 * out, len(params) - 1: np.array([g.sum()], np.float32)}
        gx = np.zeros_like(x)
        gf = g[:, None] * out[None]
        ends = np.append(starts[1:], len(x))
        doc_of = np.repeat(np.arange(len(docs)), ends - starts)
        for f, (w, (a, top, total)) in enumerate(zip(conv, state)):
            g_top = gf[:, 2 * f * FILTERS:(2 * f + 1) * FILTERS]
            g_sum = gf[:, (2 * f + 1) * FILTERS:(2 * f + 2) * FILTERS] / (1 + total)
            d = doc_of[:len(a)]
            ga = g_sum[d] + np.where(a == top[d], g_top[d], 0)
            ga *= a > 0
            gw = np.empty_like(w)
            for j in range(len(w)):
                gw[j] = x[j:j + len(a)].T @ ga
                gx[j:j + len(a)] += ga @ w[j].T
            grads[1 + f], grads[1 + n + f] = gw, ga.sum(axis=0)
        hot, used = np.flatnonzero(np.abs(gx).max(axis=1) > 0), np.zeros(0, np.int64)
        if len(hot):
            ids = words[hot].ravel()
            at = np.flatnonzero(ids)  # row 0 stays zero
            at = at[np.argsort(ids[at], kind="stable")]
            ids = ids[at]
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else used
            used = ids[first]
            ge = np.add.reduceat(gx[hot[at // words.shape[1]]], first, axis=0) if len(ids) else np.zeros((0, DIM), np.float32)
            square[0][used] += ge * ge
            emb[used] -= 2 * RATE * ge / np.sqrt(square[0][used])
        for i, gr in grads.items():
            square[i] += gr * gr
            params[i] -= (RATE * gr / np.sqrt(square[i])).astype(np.float32)
        return used

    def model(self) -> Model:
        n, p = len(WIDTHS), self.params
        model = Model({int(b): i + 1 for i, b in enumerate(self.keys)}, p[0], p[1:1 + n], p[1 + n:1 + 2 * n], p[-2], float(p[-1][0]))
        model.name = f"{zlib.crc32(p[0].tobytes()):08x}{zlib.crc32(p[-2].tobytes()):08x}"
        return model


def train(docs: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit the net. ``docs``: per document an array (words, buckets), -1 where
    a word has fewer buckets. Buckets in fewer than LEAST_DOCS documents and
    those that only one label has by chance alone stay zero by decay."""
    rng = np.random.default_rng(seed)
    seen: dict[int, int] = {}
    for d in docs:
        for b in np.unique(d):
            seen[int(b)] = seen.get(int(b), 0) + 1
    net = Net(np.array(sorted(b for b, n in seen.items() if n >= LEAST_DOCS and b >= 0), np.int64), rng=rng)
    laid, y = [net.rows_of(d) for d in docs], labels.astype(np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            net.step([laid[i] for i in pick], y[pick])
        net.params[0] *= 0.98
    return net.model()


def logits(model: Model, docs: Sequence[np.ndarray]) -> np.ndarray:
    """``docs``: per document an array (words, rows of emb)."""
    if not docs:
        return np.zeros(0)
    words, word, starts = _lay_out(docs)
    feats, _ = _pool(model.emb[words].sum(axis=1), word, starts, model.conv, model.bias)
    return feats @ model.out + model.out_bias


def _best_cut(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut of the largest F1 (weighted rows); the middle of the gap."""
    order = np.argsort(-z, kind="stable")
    z, tp = z[order], np.cumsum((y * weight)[order])
    all_, pos = np.cumsum(weight[order]), float((y * weight).sum())
    f1 = 2 * tp / (all_ + pos)
    f1[:-1][z[:-1] == z[1:]] = -1  # equal scores are not parted
    i = int(f1.argmax())
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i] - 0.5)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


LOGIT = float(np.log(THRESHOLD / (1 - THRESHOLD)))


def held_out(doc_id):
    """Whether a row is never learnt from."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3) == 1


def _featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    width = 1 + len(PREFIXES)
    for b in batches:
        out = []
        for t in b["text"]:
            rows = [f + (-1,) * (width - len(f)) for f in map(word_features, (t or "").split()) if f]
            out.append(np.array(rows, "<i4").reshape(-1, width).tobytes())
        yield pd.DataFrame({"doc_id": b["doc_id"], "lang": b["lang"], "toxic": b["toxic"], "words": out})


def _within(rows: list, chars: int) -> list:
    """As many rows in hash order, labels in turn, as have so many characters."""
    place: dict[int, int] = {}
    order = []
    for r in sorted(rows, key=lambda r: (r["h"], r["doc_id"], r["toxic"])):
        place[r["toxic"]] = place.get(r["toxic"], -1) + 1
        order.append((place[r["toxic"]], r["toxic"], r))
    order.sort(key=lambda x: x[:2])
    total = np.cumsum([r["chars"] for *_, r in order])
    return [r for (*_, r), t in zip(order, total) if t <= chars]


def fit(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> Model:
    """Train on all labelled documents that are not held out, or on a hash
    sample of at most ``rows`` of them. The driver gives back the memory of
    the training."""
    try:
        y, prior = _labels(labels)
        if len(prior) < 2:
            return Model()
        return _fit_all(docs, y, prior) if rows is None else _fit(docs, y, prior, rows)
    finally:
        release()


def _labels(labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Labels that may be learnt, and their numbers."""
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
         .where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))))
    return y, {r["toxic"]: r["n"] for r in y.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


class _Ids:
    """Ids of words; ``values`` gives what is kept of new ones, an array of a
    row each. Each word is looked up once."""

    def __init__(self, values, width: int, dtype):
        self.values, self.ids = values, defaultdict(count().__next__)
        self.table = np.zeros((1 << 12, width), dtype)  # grows by doubling

    def of(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Rows of ``table`` of the words of each text."""
        if len(self.ids) > CACHE_WORDS:
            self.ids = defaultdict(count().__next__)
        n, known = len(self.ids), self.ids
        at = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in map(str.split, texts)]
        new = list(islice(known, n, None))
        while len(known) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if new:
            self.table[n:len(known)] = self.values(new)
        return at


class _Rows:
    """Words with letters as rows of embeddings."""

    def __init__(self, net: Net):
        # a word without letters has -1 only
        self.ids = _Ids(lambda new: np.where((f := features_of(new))[:, :1] < 0, -1, net.rows_of(f)), 1 + len(PREFIXES), np.int32)

    def of(self, texts: Sequence[str]) -> list[np.ndarray]:
        rows = (self.ids.table[at] for at in self.ids.of(texts))
        return [x[x[:, 0] >= 0] for x in rows]

    def each(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        """Rows whose first value is a text, with its words instead."""
        held, chars = [], 0
        for r in rows:
            held.append(r)
            chars += len(r[0])
            if chars >= LEARN_CHARS:
                yield from ((x, *h[1:]) for x, h in zip(self.of([h[0] for h in held]), held))
                held, chars = [], 0
        yield from ((x, *h[1:]) for x, h in zip(self.of([h[0] for h in held]), held))


@released
def _bucket_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(bucket, documents that have it) of a task."""
    counts, ids = np.zeros(BUCKETS, np.int64), _Ids(features_of, 1 + len(PREFIXES), np.int32)
    for b in batches:
        texts = b["text"].tolist()
        for part in slices(texts, LEARN_CHARS):
            for at in ids.of(texts[part]):
                own = np.unique(ids.table[at])
                counts[own[own >= 0]] += 1
    some = np.flatnonzero(counts)
    for lo in range(0, len(some), BLOCK):
        part = some[lo:lo + BLOCK]
        yield pd.DataFrame({"bucket": part, "n": counts[part]})


def _batches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """(document, label, weight) as mini-batches."""
    held, words = [], 0
    for r in rows:
        held.append(r)
        words += len(r[0])
        if len(held) >= BATCH or words >= BATCH_WORDS:
            yield held
            held, words = [], 0
    if held:
        yield held


def _round(start, weight: dict[int, float]):
    """A round: rows (shard, toxic, text), sorted by shard -> per shard and
    block of embeddings the changes, as (block, rows, changes of values and of
    squares); block -1 has all other parameters."""
    def shard_changes(rows: Iterator[tuple[int, str]]) -> Iterator[tuple]:
        keys, params, square = start.value
        net = Net(keys, [p.copy() for p in params], [q.copy() for q in square])
        look, changed = _Rows(net), np.zeros(len(params[0]), bool)
        for part in _batches((d, v, weight[v]) for d, v in look.each((t, v) for v, t in rows)):
            docs, y, w = zip(*part)
            changed[net.step(list(docs), np.array(y, np.float32), np.array(w, np.float32))] = True
        rest = [np.concatenate([(n - p).ravel() for n, p in zip(new[1:], old[1:])]) for new, old in ((net.params, params), (net.square, square))]
        yield -1, b"", np.concatenate(rest).astype("<f4").tobytes()
        at = np.flatnonzero(changed)
        for lo in np.unique(at // BLOCK).tolist():
            i = at[at // BLOCK == lo]
            yield lo, (i - lo * BLOCK).astype("<i4").tobytes(), np.concatenate([net.params[0][i] - params[0][i], net.square[0][i] - square[0][i]], 1).astype("<f4").tobytes()

    @released
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = (r for b in batches for r in zip(b["shard"], b["toxic"], b["text"]))
        for _, rows in groupby(each, key=lambda r: r[0]):
            for x in shard_changes((int(v), t) for _, v, t in rows):
                yield pd.DataFrame([x], columns=["block", "at", "change"])
    return run


@released
def _averaged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Changes sorted by block -> per block their mean, an embedding's over
    the shards that changed it."""
    each = (r for b in batches for r in zip(b["block"], b["at"], b["change"]))
    for block, rows in groupby(each, key=lambda r: r[0]):
        total, n = 0.0, 0
        if block >= 0:
            total, n = np.zeros((BLOCK, 2 * DIM)), np.zeros((BLOCK, 1))
        for _, at, change in rows:
            x = np.frombuffer(change, "<f4")
            if block < 0:
                total, n = total + x, n + 1
            else:
                i = np.frombuffer(at, "<i4")
                total[i] += x.reshape(-1, 2 * DIM)
                n[i] += 1
        yield pd.DataFrame([(block, (total / np.maximum(n, 1)).astype("<f4").tobytes())], columns=["block", "change"])


def _trained(learn: DataFrame, n: int, prior: dict[int, int], seed: int = 7) -> Net:
    """``learn``: doc_id, toxic, text of ``n`` rows."""
    spark = learn.sparkSession
    counts = learn.select("text").mapInPandas(_bucket_documents, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    keys = np.sort(np.array([r["bucket"] for r in counts.where(F.col("n") >= LEAST_DOCS).select("bucket").collect()], np.int64))  # BUCKETS at most
    net = Net(keys, rng=np.random.default_rng(seed))
    shards = max(1, -(-n // SHARD_ROWS))
    rounds = EPOCHS if shards == 1 else min(EPOCHS, -(-EPOCHS * SHARD_ROWS // n))
    weight = {v: sum(prior.values()) / (2 * c) for v, c in prior.items()}
    dealt = learn.select(F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(shards)).cast("int").alias("shard"), "doc_id", "toxic", "text")
    for e in range(rounds):
        start = spark.sparkContext.broadcast((keys, net.params, net.square))
        spread = dealt.repartition(4 * shards, "shard")  # few shards share a task
        rows = spread.sortWithinPartitions("shard", F.xxhash64("doc_id", "text", F.lit(e)), "doc_id", "toxic")
        changes = rows.select("shard", "toxic", "text").mapInPandas(_round(start, weight), "block int, at binary, change binary")
        blocks = len(net.params[0]) // BLOCK + 2
        mean = changes.repartition(min(shards, blocks), "block").sortWithinPartitions("block").mapInPandas(_averaged, "block int, change binary").collect()
        for r in mean:  # the weights once
            x = np.frombuffer(r["change"], "<f4")
            if r["block"] >= 0:
                own = slice(r["block"] * BLOCK, min((r["block"] + 1) * BLOCK, len(net.params[0])))
                x = x.reshape(BLOCK, 2 * DIM)[:own.stop - own.start]
                net.params[0][own] += x[:, :DIM]
                net.square[0][own] += x[:, DIM:]
                continue
            for p in (*net.params[1:], *net.square[1:]):
                p += x[:p.size].reshape(p.shape)
                x = x[p.size:]
        start.unpersist()
        net.params[0] *= 0.98
    return net


def _logit_steps(model: Model):
    """(lang, toxic, aside, text) -> numbers of rows by logit, in steps."""
    keys, model = np.array(sorted(model.row), np.int64), replace(model, row={})  # arrays go to the tasks

    @released
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look = _Rows(Net(keys, [model.emb], []))
        for b in batches:
            z = np.concatenate([logits(model, [d for d, in part]) for part in _batches(look.each((t,) for t in b["text"]))]) if len(b) else np.zeros(0)
            yield pd.DataFrame({"lang": b["lang"], "toxic": b["toxic"], "step": np.round(np.clip(z, -40, 40) * STEPS).astype(np.int64)})
    return run


def _fit_all(docs: DataFrame, y: DataFrame, prior: dict[int, int]) -> Model:
    small_batches(docs)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang")
    y = F.broadcast(y) if sum(prior.values()) <= BROADCAST_LABELS else y
    aside = (F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string")).cast("binary")) % 5 == 0).alias("aside")
    rows = stored(d.join(y, "doc_id").select("doc_id", "lang", "toxic", "text", aside), "toxicity-rows")
    have = {(r["aside"], r["toxic"]): r["n"] for r in rows.groupBy("aside", "toxic").agg(F.count("*").alias("n")).collect()}
    learn = {v: have.get((False, v), 0) for v in (0, 1)}
    if not all(learn.values()):
        return Model()
    model = _trained(rows.where(~F.col("aside")).select("doc_id", "toxic", "text"), sum(learn.values()), learn).model()
    apart = have.get((True, 0), 0) and have.get((True, 1), 0) >= 20
    cal = (rows.where("aside") if apart else rows).select("lang", "toxic", "text")
    steps = cal.mapInPandas(_logit_steps(model), "lang string, toxic int, step long").groupBy("lang", "toxic", "step").agg(F.count("*").alias("n")).toPandas()
    z, label, weight = steps["step"].to_numpy() / STEPS, steps["toxic"].to_numpy(float), steps["n"].to_numpy(float)
    model.shift = LOGIT - _best_cut(z, label, weight)
    for lang in sorted({v for v in steps["lang"] if v}):
        own = (steps["lang"] == lang).to_numpy()
        if len(set(label[own])) == 2 and (label * weight)[own].sum() >= 10:
            model.thresholds[lang] = float(sigmoid(_best_cut(z[own], label[own], weight[own]) + model.shift))
    return model


def _fit(docs: DataFrame, y: DataFrame, prior: dict[int, int], rows: int) -> Model:
    # ids first: a few thousand rows, so the documents are filtered where they are read
    h = F.xxhash64("doc_id")
    ids = [r for v in (0, 1) for r in y.where(F.col("toxic") == v).select("doc_id", "toxic", h.alias("h"))
           .orderBy("h", "doc_id").limit(rows // 2).collect()]
    few = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in ids], "doc_id long, toxic int")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(F.length("text") <= TRAIN_CHARS)
    one = (d.join(F.broadcast(few), "doc_id").groupBy("doc_id", "toxic")
           .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("t")))
    one = stored(one.select("doc_id", "toxic", "t.text", "t.lang", h.alias("h")), "toxicity-sample")  # a row an id
    held = [r["doc_id"] for r in _within(one.select("doc_id", "toxic", "h", F.length("text").alias("chars")).collect(), TRAIN_TOTAL)]
    got = one.where(F.col("doc_id").isin(held)) if len(held) < len(ids) else one
    got = got.select("doc_id", "lang", "toxic", "text").mapInPandas(_featurize, "doc_id long, lang string, toxic int, words binary").toPandas()
    got = got.sort_values(["doc_id", "toxic"]).reset_index(drop=True)
    if got["toxic"].nunique() < 2:
        return Model()
    width = 1 + len(PREFIXES)
    x = [np.frombuffer(w, "<i4").astype(np.int64).reshape(-1, width) for w in got.pop("words")]
    label = got["toxic"].to_numpy(np.float64)
    aside = np.array([zlib.crc32(f"calibrate {i}".encode()) % 5 == 0 for i in got["doc_id"]])
    learn = [i for i in range(len(x)) if not aside[i]]
    if len(set(label[learn])) < 2:
        return Model()
    model = train([x[i] for i in learn], label[learn])
    known = [np.vectorize(lambda b: model.row.get(int(b), 0), otypes=[np.int64])(d) if len(d) else d for d in x]
    z = np.concatenate([logits(model, known[lo:lo + 64]) for lo in range(0, len(known), 64)])
    weight = np.array([prior[int(v)] / max(1, int((label == v).sum())) for v in label])
    cal = aside if len(set(label[aside])) == 2 and label[aside].sum() >= 20 else np.ones(len(label), bool)
    cut = _best_cut(z[cal], label[cal], weight[cal])
    model.shift = LOGIT - cut
    for lang in sorted({v for v in got["lang"] if v}):
        own = cal & (got["lang"] == lang).to_numpy()
        if len(set(label[own])) == 2 and label[own].sum() >= 10:
            model.thresholds[lang] = float(sigmoid(_best_cut(z[own], label[own], weight[own]) + model.shift))
    return model


def _scorer(model: Model):
    buckets, rows_of = (np.fromiter(x, np.int64, len(model.row)) for x in (model.row.keys(), model.row.values()))
    model = replace(model, row={})  # arrays go to the tasks

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = np.zeros(BUCKETS + 1, np.int32)  # the last for -1
        row[buckets] = rows_of
        words = _Ids(lambda new: model.emb[row[features_of(new)]].sum(axis=1), DIM, np.float32)
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            score = np.zeros(len(texts))
            for part in slices(texts, SLICE_CHARS) if model.out is not None else ():
                rows, word, starts = _lay_out([at.reshape(-1, 1) + 1 for at in words.of(texts[part])])
                x = words.table[rows[:, 0] - 1]
                x[~word] = 0
                feats, _ = _pool(x, word, starts, model.conv, model.bias)
                score[part] = sigmoid(feats @ model.out + model.out_bias + model.shift)
            columns = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*b.schema.names[:-1], "score"])
    return run


def _scored(docs: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """row (the ``keep`` columns), score and lang_threshold; map-only."""
    small_batches(docs)
    d = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col("lang").alias("lang"), F.col("text").alias("text"))
    schema = StructType([*d.schema.fields[:-1], StructField("score", DoubleType())])
    out = d.mapInArrow(_scorer(model), schema)
    own = F.lit(THRESHOLD)
    for lang, t in model.thresholds.items():
        own = F.when(F.col("lang") == lang, F.lit(t)).otherwise(own)
    return out.select("row", "score", own.alias("lang_threshold"))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with score (0 to 1), predicted (score >= 0.7) and
    lang_threshold, the calibrated one of the row's language, for callers
    that flag by language; map-only."""
    return _scored(docs, model, keep).select("row.*", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "lang_threshold")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold of their
    language (0.7 where it has none); map-only."""
    return _scored(docs, model, docs.columns).where("score < lang_threshold").select("row.*")
