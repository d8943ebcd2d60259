"""Operator 12: byte-level BPE encoding and decoding in batched numpy rounds.

A text is cut at the vocabulary's added tokens, then by its splitting rule
into words. The symbols of many distinct words lie in one flat array; in every
round each pair of neighbours has a rank, found by binary search over the
sorted pair keys (left id * size + right id), each word's lowest rank is taken
by a segmented minimum, and all its pairs of that rank are merged, in a run of
overlapping ones every second. Words without a ranked pair leave the array.
This equals merging one pair at a time: every merge has a result of its own
(checked when the vocabulary is read), so no merge can make a pair of a lower
rank. Only the pairs beside a merge are searched again.

Words of more than LONG symbols take rounds of their own, in ascending rank
over all of the word: the places of each rank wait in a heap of ranks, so a
round touches the places it merges and not the whole word.

Decoding gathers the bytes of the ids, by one index array for a slice of texts.

The splitting rule's classes are those of the library's Unicode version; the
code points outside ``_SURE`` may be newer here, and texts with them are split
by the library's own pre-tokenizer, so every text has the library's ids.

Defined results: null and empty texts have no ids; an added token's string in
a text is that token; ill-formed bytes decode to U+FFFD; repeated rows are
encoded one by one; an empty table gives no rows; very long texts and words
are encoded whole. Map-only: rows stay in their tasks, and only doc_id and
text are read. A task's memory is a slice of texts and a bounded word cache.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

VOCABULARY = "byte_bpe_50k.json"
CACHE_WORDS = 500_000  # of a task; a full cache is emptied, results don't change
SLICE_CHARS = 1 << 20
BATCH_SYMBOLS = 1 << 19
LONG = 4096
NONE = np.iinfo(np.int64).max
ENCODED = "doc_id long, ids binary"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same rule for texts of Latin letters, with their classes written out.
_LETTER, _NUMBER, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_LATIN = re.compile("[\0-\u024f]*")
_LATIN_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
# Code points whose classes differ between no Unicode versions in use.
_SURE = re.compile("[\0-\u0557\u058d-\u07ff\u1000-\u2070\u20a0-\ua63f\uac00-\uffff]*")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 bytes stand for themselves, the others are numbered from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + other.index(b)) for b in range(256)]


class ByteBpe:
    """A byte-level vocabulary file: merge ranks, bytes of the ids, splitting."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, model, pre = spec["model"]["vocab"], spec["model"], spec["pre_tokenizer"] or {}
        plain = not (spec["normalizer"] or model.get("ignore_merges") or model.get("dropout") or model.get("byte_fallback")
                     or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"))
        added = spec["added_tokens"]
        if not plain or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        letter = byte_letters()
        byte_of = {c: b for b, c in enumerate(letter)}
        self.added = {t["content"]: t["id"] for t in added}
        size = 1 + max(max(vocab.values()), *self.added.values())
        token = [b""] * size
        for t, i in vocab.items():
            token[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        for t, i in self.added.items():
            token[i] = t.encode()
        self.first = np.array([vocab[c] for c in letter], np.int64)  # id of each byte
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        if len(np.unique(made)) < len(made):
            raise ValueError("two merges make the same token")
        keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.size, self.keys, self.ranks, self.made = size, keys[order], order.astype(np.int64), made
        self.length = np.array([len(t) for t in token], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(token), np.uint8)
        self.find = regex.compile(SPLIT).findall
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        self.cut = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.known: dict[str, bytes] = {}

    # -- words

    def words(self, text: str) -> list[str]:
        if text.isascii() or _LATIN.fullmatch(text):
            return _LATIN_SPLIT.findall(text)
        if _SURE.fullmatch(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.pre.pre_tokenize_str(text)]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE for pairs without a merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words (none empty) in one flat array, and how many each has."""
        size = np.array([len(w) for w in words], np.int64)
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        rank = np.full(len(sym), NONE)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        done = []
        while len(sym):
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            count = np.diff(np.append(start, len(sym)))
            least = np.minimum.reduceat(rank, start)
            ended = least == NONE
            if ended.any():
                stay = np.repeat(~ended, count)
                done.append((word[~stay], sym[~stay]))
                sym, word, rank, least, count = sym[stay], word[stay], rank[stay], least[~ended], count[~ended]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(least, count))  # least < NONE here
            at = at[_every_second(at)]
            sym[at] = self.made[rank[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            # the places of the merged symbols, after the right ones have gone
            new = at - np.arange(len(at))
            sym, word, rank = sym[stay], word[stay], rank[stay]
            near = np.zeros(len(sym) + 1, bool)  # the last one is for the place before the first
            near[new] = near[new - 1] = True
            beside = np.flatnonzero(near[:-1])
            rank[beside] = NONE
            beside = beside[beside + 1 < len(sym)]
            beside = beside[word[beside] == word[beside + 1]]
            rank[beside] = self.rank(sym[beside], sym[beside + 1])
        word, sym = (np.concatenate(x) for x in zip(*done))
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def merged_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: ranks ascend, and a round merges the waiting
        places of one rank; ``after`` and ``prior`` link the symbols left."""
        sym = self.first[np.frombuffer(word, np.uint8)]
        n = len(sym)
        after, prior = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.append(self.rank(sym[:-1], sym[1:]), NONE)
        alive, waiting, heap = np.ones(n, bool), {}, []

        def wait(at):
            at = at[rank[at] < NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            value, first = np.unique(rank[at], return_index=True)
            for r, part in zip(value.tolist(), np.split(at, first[1:])):
                if r not in waiting:
                    heapq.heappush(heap, r)
                waiting.setdefault(r, []).append(part)
        wait(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            # overlapping pairs: a place whose right symbol is the next place
            linked = np.append(False, after[at[:-1]] == at[1:])
            run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = after[at]
            sym[at], alive[gone] = self.made[r], False
            after[at] = after[gone]
            inside = after[at] < n
            prior[after[at][inside]] = at[inside]
            beside = np.unique(np.concatenate([at, prior[at][prior[at] >= 0]]))
            rank[beside] = NONE
            has = beside[after[beside] < n]
            rank[has] = self.rank(sym[has], sym[after[has]])
            wait(has)
        return sym[alive]

    def _learn(self, missing: list[str]) -> None:
        raw = [w.encode() for w in missing]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG]
        for i, b in enumerate(raw):
            if len(b) > LONG:
                self.known[missing[i]] = self.merged_long(b).astype("<u4").tobytes()
        lo = 0
        while lo < len(short):
            hi, held = lo, 0
            while hi < len(short) and (held < BATCH_SYMBOLS or hi == lo):
                held += len(raw[short[hi]])
                hi += 1
            part = short[lo:hi]
            ids, count = self.merged([raw[i] for i in part])
            flat, at = ids.astype("<u4").tobytes(), (4 * np.append(0, np.cumsum(count))).tolist()
            self.known.update((missing[i], flat[a:b]) for i, a, b in zip(part, at, at[1:]))
            lo = hi

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = []
        for t in texts:
            if self.cut and self.cut.search(t):
                ends, row, a = self.cut.finditer(t), [], 0
                for m in ends:
                    row += [*self.words(t[a:m.start()]), self.added[m[0]]]
                    a = m.end()
                split.append(row + self.words(t[a:]))
            else:
                split.append(self.words(t) if t else [])
        every = set().union(*split)
        tokens = {w for w in every if isinstance(w, int)}
        missing = every.difference(self.known).difference(tokens)
        if missing and len(self.known) + len(missing) > CACHE_WORDS:
            self.known.clear()
            missing = every - tokens
        if missing:
            self._learn(list(missing))
        if tokens:
            self.known.update((i, i.to_bytes(4, "little")) for i in tokens)
        one = self.known.__getitem__
        return [b"".join(map(one, words)) for words in split]

    # -- ids

    def decode(self, blobs: list[bytes]) -> list[bytes]:
        """UTF-8 of the decoded text of each blob of ids."""
        ids = np.frombuffer(b"".join(blobs), "<u4").astype(np.int64)
        size = self.length[ids]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        flat = self.bytes[np.arange(total) + np.repeat(self.start[ids] - (end - size), size)].tobytes()
        at = np.append(0, end)[np.cumsum([0, *[len(b) // 4 for b in blobs]])].tolist()
        return [flat[a:b].decode("utf-8", "replace").encode() for a, b in zip(at, at[1:])]


def _every_second(at: np.ndarray) -> np.ndarray:
    """Of ascending places, the first of each unbroken run and every second after it."""
    place = np.arange(len(at))
    run = np.maximum.accumulate(np.where(np.append(True, at[1:] != at[:-1] + 1), place, 0))
    return (place - run) % 2 == 0


_VOCABULARIES: dict[str, ByteBpe] = {}  # a worker reads a vocabulary once


def byte_bpe(path: str) -> ByteBpe:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = ByteBpe(path)
    return _VOCABULARIES[path]


def _encode(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(path)
        for b in batches:
            texts, doc = [t or "" for t in b["text"]], b["doc_id"].astype("Int64")
            for part in slices(texts, SLICE_CHARS):
                yield pd.DataFrame({"doc_id": doc[part], "ids": bpe.encode(texts[part])})
        bpe.known.clear()  # the worker lives on, in other stages
    return run


def _digest(path: str):
    encode = _encode(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(path)
        for b in encode(batches):
            ids = b["ids"].tolist()
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": np.array([len(x) // 4 for x in ids], np.int64),
                                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                                "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in bpe.decode(ids)]})
    return run


def _decode(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, doc = [bytes(x or b"") for x in b["ids"]], b["doc_id"].astype("Int64")
            for part in slices(ids, 4 * SLICE_CHARS):
                yield pd.DataFrame({"doc_id": doc[part], "text": [t.decode() for t in byte_bpe(path).decode(ids[part])]})
    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of each text."""
    return _texts(docs).mapInPandas(_encode(path or vocabulary_path()), ENCODED)


def decode_documents(ids: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows of ``encode_documents``."""
    return ids.select("doc_id", "ids").mapInPandas(_decode(path or vocabulary_path()), "doc_id long, text string")


def bpe_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the digests of its ids and of the text decoded from them,
    where the ids are made, so neither is moved."""
    return _texts(docs).mapInPandas(_digest(path or vocabulary_path()), DIGEST)
