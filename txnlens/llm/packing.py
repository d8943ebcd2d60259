"""Operator 3: packing by concatenate and cut.

Every document becomes its token ids and one closing id. The first pass
writes the ids, with each document's place among the tokens of its run: the
rows that its task reads of one file without a gap. A prefix sum over the
runs' token totals (one row a task and file, or a few), in the order of files
by name and of rows in a file, gives every document its global offset, so the
stream has the order in which a table was written; rows that are not read
from Parquet files are taken task by task. The second pass cuts the stream at
fixed windows: a document that crosses a boundary gives one record for each
window it touches. Sequences are full but for the last one, so nothing needs
to be padded inside the stream; a document belongs to the window grid by its
offset alone, so neither long documents nor hot sources gather in a task.

Defined results: a null or empty text is the closing id alone; repeated rows
are packed one by one; an empty table gives no pieces; control strings of the
tokenizer inside a text are ordinary text; only doc_id and text are read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import released, slices, small_batches, stored

SEQUENCE = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 800_000  # of a task; a full cache is emptied, results don't change
SLICE_CHARS = 4 << 20
IDS = "doc_id long, file string, at_row long, task int, before long, doc_tokens long, ids binary"
_SCAN = re.compile(r"[\s:+-]*(Project|SubqueryAlias|Relation)\b|$")
RUN = ["file", "at_row", "task"]  # in the order of the stream
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# Characters whose normal form, case and class are plain: printable ASCII and
# the Latin letters up to U+017F, without U+0130.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
# The vocabulary's own splitting rule, on such characters in lower case.
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u017f]+|[0-9]|[^a-z0-9\u00c0-\u017f]+")


def _byte_letters() -> dict[int, str]:
    """Code point -> the letters that byte-level vocabularies write for its
    UTF-8 bytes: a printable Latin-1 byte stands for itself, the others are
    numbered from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letter = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in letter:
            letter[b] = chr(256 + len(letter) - len(shown))
    return {c: "".join(letter[x] for x in chr(c).encode()) for c in range(33, 0x180)}


class WordTokens:
    """Token ids of texts, by the white-space separated words of a text.

    The tokenizer's own splitting never joins characters across a space or a
    new line, so the ids of a text are those of its words one after another;
    a word is tokenized once as long as it is in the cache. Words of plain
    characters are split here and go to the tokenizer's model past its
    normaliser; all others take the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.whole.encode_special_tokens = self.model.encode_special_tokens = True
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        self.closes = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab(False).items():
            self.closes[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}

    def _learn(self, missing: list[str]) -> None:
        if len(self.known) + len(missing) > CACHE_WORDS:
            self.known.clear()
        plain, other, fits = [], [], _PLAIN.fullmatch
        for w in missing:
            (plain if fits(w) else other).append(w)
        for lo in range(0, len(other), 4096):
            part = other[lo:lo + 4096]
            for w, e in zip(part, self.whole.encode_batch_fast(part, add_special_tokens=False)):
                self.known[w] = array("H", e.ids).tobytes()
        # plain words go in lines of many; the tokens that end a piece tell them apart
        find, letters = _SPLIT.findall, self.letters
        for lo in range(0, len(plain), 8192):
            part = plain[lo:lo + 8192]
            pieces = [find(w.lower()) for w in part]
            lines = [" ".join([x for w in pieces[i:i + 256] for x in w]).translate(letters) for i in range(0, len(part), 256)]
            ids = np.array([i for e in self.model.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], np.int64)
            ends = np.append(0, np.flatnonzero(self.closes[ids]) + 1)[np.cumsum([0, *map(len, pieces)])]
            flat, at = ids.astype("<u2").tobytes(), (2 * ends).tolist()
            self.known.update((w, flat[i:j]) for w, i, j in zip(part, at, at[1:]))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 16-bit ids of each text."""
        split = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        every = set().union(*split)
        missing = every.difference(self.known)
        if missing:
            self._learn(list(missing))
            if len(self.known) < len(every):  # the cache was emptied
                self._learn([w for w in every if w not in self.known])
        one = self.known.__getitem__
        return [b"".join(map(one, words)) for words in split]


_TOKENS: dict[str, WordTokens] = {}  # a worker reads a vocabulary once


def word_tokens(path: str) -> WordTokens:
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def _tokenize(path: str, end_id: int):
    @released
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, tok, before = TaskContext.get().partitionId(), word_tokens(path), 0
        file, first, due = None, 0, 0  # of the run, and the row that would go on with it
        end = np.array([end_id], "<u2").tobytes()
        for b in batches:
            texts, doc = [t or "" for t in b["text"]], b["doc_id"].astype("Int64")
            files, rows = b["file"].to_numpy(object), b["at_row"].to_numpy(np.int64)
            for part in slices(texts, SLICE_CHARS):
                ids = [x + end for x in tok.ids(texts[part])]
                n = np.array([len(x) // 2 for x in ids], np.int64)
                f, r = files[part], rows[part]
                if f[0] == "":  # not from files: all of the task is one run
                    r = due + np.arange(len(r))
                new = np.append((f[0] != file) | (r[0] != due), (f[1:] != f[:-1]) | (r[1:] != r[:-1] + 1)).astype(bool)
                cut = [*np.flatnonzero(new).tolist(), len(r)]
                start, run = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
                for i, j in zip([0, *cut] if cut[0] else cut, cut if cut[0] else cut[1:]):
                    if new[i]:
                        first, before = int(r[i]), 0
                    run[i:j], start[i:j] = first, before + np.cumsum(n[i:j]) - n[i:j]
                    before += int(n[i:j].sum())
                file, due = f[-1], int(r[-1]) + 1
                yield pd.DataFrame({"doc_id": doc[part], "file": f, "at_row": run, "task": np.full(len(ids), task, np.int32), "before": start,
                                    "doc_tokens": n, "ids": ids})
        tok.known.clear()  # the worker lives on, in other stages
    return run


def _cut(sequence: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, at = b["doc_tokens"].to_numpy(np.int64), b["at"].to_numpy(np.int64)
            pieces = (at + n - 1) // sequence - at // sequence + 1
            row = np.repeat(np.arange(len(b)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            window = at[row] // sequence + nth
            lo = np.maximum(window * sequence, at[row])
            hi = np.minimum((window + 1) * sequence, at[row] + n[row])
            start, length = lo - at[row], hi - lo
            wide = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in b["ids"]]
            crc = [zlib.crc32(memoryview(wide[i])[4 * s:4 * (s + k)]) for i, s, k in zip(row.tolist(), start.tolist(), length.tolist())]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").to_numpy()[row], "start": start, "length": length,
                                "ids_crc32": np.array(crc, np.int64), "doc_tokens": n[row], "sequence_id": window,
                                "offset": lo - window * sequence})
    return run


def _with_places(docs: DataFrame) -> DataFrame:
    """doc_id, text, and file and row that each row is read from; an empty
    file name for rows that are not read from Parquet files."""
    doc = [F.col("doc_id").cast("long").alias("doc_id"), "text"]
    name = F.col("_metadata.file_path")
    plan = docs._jdf.queryExecution().analyzed().toString()
    if all(map(_SCAN.match, plan.splitlines())):  # each task reads whole pieces of files
        try:  # part-99999 comes before part-100000
            return docs.select(*doc, F.concat(F.lpad(F.length(name).cast("string"), 9, "0"), F.lit(" "), name).alias("file"),
                               F.col("_metadata.row_index").alias("at_row"))
        except AnalysisException:
            pass
    return docs.select(*doc, F.lit("").alias("file"), F.lit(0).cast("long").alias("at_row"))


def token_ids(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """First pass, written: doc_id, the run (RUN), before, doc_tokens, ids."""
    small_batches(docs)
    out = _with_places(docs).mapInPandas(_tokenize(path or vocabulary_path(), end_id), IDS)
    return stored(out, "token-ids")


def pack(docs: DataFrame, sequence: int = SEQUENCE, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """PIECE rows of ``docs`` (doc_id, text)."""
    ids = token_ids(docs, path, end_id)
    totals = ids.groupBy(*RUN).agg(F.sum("doc_tokens").alias("total"))
    # one row for each file that a task of the first pass reads, far below any size that matters
    base = totals.select(*RUN, (F.sum("total").over(Window.orderBy(*RUN)) - F.col("total")).alias("base"))
    at = ids.join(F.broadcast(base), RUN).select("doc_id", "doc_tokens", "ids", (F.col("base") + F.col("before")).cast(LongType()).alias("at"))
    return at.mapInPandas(_cut(sequence), PIECE)
