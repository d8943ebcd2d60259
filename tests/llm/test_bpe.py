"""Operator 12 against the tokenizers library, and against plain merging."""

import hashlib
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txnlens.llm import bpe, queries

from ..conftest import SF001
from .conftest import CLASH, pairs

PATH = bpe.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(PATH)


def ids_of(blob):
    return np.frombuffer(blob, "<u4").tolist()


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def digests(df):
    return sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect()), key=str)


def test_documents_match_the_library(spark, odd_docs):
    """Nulls, empty and very long texts, repeated rows, null ids, clashing columns."""
    extra = [(None, "no id <|endoftext|> x"), (None, None), (5, "<|endoftext|>"), (5, "<|endoftext|>"), (6, "a <|endoftext|><|endoftext|>\n b  "), (7, "z" * 30_000)]
    docs = odd_docs.select("doc_id", "text", *CLASH).unionByName(spark.createDataFrame(extra, "doc_id long, text string").withColumns({c: F.lit("clash") for c in CLASH}))
    docs = docs.withColumns({c: F.lit("clash") for c in ("ids", "n_tokens", "ids_sha256")})
    assert digests(bpe.bpe_digest(docs)) == sorted(((i, *expected(t)) for i, t in pairs(docs)), key=str)
    back = bpe.decode_documents(bpe.encode_documents(docs))
    assert sorted(map(str, pairs(back))) == sorted(str((i, t or "")) for i, t in pairs(docs))


def test_query_matches_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert digests(queries.QUERIES["op12_bpe_round_trip"](spark, SF001)) == sorted(((i, *expected(t)) for i, t in pairs(docs)), key=str)


def test_no_documents(spark, no_docs):
    assert bpe.bpe_digest(no_docs).count() == bpe.encode_documents(no_docs).count() == bpe.decode_documents(bpe.encode_documents(no_docs)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(" \n\t'slétm<|1² \x1c\x85 ")), max_size=60))
def test_any_text(own, text):
    blob = own.encode([text, text + "<|endoftext|>" + text])
    for b, t in zip(blob, (text, text + "<|endoftext|>" + text)):
        assert ids_of(b) == LIBRARY.encode(t, add_special_tokens=False).ids
    assert own.decode(blob)[0].decode() == text


def test_every_class_of_code_points(own):
    """Words are cut as the library cuts them, whatever the Unicode version."""
    points = [c for c in (*range(1, 0x3000), *range(0x3000, 0x110000, 61), *range(0xa7c0, 0xa800), *range(0x10930, 0x10960)) if not 0xd800 <= c < 0xe000]
    texts = [form.replace("%", chr(c)) for c in points for form in ("a%a 1%1", "!%! x % y")]
    got = own.encode(texts)
    want = LIBRARY.encode_batch(texts, add_special_tokens=False)
    assert [t for t, g, w in zip(texts, got, want) if ids_of(g) != w.ids] == []


def plain_merges(symbols, rank):
    """One lowest, leftmost pair at a time."""
    while True:
        found = min(((rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank), default=None)
        if found is None:
            return symbols
        i = found[1]
        symbols = symbols[:i] + [symbols[i] + symbols[i + 1]] + symbols[i + 2:]


def test_rounds_equal_single_merges(own):
    spec = json.load(open(PATH))["model"]
    rank = {tuple(m): i for i, m in enumerate(spec["merges"])}
    rng = random.Random(7)
    letters = bpe.byte_letters()
    words = ["".join(rng.choice(a) for _ in range(rng.randint(1, 60))) for a in ("a", "ab", "the ", "etaoinsr", "=-", "éß中") for _ in range(20)]
    flat, count = own.merged([w.encode() for w in words])
    at = np.append(0, np.cumsum(count))
    for i, w in enumerate(words):
        want = [spec["vocab"][x] for x in plain_merges([letters[b] for b in w.encode()], rank)]
        assert flat[at[i]:at[i + 1]].tolist() == own.merged_long(w.encode()).tolist() == want


def test_ill_formed_bytes_and_small_caches(own, monkeypatch):
    rng = random.Random(8)
    ids = [np.array([rng.randrange(50_257) for _ in range(rng.randint(0, 30))], "<u4") for _ in range(200)]
    assert [t.decode() for t in own.decode([i.tobytes() for i in ids])] == [LIBRARY.decode(i.tolist(), skip_special_tokens=False) for i in ids]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "BATCH_SYMBOLS", 5)
    texts = ["one two three four five", "two three six " + "seven" * 2000, "one"]
    assert [ids_of(b) for t in texts for b in own.encode([t])] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        bpe.ByteBpe(bpe.vocabulary_path("word_bpe_49k.json"))
