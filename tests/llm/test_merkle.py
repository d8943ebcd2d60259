"""Operator 11 against a plain recursion over the same rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from txnlens.llm import merkle

from .conftest import CLASH

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n_chars, add=0):
    return h(*map(field, (doc_id, source, lang, None if n_chars is None else n_chars + add, text)))


def fold(nodes, arity):
    """(root, path of (left, right) of each node)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + arity] for i in range(0, len(nodes), arity)]
        for p, a in zip(paths, at):
            run, slot = runs[a // arity], a % arity
            p.append(("".join(run[:slot]), "".join(run[slot + 1:])))
        nodes, at = [h(*r) for r in runs], [a // arity for a in at]
    return nodes[0], paths


def manifest(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        part = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((part, *fold([leaf(*r) for r in part], arity)))
    root, above = fold([t[1] for t in trees], arity) if trees else ("", [])
    out = []
    for (part, sub, paths), over in zip(trees, above):
        for r, low in zip(part, paths):
            acc = leaf(*r, add=int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for left, right in low + over:
                acc = h(left, acc, right)
            out.append((r[0], leaf(*r), sub, root, h(*[x for s in low + over for x in s]), acc, acc == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def plain(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


@pytest.mark.parametrize("arity,levels", [(2, 10), (2, 1), (3, 2)])
def test_manifest_matches_recursion(spark, odd_docs, arity, levels):
    """Nulls, ties, repeated rows, long texts, clashing columns, and sizes around powers of the arity."""
    extra = [(None, "a", "en", None, None), (None, None, "en", None, 3), (None, None, None, None, None), (7, "same", "é", "s", 4), (7, "same", "é", "s", 4),
             (7, "other", "é", "s", None), (2**63 - 1, "x", "zz", "", 2**63 - 1)]
    extra += [(i, str(i), f"g{g}", "s", i) for g in (1, 2, 3, 4, 5, 8, 9) for i in range(g)]
    docs = odd_docs.unionByName(spark.createDataFrame(extra, SCHEMA).withColumns({c: F.lit("clash") for c in CLASH})).withColumn("idx", F.lit(1))
    got = rows_of(merkle.verify_documents(docs, arity, levels))
    want = manifest(plain(docs), arity)
    assert got == want and {r[-1] for r in got} == {True, False}


def test_hot_group_is_spread(spark):
    """One group of most rows: no window or join holds more than a block of it."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id) AS text", "if(id % 50 = 0, null, 'en') AS lang", "'s' AS source", "id AS n_chars")
    m = merkle.merkle_manifest(merkle.document_leaves(docs), "lang", ["doc_id"], levels=4)
    assert m.select(F.max(F.size("path"))).first()[0] == 13  # 12 levels of 2,940 rows, and one of two groups
    assert rows_of(merkle.verify_documents(docs, levels=4)) == manifest(plain(docs))


def test_single_rows_and_empty_tables(spark, no_docs):
    assert merkle.verify_documents(no_docs).count() == 0
    one = spark.createDataFrame([(1, "", None, None, None)], SCHEMA)
    row = merkle.verify_documents(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == h() and row["verified"]
