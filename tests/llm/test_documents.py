"""Operators 3, 4, 5, 7, 9, 10 against brute force and on odd inputs."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnlens.llm import jaccard_join, mixing, order_minhash, packing, suffix_dedup, toxicity
from txnlens.llm.common import small_batches

from ..conftest import SF001, SF01
from . import brute
from .conftest import pairs


def small(spark, sf=SF001):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---- 9: Jaccard join

@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
@pytest.mark.parametrize("which", ["odd", "given"])
def test_jaccard_is_exact(spark, odd_docs, k, num, which):
    d = odd_docs if which == "odd" else small(spark, SF01)
    want = brute.jaccard(pairs(d), k, num, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(d, k, (num, 100)).collect()}
    assert got == want


@pytest.mark.parametrize("letters", [256, 1024, 2048, 4096])
def test_long_words_of_opposite_letters_differ(letters):
    """Words that a polynomial modulo 2**64 makes equal for every odd base."""
    a = "a"
    while len(a) < letters:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    one, other, upper = jaccard_join.shingle_sets([f"{a} x y", f"{b} x y", f"{a.upper()} X y"], 3)
    assert one.tolist() != other.tolist() and one.tolist() == upper.tolist()


def test_jaccard_blocks_and_families(spark):
    """A large family of near copies, joined in many small blocks."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for j in rng.integers(0, 120, rng.integers(0, 9)):
            w[j] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    members = jaccard_join.described(d, 3, 0.2)
    sets = jaccard_join.survivors(d, members, 3, 0.2, 90, 100)
    from txnlens.llm.components import components

    comp = {r["id"]: r["comp"] for r in components(jaccard_join.links(sets, 90, 100, block_rows=8)).collect()}
    want = brute.jaccard(rows, 3, 90, 100)
    least = {}
    reps = [(r["doc_id"], comp.get(r["cid"], r["cid"])) for r in members.groupBy("cid").agg(F.min("doc_id").alias("doc_id")).collect()]
    for i, c in reps:
        least[c] = min(least.get(c, i), i)
    assert sets.count() > 50 and len({want[i][1] for i, _ in reps}) > 3 and all(least[c] == want[i][1] for i, c in reps)


def test_jaccard_null_ids_and_empty(spark, no_docs):
    d = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (None, "z y x w"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.jaccard_components(d, 3, (90, 100)).collect()), key=str)
    assert got == sorted([(None, 2, 7), (7, 2, 7), (None, 2, None), (None, 0, None)], key=str)
    assert jaccard_join.jaccard_components(no_docs).count() == 0
    assert jaccard_join.keep_first(d, 3, (90, 100)).where("doc_id = 7").count() == 1


SHARED_IDS = [(None, "a b c d e f g"), (7, "a b c d e f g"), (None, "z y x w v u"), (None, None), (None, "z y x w v u"), (7, "q r s t u v"),
              (9, "q r s t u v"), (9, "only here to stay"), (3, "m n o p q r s"), (4, "m n o p q r s"), (9, None)]


def test_keep_first_judges_rows_by_their_text(spark, monkeypatch):
    d = spark.createDataFrame(SHARED_IDS, "doc_id long, text string").repartition(3)
    want = sorted([(7, "a b c d e f g"), (None, "z y x w v u"), (None, None), (None, "z y x w v u"), (7, "q r s t u v"),
                   (9, "only here to stay"), (3, "m n o p q r s"), (9, None)], key=str)
    for limit in (jaccard_join.BROADCAST_IDS, 0):  # broadcast and joined
        monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", limit)
        assert sorted(map(tuple, jaccard_join.keep_first(d, 3, (90, 100)).collect()), key=str) == want


def test_keep_first_keeps_one(odd_docs):
    want = brute.jaccard(pairs(odd_docs), 5, 80, 100)
    kept = jaccard_join.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(i for i, (_, c) in want.items() if i == c)


# ---- 7: suffix dedup

@pytest.mark.parametrize("which", ["odd", "given"])
def test_suffix_dedup_is_exact(spark, odd_docs, which):
    d = odd_docs if which == "odd" else small(spark, SF01)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.find_repeats(d).collect()}
    assert got == brute.repeats(pairs(d))


@pytest.mark.parametrize("width", [5, 12, 50])
def test_suffix_dedup_periodic(spark, width):
    """Few letters, long periods: many ties, long common extensions."""
    rng = np.random.default_rng(width)
    rows = [(i, "".join(rng.choice(list("ab"), rng.integers(0, 90))) + "ab" * int(rng.integers(0, 40))) for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.find_repeats(d, width=width).collect()}
    assert got == brute.repeats(rows, width)


def test_suffix_sort_order():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    start = rng.permutation(3900)[:1500]
    order = suffix_dedup.suffix_sort(data, start, 50)
    text = data.tobytes()
    keys = [text[s:s + 50] for s in start[order]]
    assert keys == sorted(keys)


def test_suffix_collisions_are_split(monkeypatch):
    """With a hash that calls all strings equal, verification still tells them apart."""
    real = suffix_dedup.common_extension
    monkeypatch.setattr(suffix_dedup, "common_extension", lambda p, x, y, least, width: np.maximum(real(p, x, y, least, width), width if least == 0 else 0))
    run, _ = suffix_dedup.repeated_windows([b"a" * 50, b"b" * 50, b"a" * 50], np.array([1, 2, 3]), 50)
    assert run.tolist() == [2]


def passage_docs(n, seed=11):
    """One passage, each time in other surroundings; some share an edge too."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    passage, edges = "".join(rng.choice(letters, 90)), ["".join(rng.choice(letters, 20)) for _ in range(3)]
    rows = [(i, "".join(rng.choice(letters, 60)) + edges[i % 5 % 3] * (i % 5 < 3) + passage + "".join(rng.choice(letters, 70))) for i in range(n)]
    return rows


@pytest.mark.parametrize("heavy", [10, 1 << 16])
def test_suffix_hot_anchors_stay_bounded(spark, monkeypatch, heavy):
    """No sort is given an anchor of more suffixes than the limit, and the
    results are those of brute force; frequent windows broadcast or joined."""
    limit, sort, repeats, hot = 150, suffix_dedup._sort_task, suffix_dedup.hot_repeats, []

    def bounded(width, most):
        inner = sort(width, most)

        def run(batches):
            batches, seen = list(batches), {}
            for b in batches:
                for k, y in zip(b.column(0).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                    seen[k] = seen.get(k, 0) + len(y) - width + 1
            assert most == limit and all(n <= limit for n in seen.values())
            yield from inner(iter(batches))
        return run

    monkeypatch.setattr(suffix_dedup, "_sort_task", bounded)
    monkeypatch.setattr(suffix_dedup, "hot_repeats", lambda w, width: hot.append(w.count()) or repeats(w, width, heavy))
    rows = passage_docs(60)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.find_repeats(d, sort_suffixes=limit).collect()}
    assert hot and hot[0] > limit and got == brute.repeats(rows)


def test_suffix_sorts_hold_a_batch_and_an_anchor(monkeypatch):
    """However many anchors a task has, one sort holds a batch of suffixes, and
    the anchor that fills it; all of them are found."""
    import pyarrow as pa

    sort, held = suffix_dedup.repeated_windows, []
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda b, ids, width: held.append(sum(len(x) - width + 1 for x in b)) or sort(b, ids, width))
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 400).astype(np.uint8).tobytes() for _ in range(300)]
    rows = [(a, i, 0, 1000 * a, t) for a, t in enumerate(texts) for i in (1, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["anchor", "id", "tag", "lo", "bytes"])
    got = [(r["id"], r["tag"], r["lo"], r["hi"]) for b in suffix_dedup._sort_task(50)(iter([batch])) for r in b.to_pylist()]
    assert sum(held) == 600 * 351 and max(held) <= suffix_dedup.SORT_BATCH + 2 * 351 and len(held) > 2
    assert got == [(2, 0, 1000 * a, 1000 * a + 400) for a in range(300)]


def test_settled_runs_need_the_whole_hash():
    """Runs of one anchor whose hashes agree in their low 40 bits, or in one
    of the two, are not settled by each other."""
    from txnlens.llm.hashing import from_planes, planes

    one, two = np.uint64(0x1234567890), np.uint64(77)
    run = np.array([one, one | np.uint64(1 << 40), one, one], np.uint64)
    again = np.array([two, two, two | np.uint64(1 << 63), two], np.uint64)
    sent = [from_planes(planes(x, w), w) for x, w in zip((run, again), suffix_dedup._HASHES[1:3])]
    same = np.ones(4, np.uint64)
    code = suffix_dedup.settle(same, *sent, same, same, np.arange(4))
    assert code.tolist() == [suffix_dedup.SORTED] * 3 + [suffix_dedup.SETTLED]


def test_run_hashes_are_independent():
    rng = np.random.default_rng(2)
    raw = [rng.integers(97, 123, 200).astype(np.uint8).tobytes() for _ in range(30)]
    (_, a, lo, hi), p, _, data = suffix_dedup.anchors(raw)
    _, run, again, _, _ = suffix_dedup._run_hashes(p, suffix_dedup.Prefix(data, suffix_dedup.OTHER_BYTE, suffix_dedup.OTHER_BASE), a, lo, hi, 50)
    assert len(set(run.tolist())) == len(set(again.tolist())) == len(a) and not set(run.tolist()) & set(again.tolist())


@pytest.mark.parametrize("ids,sort,rows", [(suffix_dedup.BROADCAST_IDS, 1 << 19, 30), (0, 100, 30)])
def test_suffix_rows_of_one_id_keep_their_own_marks(spark, monkeypatch, ids, sort, rows):
    """Several texts under null and repeated ids: whole copies, copied
    passages, and texts too short for the others' places."""
    monkeypatch.setattr(suffix_dedup, "BROADCAST_IDS", ids)
    texts = [t for _, t in passage_docs(rows)]
    odd = [None, "", "short", texts[0], texts[3], texts[0][:55], texts[1] + texts[2], "n" * 60, "n" * 60]
    data = [(i // 2, t) for i, t in enumerate(texts)] + [(None, t) for t in odd] + [(None, "own " * 40), (2, texts[0]), (2, "s" * 49)]
    d = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(data)], "doc_id long, text string, nr int").repartition(4)
    # brute force, a window's first id at a time
    order, first, want = lambda i: (i is None, i or 0), {}, {}
    for i, t in sorted(data, key=lambda r: order(r[0])):
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], order(i))
    for n, (i, t) in enumerate(data):
        b = (t or "").encode()
        gone = {q for p in range(len(b) - 49) if first[b[p:p + 50]] < order(i) for q in range(p, p + 50)}
        want[n] = (len(gone), bytes(x for q, x in enumerate(b) if q not in gone).decode())
    got = {r["nr"]: (r["n_removed"], r["kept"]) for r in suffix_dedup.find_repeats(d, keep=["nr"], sort_suffixes=sort).collect()}
    assert got == want


def test_suffix_keep_and_empty(odd_docs, no_docs):
    out = suffix_dedup.remove_repeats(odd_docs, keep=["lang", "row"])
    assert out.columns == ["doc_id", "text", "lang", "row"] and out.count() == odd_docs.count()
    assert suffix_dedup.find_repeats(no_docs).count() == 0


# ---- 3: packing

def check_pieces(rows, texts, sequence):
    want = dict(zip(texts, brute.tokens(texts.values(), packing.vocabulary_path())))
    by_doc, taken = {}, set()
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        span = range(r["sequence_id"] * sequence + r["offset"], r["sequence_id"] * sequence + r["offset"] + r["length"])
        assert r["length"] > 0 and r["offset"] + r["length"] <= sequence and taken.isdisjoint(span)
        taken.update(span)
    assert taken == set(range(len(taken)))  # gapless: full sequences but for the last
    for i, ids in want.items():
        at = 0
        for r in sorted(by_doc.pop(i), key=lambda r: r["start"]):
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    assert not by_doc


@pytest.mark.parametrize("sequence", [4096, 64])
def test_packing_pieces(odd_docs, sequence):
    check_pieces(packing.pack(odd_docs, sequence).collect(), dict(pairs(odd_docs)), sequence)


def test_packing_given_and_empty(spark, no_docs):
    d = small(spark)
    check_pieces(packing.pack(d).collect(), dict(pairs(d)), 4096)
    assert packing.pack(no_docs).count() == 0


def test_word_tokens_equal_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)  # the cache is emptied again and again
    texts = ["'" + chr(c) + chr(c + 1) + " A" + chr(c) + " " + chr(c) for c in range(33, 0x250)]
    texts += ["it's 'tis DON'T 12ab a_b __ ''s's ...'ll \u00b2x\u00bd \ufb01 A\u030a\tz\x85q\u3000r \u0130 \u0391\u03a3", "<|endoftext|> x"]
    got = packing.WordTokens(packing.vocabulary_path()).ids(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [x[:-1] for x in brute.tokens(texts, packing.vocabulary_path())]


# ---- 4: mixing

def test_mixing_budgets_and_rows(spark, odd_docs):
    hot = spark.range(2000).select((F.col("id") + 10_000).alias("doc_id"), F.lit("a b c d e f").alias("text"), F.lit("hot").alias("source"))
    d = odd_docs.select("doc_id", "text", "source").unionByName(hot)
    out = mixing.mixture(d, entropy=1.0, repeats=3.0).collect()
    plan = {r["src"]: r for r in mixing.mix_plan(mixing.block_totals(mixing.narrow(d)), 1.0, 3.0).collect()}
    for src, p in plan.items():
        mine = [r for r in out if ("" if r["source"] is None else "=" + r["source"]) == src]
        spans = sorted((r["position"], r["n_tokens"]) for r in mine)
        end = 0
        for at, n in spans:
            assert at == end or n == 0
            end = max(end, at + n)
        assert end <= p["budget"] and len({(r["doc_id"], r["epoch"]) for r in mine}) == len(mine)
        whole = {e: {r["doc_id"] for r in mine if r["epoch"] == e} for e in range(p["epochs"])}
        ids = {r["doc_id"] for r in d.where(F.col("source").eqNullSafe(mine[0]["source"])).collect()}
        assert all(w == ids for w in whole.values()) and p["epochs"] >= 1
    reps = [p["budget"] / p["tokens"] for p in plan.values() if p["tokens"]]
    assert min(reps) == 1 and 2.9 < max(reps) <= 3.0 and abs(sum(p["weight"] for p in plan.values()) - 1) < 1e-9
    rows = mixing.mixed_rows(d, 1.0, 3.0)
    a = sorted(r["doc_id"] for r in out)
    assert sorted(r["doc_id"] for r in rows.select("doc_id").collect()) == a and rows.columns == d.columns


def test_mixing_entropy_limit(spark):
    d = spark.createDataFrame([(i, "a " * 40, "big" if i % 10 else f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    for share in (0.8, 0.95):
        p = mixing.mix_plan(mixing.block_totals(mixing.narrow(d)), share, 1e9).collect()
        w = np.array([r["weight"] for r in p])
        assert abs(-(w * np.log(w)).sum() - share * np.log(len(w))) < 1e-6


def test_mixing_clash_one_source_and_empty(odd_docs, no_docs):
    assert mixing.mixed_rows(odd_docs).columns == odd_docs.columns
    one = odd_docs.withColumn("source", F.lit(None).cast("string"))
    assert sorted(r["doc_id"] for r in mixing.mixture(one).collect()) == sorted(i for i, _ in pairs(odd_docs))
    assert mixing.mixture(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0


def test_mixing_order_reaches_the_packed_stream(spark, odd_docs, tmp_root):
    """Rows are written in the order of epoch, block key and document key, and
    the packed stream has that order, however the files are split for reading."""
    hot = spark.range(600).select((F.col("id") + 10_000).alias("doc_id"), F.lit("a b c d e f").alias("text"), F.lit("hot").alias("source"))
    d = odd_docs.select("doc_id", "text", "source").unionByName(hot)
    mixing.mixed_rows(d, 1.0, 3.0).write.parquet(f"{tmp_root}/mixed")
    src, block = mixing._source(F.col("source")), mixing._block(F.col("doc_id"))
    want = mixing.mixture(d, 1.0, 3.0).orderBy("epoch", mixing._block_key(src, block, F.col("epoch")), mixing._doc_key(F.col("doc_id"), F.col("epoch")))
    want = [r["doc_id"] for r in want.collect()]
    assert want != sorted(want) and len(want) > len(set(want))
    conf = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    for split in ({}, conf):
        for k, v in split.items():
            spark.conf.set(k, v)
        try:
            pieces = packing.pack(spark.read.parquet(f"{tmp_root}/mixed"), 64).collect()
        finally:
            for k in split:
                spark.conf.unset(k)
        got = [r["doc_id"] for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])) if r["start"] == 0]
        assert got == want
    kept = spark.read.parquet(f"{tmp_root}/mixed").where("doc_id % 2 = 0").repartition(3)  # no file order is left
    assert packing.token_ids(kept).select(*packing.RUN).distinct().count() <= 3
    assert packing.pack(kept, 64).agg(F.sum("length")).first()[0] == packing.token_ids(kept).agg(F.sum("doc_tokens")).first()[0]


# ---- 5: Order MinHash

def test_order_minhash_selects_like_brute_force():
    text = "the cat and the cat and the dog " * 3 + "é end"
    k, l, m = order_minhash.K, order_minhash.L, 16
    h = order_minhash.kmer_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), k)
    x, pos = order_minhash.numbered(h)
    of = dict(zip(pos.tolist(), x))
    flip, times = order_minhash._family(m)
    padded, seen, items = "\0" * (k - 1) + text, {}, {}
    for p in range(len(text)):
        g = padded[p:p + k]
        items[g, seen.get(g, 0)] = p
        seen[g] = seen.get(g, 0) + 1

    def mix_all(g, n):
        s = np.uint32(of[items[g, n]] >> np.uint64(32))
        return [int(v) for v in ((s ^ flip) * times).ravel()]

    want = brute.order_minhash(text, k, l, m, mix_all)
    got = order_minhash.components(text, k, l, m)
    for j, places in enumerate(want):
        t = np.zeros(1, np.uint64)
        for p in places:
            t = order_minhash._mix(t * np.uint64(0x9E3779B97F4A7C15) + of[p])
        assert got[j] == t[0]


def test_order_minhash_properties():
    rng = np.random.default_rng(0)
    text = "".join(rng.choice(list("abcdefgh "), 9000))
    a = order_minhash.fingerprint(text)
    assert a == order_minhash.fingerprint(str(text)) and order_minhash.fingerprint("") == "" == order_minhash.fingerprint(None)
    light = order_minhash.likeness(a, order_minhash.fingerprint(text[:4000] + "x" + text[4001:]))
    heavy = order_minhash.likeness(a, order_minhash.fingerprint(text[:4500] + text[::-1][:4500]))
    swapped = order_minhash.likeness(a, order_minhash.fingerprint(text[4500:] + text[:4500]))
    assert light > 0.9 > heavy > 0.02 and 0.2 < swapped < 0.8  # the same k-mers in another order
    assert order_minhash.likeness("", "") == 1 and order_minhash.likeness("", a) == 0


def test_order_minhash_edits(odd_docs, no_docs):
    rows = sorted(pairs(odd_docs))
    got = {r["doc_id"]: r for r in order_minhash.compare_with_edits(odd_docs).collect()}
    prints = [order_minhash.fingerprint(t) for _, t in rows]
    for n, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(n + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        r, e = got[i], order_minhash.fingerprint(edited)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (prints[n], e)
        assert r["near_edited"] == order_minhash.likeness(prints[n], e)
        assert r["near_next"] == order_minhash.likeness(prints[n], prints[(n + 1) % len(rows)])
    assert len(got) == len(rows) and order_minhash.compare_with_edits(no_docs).count() == 0


def test_order_minhash_repeated_rows(spark):
    d = spark.createDataFrame([(1, "abcdefgh"), (1, "abcdefgh"), (2, "zzzzzzzz"), (None, "first first")], "doc_id long, text string")
    got = order_minhash.compare_with_edits(d).collect()
    want = {None: "first fiab", 1: "abcdefzz", 2: "zzzzzzfi"}
    want[None] = "first fir"[:9] + "ab"
    assert len(got) == 4 and all(r["edited_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest() for r in got)


# ---- 10: toxicity

def test_toxicity_held_out_accuracy(spark):
    d, y = small(spark, "/root/testdata/sf0.1"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(d, y, rows=1600)
    s = toxicity.score(d, model).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).join(y, "doc_id").where("held_out").toPandas()
    pos, neg = s[s["toxic"] == 1]["score"].to_numpy(), s[s["toxic"] == 0]["score"].to_numpy()
    auc = (pos[:, None] > neg[None]).mean() + (pos[:, None] == neg[None]).mean() / 2
    assert auc > 0.9 and (neg >= 0.7).mean() < 0.02 and (pos >= 0.7).mean() > 0.6
    assert s["score"].between(0, 1).all() and set(model.thresholds) >= {"en"}


def test_toxicity_features_of_many_words_at_once(monkeypatch):
    words = ["Word", "wo-rd,", "123", "_", "\u03a3\u03af\u03c3\u03c5\u03c6\u03bf\u03a3", "\u0130stanbul", "\u65e5\u672c\u8a9e\u306e\u6587", "\ud800ab", "ab", "abc\u0301d", "x" * 200 + "\u00e9", "\U0001d4b3" * 20, "7a\u0663b"]
    want = [[*f, *[-1] * (5 - len(f))] for f in map(toxicity.word_features, words)]
    assert toxicity.features_of(words).tolist() == want and toxicity.features_of([]).shape == (0, 5)
    net = toxicity.Net(np.unique([b for f in want for b in f if b >= 0]), rng=np.random.default_rng(1))
    model, texts = net.model(), [" ".join(words), "", " ".join(words[::-1][:4] * 3), "123"]
    docs = [np.array([[model.row.get(b, 0) for b in f] for f in map(toxicity.word_features, t.split()) for f in [[*f, *[-1] * (5 - len(f))]]], np.int64).reshape(-1, 5) for t in texts]
    want = toxicity.sigmoid(toxicity.logits(model, docs))
    looked = []
    monkeypatch.setattr(toxicity, "word_features", lambda w, own=toxicity.word_features: looked.append(w) or own(w))
    batch = pa.RecordBatch.from_arrays([pa.array([t.replace("\ud800", "") for t in texts])], names=["text"])
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 5)  # the cache is emptied again and again
    out = [b.column(0).to_numpy() for b in toxicity._scorer(model)(iter([batch, batch]))]
    assert np.allclose(out[0][1:], want[1:]) and np.array_equal(out[0], out[1])
    assert set(looked) <= {w for w in words if len(w) > 18}  # others are taken together


def test_toxicity_odd_inputs(spark, odd_docs, no_docs):
    y = odd_docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("toxic"))
    model = toxicity.fit(odd_docs, y.unionByName(spark.createDataFrame([(None, 1), (99999, None)], "doc_id long, toxic int")))
    out = toxicity.score(odd_docs, model, keep=odd_docs.columns)
    assert out.columns[:len(odd_docs.columns)] == odd_docs.columns and out.count() == odd_docs.count()
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.score(odd_docs, toxicity.fit(odd_docs, y.where("toxic = 0"))).collect()
    assert {r["score"] for r in none} == {0.0}


def test_toxicity_sample_is_bounded_by_rows_and_characters(spark, monkeypatch):
    """30 ids of 200 texts each bring one row an id; then fewer by length."""
    seen, own = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda x, y: seen.append((len(x), int(y.sum()))) or own(x, y))
    d = spark.range(6000).select((F.col("id") % 30).alias("doc_id"), F.concat(F.lit("word good bad "), F.md5(F.col("id").cast("string"))).alias("text"),
                                 F.lit("en").alias("lang"))
    y = spark.range(30).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    toxicity.fit(d, y, rows=8)
    toxicity.fit(d, y, rows=toxicity.TRAIN_ROWS)
    free = y.where(~toxicity.held_out(F.col("doc_id"))).count()
    monkeypatch.setattr(toxicity, "TRAIN_TOTAL", 46 * 7)
    toxicity.fit(d, y, rows=toxicity.TRAIN_ROWS)
    assert seen[0][0] <= 8 and seen[1][0] <= free and seen[2][0] <= 7 and seen[0][0] >= 4


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    """Rows beyond any sample, texts beyond its length: each is trained on or
    calibrates, in several shards."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 150)
    seen, own = [], toxicity._trained
    monkeypatch.setattr(toxicity, "_trained", lambda rows, n, prior: seen.append((rows.count(), n, prior, rows.agg(F.max(F.length("text"))).first()[0])) or own(rows, n, prior))
    bad = F.concat(F.lit("vile idiots "), F.md5(F.col("doc_id").cast("string")))
    good = F.concat(F.lit("kind people "), F.md5(F.col("doc_id").cast("string")))
    d = spark.range(900).withColumnRenamed("id", "doc_id").withColumn("toxic", (F.col("doc_id") % 3 == 0).cast("int"))
    d = d.withColumn("text", F.when(F.col("toxic") == 1, bad).otherwise(good)).withColumn("lang", F.lit("en"))
    d = d.withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.concat(F.repeat(F.lit("a b "), 16_000), "text")).otherwise(F.col("text")))
    model = toxicity.fit(d.drop("toxic"), d.select("doc_id", "toxic"))
    free = d.where(~toxicity.held_out(F.col("doc_id")))
    kept = free.where(F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string")).cast("binary")) % 5 > 0)
    n = kept.count()
    assert seen[0][:2] == (n, n) and sum(seen[0][2].values()) == n > 300 and seen[0][3] > toxicity.TRAIN_CHARS
    out = toxicity.score(d, model, keep=["doc_id", "toxic"]).where(F.col("doc_id") % 50 > 0).toPandas()
    assert (out["predicted"] == out["toxic"]).mean() > 0.98


def test_toxicity_stage_decides_by_language(spark, monkeypatch):
    """A document between its language's threshold and 0.7 goes; one of a
    language with a higher threshold stays; others are judged by 0.7."""
    import corpus_pipeline

    d, y = small(spark), spark.read.parquet(f"{SF001}/labels.parquet")
    model = toxicity.fit(d, y)
    scores = {(r["doc_id"], r["lang"]): r["score"] for r in toxicity.score(d, model, keep=["doc_id", "lang"]).collect()}
    by_lang = {}
    for (_, lang), v in scores.items():
        by_lang.setdefault(lang, []).append(v)
    low, high = sorted(by_lang, key=lambda v: -len(by_lang[v]))[:2]
    model.thresholds = {low: float(np.median(by_lang[low])), high: max(0.7, max(by_lang[high])) + 1e-9}
    monkeypatch.setattr(toxicity, "fit", lambda *_: model)
    got = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, d, SF001).collect()}
    assert got == {i for (i, lang), v in scores.items() if v < model.thresholds.get(lang, 0.7)}
    assert got != {i for (i, _), v in scores.items() if v < 0.7}


def test_pooling_stays_inside_documents():
    rng = np.random.default_rng(2)
    m = toxicity.train([rng.integers(0, 30, (20, 5)) for _ in range(40)], (np.arange(40) % 2).astype(float))
    docs = [rng.integers(0, 10, (n, 5)) for n in (0, 1, 3, 9, 0, 40)]
    together = toxicity.logits(m, docs)
    assert np.allclose(together, [toxicity.logits(m, [d])[0] for d in docs], atol=1e-4)


def test_blobs_reach_a_task_in_small_batches(spark):
    conf = {f"spark.sql.execution.arrow.{n}": spark.conf.get(f"spark.sql.execution.arrow.{n}") for n in ("maxRecordsPerBatch", "maxBytesPerBatch")}
    try:
        for n in conf:
            spark.conf.unset(n)
        blobs = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("0123456789"), 10_000).cast("binary").alias("blob"))
        small_batches(blobs)

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "size"])

        got = blobs.mapInArrow(sizes, "rows long, size long").collect()
        assert sum(r["rows"] for r in got) == 300 and max(r["size"] for r in got) < 8 << 20
    finally:
        for n, v in conf.items():
            spark.conf.set(n, v)
