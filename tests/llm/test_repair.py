"""Operator 13 against a plain dynamic program and direct damage."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from txnlens.llm import queries, repair

from ..conftest import SF001
from .conftest import CLASH

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(codes, start="", whole=True, end=None):
    """Least (cost, audit, roles) over all edits, by a table over (row, last two
    initials); insertions are relaxed up to three in a row."""
    legal = re.compile(r"(s?(ua)+)?")

    def ok(roles):  # a prefix of something legal
        return any(legal.fullmatch(roles + t) for t in ("", "a", "ua", "u", "aua"))

    def key(roles):
        return roles if len(roles) < 2 else roles[-2:]
    layer = {key(start): (0, "", start)}

    def insert(layer):
        for _ in range(3):
            for c, a, r in list(layer.values()):
                for x in "ua":
                    n = (c + 3, a + "I", r + x)
                    if ok(n[2]) and n < layer.get(key(n[2]), (1 << 30,)):
                        layer[key(n[2])] = n
        return layer
    for code in codes:
        after = {}
        for c, a, r in insert(layer).values():
            ways = [(c + 4, a + "D", r)]
            if code not in "bd":
                extra = 3 if code.isupper() else 0
                ways += [(c + 3 + extra, a + "R", r + x) for x in "ua"]
                if code.lower() in "sua":
                    ways.append((c + extra, a + "K", r + code.lower()))
            for w in ways:
                if ok(w[2]) and w < after.get(key(w[2]), (1 << 30,)):
                    after[key(w[2])] = w
        layer = after
    done = [v for v in insert(layer).values() if legal.fullmatch(v[2])]
    return min(done)


def brute(rows):
    """RESULT rows of (conv_id, turn, role, text)."""
    out, convs = [], {r[0] for r in rows}
    for conv in convs:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = (" " if x is None else x for x in (role, text))
            hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if hit == 1:
                text = ""
            elif hit == 2:
                text = re.sub("[.!?]", "", text)
            elif hit == 4:
                role = "user"
            mine += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, counts = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in mine:
            shown = BLANK.findall(text)
            kind = "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[kind or "k"] = counts.get(kind or "k", 0) + 1
            c = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += kind if kind and kind in "bd" else c.upper() if kind else c
        cost, audit, roles = cheapest(codes)
        left, at, place = [], iter(mine), 0
        for e in audit:
            row = next(at) if e != "I" else (None, "", "")
            if e != "D":
                left.append(f"{row[1] if e == 'K' else {'u': 'user', 'a': 'assistant'}[roles[place]]}:{row[2]}")
                place += 1
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out.append((conv, gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=str)


@pytest.mark.parametrize("length", range(6))
def test_search_over_all_short_conversations(length):
    for codes in itertools.product("bsuaoUA", repeat=length) if length < 5 else random.Random(2).sample(list(itertools.product("bsuaoSUAO", repeat=5)), 4000):
        assert repair.search("".join(codes)) == cheapest("".join(codes))[:2]


def test_long_search():
    rng = random.Random(5)
    for weights in ((1, 3, 3), (1, 1, 1), (5, 1, 1), (0, 1, 0)):
        codes = "".join(rng.choices(["b", "u", "a"], weights, k=200)) + "so" * 20 + "sUAoSd" * 10
        assert repair.search(codes) == cheapest(codes)[:2]


@pytest.mark.parametrize("size", [1, 2, 5])
def test_chunks_combine_to_the_whole(size):
    """Upwards to one table, downwards to the states at each chunk's ends."""
    rng = random.Random(size)
    for n in range(60):
        codes = "".join(rng.choices("bdsuaoSUAO", (1, 1, 2, 6, 6, 1, 1, 1, 1, 1), k=rng.randint(1, 30)))
        parts = [codes[i:i + size] for i in range(0, len(codes), size)]
        tables = [repair.table_of(p, i == len(parts) - 1) for i, p in enumerate(parts)]
        small = [t[:2] for t in tables]
        cost, _ = repair.combined([repair.combined(small[i:i + 3]) for i in range(0, len(small), 3)])
        ways = repair.states_between(small, repair.BEGIN, repair.BEGIN)
        assert ways[0][0] == ways[-1][1] == repair.BEGIN and all(a[1] == b[0] for a, b in zip(ways, ways[1:]))
        found = sum(t[0][4 * a + b] for t, (a, b) in zip(tables, ways)), "".join(t[2][4 * a + b] for t, (a, b) in zip(tables, ways))
        assert found == repair.search(codes) and cost[0] == found[0]


def conversations():
    rng = random.Random(11)
    texts = ["Hi there.", "Yes!", "cut off", "", " \t\x0b", None, "What? ", "...", "é!", "a.b\n", "Same.", "Same.", "x ", "long " * 3000 + "."]
    roles = ["user", "assistant"] * 8 + ["system", "tool", "", None, "s", "User", "us"]
    rows = []
    for conv in [*range(120), None, -5, 2**62]:
        for turn in range(rng.randint(0, 14)):
            rows.append((conv, None if rng.random() < 0.06 else turn + (turn > 6) * rng.randint(0, 3), rng.choice(roles), rng.choice(texts)))
    rows += [(500, t, "user", "Same.") for t in (1, 1, 1, 2)] + [(501, None, "user", "a.")] * 3 + [(502, 2**62, "user", "x."), (502, -1, "system", "y.")]
    rows += [(600, t, ("user", "assistant")[(t + (t > 90)) % 2], f"t{t % 31}" + "." * (t % 5 > 0)) for t in range(400)]  # a hot conversation
    rows += [(700 + k, 0, "user", "gone.") for k in range(60)]  # some lose their only row
    return rows


@pytest.fixture(scope="module")
def rows():
    return conversations()


@pytest.fixture(scope="module")
def want(rows):
    return brute(rows)


@pytest.mark.parametrize("chunk,group", [(repair.CHUNK, repair.GROUP), (3, 4)])
def test_repair_matches_brute_force(spark, rows, want, chunk, group):
    d = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in (*CLASH, "conv", "part", "pos", "code", "hit", "audit")}).repartition(7)
    assert got(repair.repair_digest(d, chunk, group)) == want


def test_query_matches_brute_force(spark):
    c = spark.read.parquet(f"{SF001}/conversations.parquet")
    assert got(queries.QUERIES["op13_conversation_repair"](spark, SF001)) == brute([tuple(r) for r in c.select("conv_id", "turn", "role", "text").collect()])


def test_empty_and_lost_conversations(spark):
    d = spark.createDataFrame([(700 + k, 0, "user", "gone.") for k in range(60)], SCHEMA)
    assert repair.repair_digest(d.where("false")).count() == 0
    lost = [r for r in got(repair.repair_digest(d)) if zlib.crc32(f"{r[0]}:0".encode()) % 20 == 0]
    assert lost and {r[1:] for r in lost} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
