"""Operator 13: conversation repair by depth-first branch and bound.

Each row of a conversation has a code: its role's initial, and whether it must
go (blank, duplicate) or costs extra (truncated). The cheapest edits that give
role initials ``(s?(ua)+)?``, ties broken by the ASCII-least audit, are found
by a depth-first search over (row, grammar state) with an explicit stack:
children are taken cheapest bound first, the bound of a prefix is its cost and
the least cost of every row that is left whatever its state, the incumbent is
the best whole (cost, audit), and each node keeps the best prefix that reached
it, so worse ones go. The search ends when nothing can beat the incumbent.

Conversations are not held by one task for this. The rows are sorted over all
tasks; runs of CHUNK rows of one conversation become strings of codes. A short
conversation is one search. For a long one each chunk is searched from every
state to every state; the resulting 4 x 4 tables of (cost, order among the
audits of a start) are combined GROUP at a time, upwards to one table for the
conversation, and downwards to the states at each chunk's ends, whose audit is
then the chunk's. Equal strings are searched once a batch. Insertions go
before the next row, in whichever chunk, so that the audits of a chunk with
one start are never prefixes of each other and their order decides.

The last pass streams each conversation's rows beside its audits and hashes
what is left. SHA-256 has to read one conversation's text in order, so one
task reads all of a hot conversation there, row by row, with bounded memory
but for its audit, which is one value of the result.

Defined results: a null role or text is one space (so a null text is blank),
a null conv_id or turn is one space in the damage key and orders first; equal
turns are ordered by role and text, so a repeated row follows its original; a
null conv_id is a conversation of its own; an empty role has
no initial and fits nowhere; conversations without rows after the damage have
zeros and empty strings; an empty table gives no rows. Further columns are
not read. Long texts are streamed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.position import sorted_stamped
from .common import stored

CHUNK, GROUP = 32, 64  # rows of a search, tables that one task combines
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = "\t\n\x0b\x0c\r "
# States: nothing yet, after s, after u, after a whole pair.
BEGIN, SYSTEM, USER, PAIR = range(4)
NEXT = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
WANTED = ["u", "u", "a", "u"]  # what an inserted or renamed turn is in each state
ENDS = (BEGIN, PAIR)
FAR = 1 << 40
AT_END = -1  # a target: the end of a conversation, further insertions allowed

RESULT = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


# ---- the search ------------------------------------------------------------

def row_edits(code: str) -> list[tuple[int, str, str | None]]:
    """(cost, letter, initial it leaves) of one row's edits: ``b`` and ``d``
    (blank, duplicate) must go, capitals are truncated, ``o`` is no known role.
    A renamed turn takes the initial that its state wants."""
    if code in "bd":
        return [(DELETE, "D", None)]
    extra = TRUNCATED if code.isupper() else 0
    keep = [(KEEP + extra, "K", code.lower())] if code.lower() in "sua" else []
    return [*keep, (REROLE + extra, "R", "?"), (DELETE, "D", None)]


_EDITS = {c: row_edits(c) for c in "bdsuaoSUAO"}


def search(codes: str, start: int = BEGIN, target: int = AT_END) -> tuple[int, str] | None:
    """The least (cost, audit) that takes ``start`` to ``target`` over the
    rows ``codes``; None if there is none."""
    n = len(codes)
    least = [0] * (n + 1)  # of the rows from i on, whatever their states
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + min(c for c, _, _ in _EDITS[codes[i]])
    best: tuple[int, str] | None = None
    reached = {(0, start): (0, "")}  # of each node the best prefix
    stack = [(0, "", 0, start)]
    while stack:
        cost, audit, i, state = stack.pop()
        if best is not None and cost + least[i] > best[0]:
            continue
        if reached.get((i, state), (FAR, "")) < (cost, audit):
            continue  # a better prefix came here after this one was put on the stack
        if i == n:
            if (state == target or target == AT_END and state in ENDS) and (best is None or (cost, audit) < best):
                best = (cost, audit)
            if target != AT_END:
                continue
        children = []
        if i < n:
            for c, letter, initial in _EDITS[codes[i]]:
                to = state if initial is None else NEXT.get((state, WANTED[state] if initial == "?" else initial))
                if to is not None:
                    children.append((cost + c, audit + letter, i + 1, to))
        children.append((cost + INSERT, audit + "I", i, NEXT[state, WANTED[state]]))
        # the cheapest bound, then the least audit, is taken first: it goes on the stack last
        children.sort(key=lambda x: (x[0] + least[x[2]], x[1]), reverse=True)
        for child in children:
            c, a, j, to = child
            if best is not None and c + least[j] > best[0]:
                continue
            if (c, a) < reached.get((j, to), (FAR, "")):
                reached[j, to] = (c, a)
                stack.append(child)
    return best


def table_of(codes: str, last: bool) -> tuple[list[int], list[int], list[str]]:
    """(costs, orders, audits) of a chunk, start-major; for the last chunk the
    end of the conversation stands in the column of BEGIN."""
    cost, order, audit = [FAR] * 16, [0] * 16, [""] * 16
    for s in range(4):
        for t in range(1 if last else 4):
            found = search(codes, s, AT_END if last else t)
            if found:
                cost[4 * s + t], audit[4 * s + t] = found
        rank = {a: k for k, a in enumerate(sorted(audit[4 * s:4 * s + 4]))}
        order[4 * s:4 * s + 4] = [rank[a] for a in audit[4 * s:4 * s + 4]]
    return cost, order, audit


def through(tables: list[tuple], start: int) -> list[list]:
    """For each table the best (cost, orders so far, state before) of every
    state after it. The first differing order decides between equal costs."""
    now: list = [None] * 4
    now[start] = (0, ())
    steps = []
    for cost, order in tables:
        nxt: list = [None] * 4
        for s, v in enumerate(now):
            for t in range(4):
                if v and cost[4 * s + t] < FAR:
                    way = (v[0] + cost[4 * s + t], (*v[1], order[4 * s + t]), s)
                    if nxt[t] is None or way[:2] < nxt[t][:2]:
                        nxt[t] = way
        steps.append(nxt)
        # only the order of the (at most four) ways matters from here on
        ways = sorted(w[1] for w in nxt if w)
        now = [w and (w[0], (ways.index(w[1]),)) for w in nxt]
    return steps


def combined(tables: list[tuple]) -> tuple[list[int], list[int]]:
    """One table for several after another."""
    cost, order = [FAR] * 16, [0] * 16
    for s in range(4):
        ends = through(tables, s)[-1]
        ways = sorted(w[1] for w in ends if w)
        for t, w in enumerate(ends):
            if w:
                cost[4 * s + t], order[4 * s + t] = w[0], ways.index(w[1])
    return cost, order


def states_between(tables: list[tuple], start: int, end: int) -> list[tuple[int, int]]:
    """(state before, state after) each table on the best way."""
    out = []
    for step in reversed(through(tables, start)):
        before = step[end][2]
        out.append((before, end))
        end = before
    return out[::-1]


# ---- rows and their codes ----------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """conv (conv_id as text, empty for null), turn, role, text of the rows after the damage."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    c = conversations.select(
        F.coalesce(conv, F.lit("")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.crc32(F.concat(F.coalesce(conv, F.lit(" ")), F.lit(":"), F.coalesce(turn, F.lit(" ")))) % 20).alias("hit"))
    c = c.where("hit <> 0").withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("hit") == 3).cast("int"))))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return c.select("conv", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def _code(role: Column, trimmed: Column, again: Column) -> Column:
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    closed = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    return F.when(trimmed == "", "b").when(again, "d").when(closed, known).otherwise(F.upper(known))


def _coded(rows: DataFrame) -> DataFrame:
    """conv, part, pos, code of sorted rows. A row is a duplicate unless its
    place is the first of its conversation, role and text; the first places
    are joined back by place, so a common text is no hot key."""
    first = rows.groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("fresh"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    short = rows.select("conv", "part", "pos", F.substring("role", 1, 1).alias("role"), F.substring(trimmed, -1, 1).alias("trimmed"))
    return short.join(first, "pos", "left").select("conv", "part", "pos", _code(F.col("role"), F.col("trimmed"), F.col("fresh").isNull()).alias("code"))


def _chunks(coded: DataFrame, size: int) -> DataFrame:
    """conv, part, chunk (from 0 in the conversation's part), pos of the
    first row, codes, and whether it is the only and the last of the conversation."""
    w = Window.partitionBy("conv", "part").orderBy("pos")  # a part is one range of the sort
    c = coded.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
    c = c.groupBy("conv", "part", "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    c = c.select("conv", "part", "chunk", F.col("rows")[0]["pos"].alias("pos"), F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"))
    ends = c.groupBy(F.col("conv").alias("of")).agg(F.max("pos").alias("pos"), F.count(F.lit(1)).alias("parts"))
    # one row of each conversation finds its last chunk by place
    c = c.join(ends.select("pos", (F.col("parts") == 1).alias("only")), "pos", "left")
    return c.select("conv", "part", "chunk", "pos", "codes", F.col("only").isNotNull().alias("last"), F.coalesce("only", F.lit(False)).alias("only"))


def _searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        tables = {k: table_of(*k) for k in set(zip(b["codes"], b["last"]))}
        found = [tables[k] for k in zip(b["codes"], b["last"])]
        yield b.assign(cost=[f[0] for f in found], order=[f[1] for f in found], audits=[f[2] for f in found])


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        best = {k: search(k) for k in set(b["codes"])}
        yield b.assign(audit=[best[k][1] for k in b["codes"]], cost=[best[k][0] for k in b["codes"]])


def _combine(keys: list[str]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("place")
        cost, order = combined([(list(c), list(o)) for c, o in zip(g["cost"], g["order"])])
        return pd.DataFrame([[*g.iloc[0][keys], cost, order]], columns=[*keys, "cost", "order"])
    return run


def _between(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of ``kind`` 1 are tables, the one of kind 0 holds their states (from, to)."""
    over = group[group["kind"] == 0].iloc[0]
    g = group[group["kind"] == 1].sort_values("place")
    ways = states_between([(list(c), list(o)) for c, o in zip(g["cost"], g["order"])], int(over["from"]), int(over["to"]))
    return pd.DataFrame({"conv": g["conv"], "part": g["part"].astype(int), "place": g["place"].astype(int), "from": [a for a, _ in ways], "to": [b for _, b in ways]})


TABLE = "cost array<long>, order array<long>"
STATES = "conv string, part int, place long, `from` int, `to` int"


def _long_audits(chunks: DataFrame, group: int) -> DataFrame:
    """conv, part, chunk, audit, cost of the chunks of long conversations."""
    searched = chunks.mapInPandas(_searched, "conv string, part int, chunk long, pos long, codes string, last boolean, only boolean, "
                                             f"{TABLE}, audits array<string>")
    searched = stored(searched, "repair-tables")
    tiers = [searched.select("conv", "part", F.col("chunk").alias("place"), "cost", "order")]
    while (tiers[-1].agg(F.max("place")).first()[0] or 0) > 0:  # within a part of the sort
        t = tiers[-1].withColumn("over", F.floor(F.col("place") / group).cast("long"))
        up = t.groupBy("conv", "part", "over").applyInPandas(_combine(["conv", "part", "over"]), f"conv string, part int, over long, {TABLE}")
        tiers.append(stored(up.withColumnRenamed("over", "place"), "repair-tier"))
    # the top: the parts of a conversation, at most one for each range of the sort
    top = tiers[-1].select("conv", "part", F.col("part").cast("long").alias("place"), "cost", "order")
    whole = top.select("conv").distinct().select("conv", F.lit(BEGIN).alias("from"), F.lit(BEGIN).alias("to"))
    states = _states(top, whole, ["conv"]).withColumn("place", F.lit(0).cast("long"))
    for t in reversed(tiers[:-1]):
        over = states.select("conv", "part", F.col("place").alias("over"), "from", "to")
        states = _states(t.withColumn("over", F.floor(F.col("place") / group).cast("long")), over, ["conv", "part", "over"])
    at = F.col("from") * 4 + F.col("to")
    return searched.join(states.withColumnRenamed("place", "chunk"), ["conv", "part", "chunk"]).select(
        "conv", "part", "chunk", "pos", "codes", F.get("audits", at).alias("audit"), F.get("cost", at).alias("cost"))


def _states(tables: DataFrame, over: DataFrame, keys: list[str]) -> DataFrame:
    rows = tables.withColumn("kind", F.lit(1)).unionByName(over.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return rows.groupBy(*keys).applyInPandas(_between, STATES)


def audits(coded: DataFrame, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """conv, pos of the first row, codes, audit and cost of every chunk."""
    chunks = stored(_chunks(coded, chunk), "repair-chunks")
    short = chunks.where("only").select("conv", "pos", "codes").mapInPandas(_solved, "conv string, pos long, codes string, audit string, cost long")
    many = chunks.where("NOT only")
    if many.isEmpty():
        return short
    return short.unionByName(_long_audits(many, group).select(*short.columns))


# ---- results -------------------------------------------------------------------

class Repaired:
    """One conversation, taken in row by row."""

    def __init__(self, conv: str):
        self.conv, self.sha, self.started = conv, hashlib.sha256(), False
        self.state, self.cost, self.audit, self.faults = BEGIN, 0, [], {"b": 0, "d": 0, "t": 0}
        self.before, self.illegal, self.turns, self.low, self.high, self.turn = None, 0, 0, None, None, None
        self.codes, self.edits, self.at, self.row = "", "", 0, 0

    def chunk(self, codes: str, audit: str, cost: int) -> None:
        self.codes, self.edits, self.at, self.row = codes, audit, 0, 0
        self.cost += cost
        self.audit.append(audit)
        self.faults["b"] += codes.count("b")
        self.faults["d"] += codes.count("d")
        self.faults["t"] += sum(map(str.isupper, codes))

    def _add(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.started else "") + f"{role}:{text}").encode())
        self.started = True
        self.state = NEXT[self.state, role[0]]

    def _inserted(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self._add("user" if WANTED[self.state] == "u" else "assistant", "")
            self.at += 1

    def take(self, turn: int | None, role: str, text: str) -> None:
        self._inserted()
        edit = self.edits[self.at]
        self.at, self.row = self.at + 1, self.row + 1
        if edit == "K":
            self._add(role, text)
        elif edit == "R":
            self._add("user" if WANTED[self.state] == "u" else "assistant", text)
        if self.row == len(self.codes):
            self._inserted()  # only a conversation's last chunk has some here
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None:
            if turn != self.turn:
                self.turns, self.turn = self.turns + 1, turn
            self.low, self.high = turn if self.low is None else self.low, turn

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        f = self.faults
        return (self.conv, gaps, f["b"], f["d"], f["t"], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by conversation: its name (kind 0), then each chunk's audit (1)
    before the chunk's rows (2)."""
    names, now, out = [c.split()[0] for c in RESULT.split(", ")], None, []
    for b in batches:
        columns = (b[c].tolist() for c in ("conv", "kind", "turn", "role", "text", "codes", "audit", "cost"))
        for conv, kind, turn, role, text, codes, audit, cost in zip(*columns):
            if now is None or conv != now.conv:
                if now is not None:
                    out.append(now.result())
                now = Repaired(conv)
            if kind == 1:
                now.chunk(codes, audit, int(cost))
            elif kind == 2:
                now.take(None if turn == "" else int(turn), role, text)
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    if now is not None:
        yield pd.DataFrame([now.result()], columns=names)


def repair_digest(conversations: DataFrame, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """Damages ``conversations`` and returns for every conv_id its faults, the
    cheapest repair and the digest of the repaired rows."""
    rows = sorted_stamped(damage(conversations), ["conv", "turn", "role", "text"])
    rows = rows.withColumnsRenamed({"_pos_pid": "part", "_pos_mid": "pos"})
    names = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")).distinct()
    found = audits(_coded(rows), chunk, group)
    all_ = (rows.select("conv", F.lit(2).alias("kind"), "pos", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn"), "role", "text")
            .unionByName(found.withColumn("kind", F.lit(1)), allowMissingColumns=True)
            .unionByName(names.withColumns({"kind": F.lit(0), "pos": F.lit(-1).cast("long")}), allowMissingColumns=True))
    out = all_.repartition("conv").sortWithinPartitions("conv", "pos", "kind").mapInPandas(_streamed, RESULT)
    return out.withColumn("conv_id", F.when(F.col("conv_id") != "", F.col("conv_id")).cast("long"))
