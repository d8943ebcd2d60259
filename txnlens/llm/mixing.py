"""Operator 4: mixing sources to target weights (temperature mixing).

A source's share p of all tokens is raised to an exponent a in [0, 1]; the
normalised powers are the target weights. a = 1 keeps the corpus as it is,
a = 0 makes all sources equal. Bisection finds the smallest exponent whose
weights have an entropy of at most ``entropy`` times that of equal weights
and repeat no source more than ``repeats`` times. Budgets in tokens follow
from the weights so that the least repeated source is used exactly once.

A source is read as epochs, each a permutation: its documents are dealt into
blocks by a hash, the blocks are ordered by a hash of the epoch, and so are
the documents inside a block. The last epoch stops at the budget. All of it
is DataFrame functions: block totals are aggregated before they are moved,
only rows of (id, source, tokens) are ordered, and a window holds one block
of one epoch of a source, so a hot source is spread over all tasks.

Tokens are white-space characters plus one; a null or empty text has none.
A null source is a source of its own. A source without tokens is used once.
Rows equal in (doc_id, tokens) stand or fall together at the cut. An empty
table gives no rows. Only doc_id, text and source are read; ``mixed_rows``
returns all columns as they are, ordered by epoch, block key and document key:
each source's rows in the order of its stream, the sources interleaved. Its
rows are range-partitioned by these keys, so a written table has the order
in its files, read by name and row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCKS = 1024
ENTROPY, REPEATS = 0.95, 2.0
ROUNDS, SECTIONS = 5, 64  # five rounds of 64 sections are thirty bisections
BROADCAST_ROWS = 50_000  # of about 200 bytes

_TOKENS = "CASE WHEN length({t}) > 0 THEN length({t}) - length(translate({t}, ' \n\t\r', '')) + 1 ELSE 0 END"


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.expr(_TOKENS.format(t=text).replace("\n", "\\n").replace("\t", "\\t").replace("\r", "\\r")), F.lit(0)).cast("long")


def _hash(*parts) -> Column:
    return F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts]).cast("binary"))


def _block(doc_id: Column) -> Column:
    return (F.conv(F.substring(_hash("block", F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 8), 16, 10).cast("long") % BLOCKS).cast("int")


def _block_key(source: Column, block: Column, epoch: Column) -> Column:
    return _hash("order", source, block.cast("string"), epoch.cast("string"))


def _doc_key(doc_id: Column, epoch: Column) -> Column:
    return _hash("doc", F.coalesce(doc_id.cast("string"), F.lit("null")), epoch.cast("string"))


def _source(col: Column) -> Column:
    """A key without nulls: ``=name``, or empty for the null source."""
    return F.coalesce(F.concat(F.lit("="), col), F.lit(""))


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _source(F.col("source")).alias("src"), token_count().alias("n_tokens"),
                       _block(F.col("doc_id")).alias("block"))


def exponent(sources: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """Smallest exponent that meets both limits. Each job tries the interior
    points of 64 sections at once, so one job is six bisection steps."""
    shares, lo, hi = _shares(sources), 0.0, 1.0
    stats = shares.agg(F.count("*").alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    if not stats["n"] or stats["n"] == 1:
        return 1.0
    target, spread = entropy * math.log(stats["n"]), math.log(stats["hi"] / stats["lo"])
    for _ in range(ROUNDS):
        points = [lo + (hi - lo) * i / SECTIONS for i in range(1, SECTIONS)] + ([0.0] if lo == 0.0 else [])
        row = shares.agg(*[F.sum(F.pow("p", F.lit(a))).alias(f"z{i}") for i, a in enumerate(points)],
                         *[F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"l{i}") for i, a in enumerate(points)]).first()
        good = {a: math.log(row[f"z{i}"]) - a * row[f"l{i}"] / row[f"z{i}"] <= target and (1 - a) * spread <= math.log(repeats)
                for i, a in enumerate(points)}
        if good.get(0.0):
            return 0.0
        step = (hi - lo) / SECTIONS
        first = next((a for a in points[:SECTIONS - 1] if good[a]), hi)
        lo, hi = max(lo, first - step), first
    return hi


def _shares(sources: DataFrame) -> DataFrame:
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    return sources.where("tokens > 0").select((F.col("tokens") / F.lit(float(total))).alias("p"))


def block_totals(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("src", "block").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "mix-blocks")


def mix_plan(blocks: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> DataFrame:
    """Per source: src, tokens, weight, budget, epochs (whole ones)."""
    sources = stored(blocks.groupBy("src").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    a = exponent(sources, entropy, repeats)
    top, z = sources.agg(F.max("tokens").cast("double"), F.sum(F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a))))).first()
    t = F.col("tokens").cast("double")
    budget = F.when(F.col("tokens") > 0, F.floor(t * F.pow(F.lit(top or 1.0) / t, F.lit(1.0 - a)))).otherwise(0).cast("long")
    plan = sources.select("src", "tokens", F.lit(a).alias("exponent"),
                          F.when(F.col("tokens") > 0, F.pow(t, F.lit(a)) / F.lit(z or 1.0)).otherwise(0.0).alias("weight"), budget.alias("budget"))
    return plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1).cast("int"))


def _placed_blocks(blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """Where each block begins in each epoch of its source's stream; a
    source has at most BLOCKS of them an epoch."""
    b = blocks.join(plan.select("src", F.col("tokens").alias("all"), "budget", "epochs"), "src")
    last = F.when(F.col("budget") > F.col("epochs") * F.col("all"), F.col("epochs")).otherwise(F.col("epochs") - 1)
    b = b.withColumn("epoch", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    b = b.withColumn("bkey", _block_key(F.col("src"), F.col("block"), F.col("epoch")))
    w = Window.partitionBy("src", "epoch").orderBy("bkey", "block")
    before = F.sum("tokens").over(w) - F.col("tokens") + F.col("epoch") * F.col("all")
    return (b.withColumn("begins", before).where((F.col("begins") <= F.col("budget")) | (F.col("all") == 0))
            .select("src", "block", "epoch", "bkey", "begins", "tokens", "all", "budget", "epochs"))


def mixture(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> DataFrame:
    """doc_id, source, epoch, n_tokens, position (tokens of the same source
    before it) and weight: a row for each time a document is used."""
    rows = narrow(docs)
    blocks = block_totals(rows)
    plan = mix_plan(blocks, entropy, repeats)
    placed = _placed_blocks(blocks, plan.drop("exponent")).join(plan.select("src", "weight"), "src")
    j = rows.join(placed.drop("tokens", "bkey", "all", "epochs"), ["src", "block"])
    w = Window.partitionBy("src", "block", "epoch").orderBy("dkey", F.col("doc_id").asc_nulls_first(), "n_tokens")
    j = j.withColumn("dkey", _doc_key(F.col("doc_id"), F.col("epoch"))).withColumn("ends", F.col("begins") + F.sum("n_tokens").over(w))
    return j.where("ends <= budget").select(
        "doc_id", F.when(F.col("src") != "", F.expr("substring(src, 2)")).alias("source"), "epoch", "n_tokens",
        (F.col("ends") - F.col("n_tokens")).alias("position"), "weight")


def cuts(rows: DataFrame, blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the whole epochs and where its last epoch stops: the key of
    the block that the budget ends in and of the last document used of it."""
    placed = _placed_blocks(blocks, plan).where((F.col("epoch") == F.col("epochs")) & (F.col("all") > 0))
    edge = placed.where("begins <= budget AND begins + tokens > budget")
    j = rows.join(edge.select("src", "block", "epoch", "bkey", "begins", "budget"), ["src", "block"])
    w = Window.partitionBy("src", "block").orderBy("dkey", F.col("doc_id").asc_nulls_first(), "n_tokens")
    j = j.withColumn("dkey", _doc_key(F.col("doc_id"), F.col("epoch"))).withColumn("ends", F.col("begins") + F.sum("n_tokens").over(w))
    last = j.where("ends <= budget").groupBy("src").agg(F.max(F.struct("dkey", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("id"), "n_tokens")).alias("cut"))
    return (plan.select("src", "epochs").join(edge.groupBy("src").agg(F.max("bkey").alias("cut_block")), "src", "left").join(last, "src", "left"))


def mixed_rows(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> DataFrame:
    """``docs`` with each row as often as the mixture uses it, in the order
    of the mixture. Rows meet the table of sources' cuts, which is broadcast
    while it is small, and are moved once, to their places."""
    rows = narrow(docs)
    blocks = block_totals(rows)
    cut = stored(cuts(rows, blocks, mix_plan(blocks, entropy, repeats)), "mix-cuts")
    if cut.count() <= BROADCAST_ROWS:
        cut = F.broadcast(cut)
    names = docs.columns
    d = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), _source(F.col("source")).alias("src"), token_count().alias("n_tokens"),
                    _block(F.col("doc_id")).alias("block"), F.col("doc_id").cast("long").alias("id"))
    d = d.join(cut, "src")
    bkey = _block_key(F.col("src"), F.col("block"), F.col("epochs"))
    own = F.struct(_doc_key(F.col("id"), F.col("epochs")).alias("dkey"), F.coalesce("id", F.lit(-2 ** 63)).alias("id"), F.col("n_tokens"))
    inside = F.col("cut_block").isNotNull() & ((bkey < F.col("cut_block")) | ((bkey == F.col("cut_block")) & F.coalesce(own <= F.col("cut"), F.lit(False))))
    times = F.col("epochs") + F.when(inside, 1).otherwise(0)
    d = d.withColumn("epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array())))
    d = d.withColumns({"bkey": _block_key(F.col("src"), F.col("block"), F.col("epoch")), "dkey": _doc_key(F.col("id"), F.col("epoch"))})
    order = ["epoch", "bkey", "block", "src", "dkey", F.col("id").asc_nulls_first(), "n_tokens"]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return d.select("row", *order[:5], "id", "n_tokens").repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("row.*")


def mixture_sql(entropy: float = ENTROPY, repeats: float = REPEATS) -> str:
    """DuckDB text of ``mixture`` over ``documents``."""
    tokens = _TOKENS.format(t="text").replace("' \n\t\r'", "chr(32) || chr(10) || chr(9) || chr(13)")
    block = f"CAST(('0x' || substr(md5('block|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8))::BIGINT % {BLOCKS} AS INTEGER)"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS src, CAST(coalesce({tokens}, 0) AS BIGINT) AS n_tokens, {block} AS block
  FROM documents),
bl AS MATERIALIZED (SELECT src, block, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),
s AS MATERIALIZED (SELECT src, CAST(sum(tokens) AS BIGINT) AS tokens FROM bl GROUP BY src),
p AS MATERIALIZED (SELECT list(tokens / CAST((SELECT sum(tokens) FROM s) AS DOUBLE)) AS ps FROM s WHERE tokens > 0),
bis(step, lo, hi) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) UNION ALL
  SELECT step + 1, CASE WHEN good THEN lo ELSE mid END, CASE WHEN good THEN mid ELSE hi END FROM (
    SELECT step, lo, hi, mid, ln(z) - mid * l / z <= {entropy} * ln(len(ps))
           AND (1 - mid) * ln(list_max(ps) / list_min(ps)) <= ln({repeats}) AS good FROM (
      SELECT step, lo, hi, (lo + hi) / 2 AS mid, ps, list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2))) AS z,
             list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2) * ln(x))) AS l FROM bis, p WHERE step < 30))),
a AS MATERIALIZED (SELECT hi AS a FROM bis WHERE step = 30),
plan AS MATERIALIZED (SELECT src, tokens, CASE WHEN tokens > 0 THEN pow(tokens, a) / (SELECT sum(pow(tokens, a)) FROM s WHERE tokens > 0) ELSE 0 END AS weight,
  CASE WHEN tokens > 0 THEN CAST(floor(tokens * pow((SELECT max(tokens) FROM s) / CAST(tokens AS DOUBLE), 1 - a)) AS BIGINT) ELSE 0 END AS budget FROM s, a),
pe AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs FROM plan),
placed AS MATERIALIZED (SELECT src, block, epoch, budget, weight, allt,
    sum(tokens) OVER (PARTITION BY src, epoch ORDER BY md5('order|' || src || '|' || block || '|' || epoch), block) - tokens + epoch * allt AS begins FROM (
  SELECT bl.*, pe.budget, pe.weight, pe.tokens AS allt,
         unnest(range(0, CASE WHEN budget > epochs * pe.tokens THEN epochs + 1 ELSE epochs END)) AS epoch FROM bl JOIN pe USING (src)))
SELECT doc_id, CASE WHEN src <> '' THEN substr(src, 2) END AS source, CAST(epoch AS INTEGER) AS epoch, n_tokens,
  CAST(ends - n_tokens AS BIGINT) AS position, weight FROM (
  SELECT d.*, epoch, budget, weight, begins + sum(n_tokens) OVER (PARTITION BY src, block, epoch
    ORDER BY md5('doc|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || epoch), doc_id NULLS FIRST, n_tokens) AS ends
  FROM d JOIN placed USING (src, block)) WHERE ends <= budget"""
