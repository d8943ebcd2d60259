"""Operator 11: Merkle manifest of a dataset, by lag and lead windows.

Every row becomes a leaf digest; per group the leaves in key order are folded
``arity`` at a time into the group's subroot, and the subroots in group order
into the root. Every row also gets its proof: level by level the digests to
the left and to the right of its ancestor in that ancestor's run.

Rows never meet by group, so a group of any share of the table is spread. A
global sort gives each row its place in its group; the place div
``arity ** LEVELS`` is the block that a window holds (1,024 rows for two).
Inside a block, level k lives on the rows whose place is a multiple of
``arity ** k``: lag and lead by fixed multiples of ``arity ** k``, masked by
the slot in the run and the length of the run, supply the siblings, and the
first child's row hashes the parent. The last non-null side at or before a
row is that of its ancestor. Block roots are the rows of the next tier, so a
table of n rows takes log(n) / LEVELS tiers. Going down, a row joins its
block's path by (tree, block): at most a block's rows share a key.

Defined results: a null field is written ``-``, an empty text ``0:``; null
groups are a group of their own and come first; null keys come first, equal
keys ascend by leaf digest, and repeated rows are leaves one by one; a lone
leaf is its subroot and a lone subroot the root; an empty table gives no
rows; long texts are only hashed, once. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.position import sorted_stamped
from .common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10  # levels of one window block
TAMPER_EVERY = 7


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return digest(*map(field, values))


def with_places(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds idx, the row's place in its tree, and n, the size of the tree.
    The counts are a row for each tree and range partition, joined by both,
    so a large tree is one key in each partition that it lies in."""
    s = sorted_stamped(rows, [tree, *order])
    part = s.groupBy("_pos_pid", tree).agg(F.min("_pos_mid").alias("first"), F.count(F.lit(1)).alias("rows"))
    here = Window.partitionBy(tree)
    before = here.orderBy("_pos_pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("_pos_pid", tree, "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
                       F.sum("rows").over(here).alias("n"))
    out = s.join(part, ["_pos_pid", tree])
    return out.withColumn("idx", F.col("offset") + F.col("_pos_mid") - F.col("first")).drop("_pos_pid", "_pos_mid", "first", "offset")


def _tier(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """nodes (tree, idx, n, digest, ...) with block, path (array of left and
    right, from this row up to its block's root) and top, the block's root."""
    idx, n = F.col("idx"), F.col("n")
    t = nodes.withColumn("block", F.floor(idx / arity ** levels).cast("long")).withColumn("_d0", F.col("digest"))
    w = Window.partitionBy("tree", "block").orderBy("idx")
    for k in range(levels):
        step, d = arity ** k, F.col(f"_d{k}")
        count = F.ceil(n / step)  # nodes of the whole level
        node = F.floor(idx / step)
        slot = node % arity
        run = F.least(F.lit(arity), count - (node - slot))
        own = idx % step == 0
        left = [F.when(slot >= j, F.lag(d, j * step).over(w)).otherwise("") for j in range(arity - 1, 0, -1)]
        right = [F.when(slot + j < run, F.lead(d, j * step).over(w)).otherwise("") for j in range(1, arity)]
        side = F.struct(F.concat(*left).alias("left"), F.concat(*right).alias("right"))
        t = t.withColumns({f"_s{k}": F.when(own & (count > 1), side)})
        t = t.withColumn(f"_d{k + 1}", F.when(idx % (step * arity) == 0, F.when(count > 1, digest(d, F.col(f"_s{k}.right"))).otherwise(d)))
    up = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumns({f"_a{k}": F.last(f"_s{k}", ignorenulls=True).over(up) for k in range(levels)}
                      | {"top": F.last(f"_d{levels}", ignorenulls=True).over(up)})
    path = F.filter(F.array(*[F.col(f"_a{k}") for k in range(levels)]), lambda s: s.isNotNull())
    return t.select(*nodes.columns, "block", path.alias("path"), "top")


def _up(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The written tiers, from the leaves to the one whose blocks are whole trees."""
    wide, tiers = arity ** levels, []
    while True:
        tiers.append(stored(_tier(nodes, arity, levels), "merkle-tier"))
        largest = tiers[-1].agg(F.max("n")).first()[0]
        if (largest or 0) <= wide:
            return tiers
        nodes = tiers[-1].where(F.col("idx") % wide == 0).select("tree", F.col("block").alias("idx"),
                                                                 F.ceil(F.col("n") / wide).alias("n"), F.col("top").alias("digest"))


def _down(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The rows of the lowest tier with whole paths; ``above`` (tree, over,
    ...) has what lies over each tree. A tree has a block of the last tier."""
    def joined(t, over, on):
        return t.join(over, on).withColumn("path", F.concat("path", "over")).drop("over", "top", "digest", "block")
    out = joined(tiers[-1], above, ["tree"])
    rest = [c for c in above.columns if c not in ("tree", "over")]
    for t in reversed(tiers[:-1]):
        out = joined(t, out.select("tree", F.col("idx").alias("block"), F.col("path").alias("over"), *rest), ["tree", "block"])
    return out


def merkle_manifest(leaves: DataFrame, group: str, order: list[str], arity: int = 2, levels: int = LEVELS) -> DataFrame:
    """``leaves`` (leaf, group, order columns, ...) with subroot, root and
    path: an array of (left, right) digests, from the leaf's run to the root's."""
    keyed = leaves.withColumn("tree", F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("+"), F.col(group).cast("string"))))
    low = _up(with_places(keyed, "tree", [*order, "leaf"]).withColumn("digest", F.col("leaf")), arity, levels)
    subroots = low[-1].where("idx = 0").select(F.col("tree").alias("name"), F.col("top").alias("digest"), F.lit("").alias("tree"))
    high = _up(with_places(stored(subroots, "merkle-groups"), "tree", ["name"]), arity, levels)
    root = high[-1].where("idx = 0").select("tree", F.expr("array()").cast(high[-1].schema["path"].dataType).alias("over"), F.col("top").alias("root"))
    groups = _down([t.withColumn("subroot", F.col("digest")) if i == 0 else t for i, t in enumerate(high)], root)
    over = groups.select(F.col("name").alias("tree"), F.col("path").alias("over"), "subroot", "root")
    return _down(low, over).drop("tree", "idx", "n")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and, for tampered rows, forged: the leaf after 1 is
    added to n_chars. Written once: texts are read and hashed in one pass."""
    cols = {c: F.col(c) for c in FIELDS}
    forged = leaf_digest([(c.cast("decimal(20,0)") + 1 if k == "n_chars" else c) for k, c in cols.items()])
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    return stored(docs.select("doc_id", "lang", leaf_digest(list(cols.values())).alias("leaf"), F.when(tampered, forged).alias("forged")), "leaves")


def verify_documents(docs: DataFrame, arity: int = 2, levels: int = LEVELS) -> DataFrame:
    m = merkle_manifest(document_leaves(docs), "lang", ["doc_id"], arity, levels)
    m = m.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                 fold(F.coalesce("forged", "leaf"), F.col("path")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))


# ---- the same for two children, as DuckDB SQL ----------------------------------

def _field_sql(text: str) -> str:
    return f"CASE WHEN {text} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _crc32_sql(text: str) -> str:
    step = f"list_reduce(list_prepend(xor(crc, byte), {[0] * 8}::BIGINT[]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    of = f"list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {of}), lambda crc, byte: {step}), 4294967295)"


def _nodes_sql(name: str, leaves: str) -> str:
    return f"""{name}(tree, level, idx, digest) AS (
  SELECT tree, 0, idx, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM {name}) WHERE m > 1 GROUP BY tree, level, idx // 2)"""


def _path_sql(name: str, leaves: str, nodes: str) -> str:
    """Per leaf the siblings, each after L or R for its side, or N for none."""
    return f"""{name} AS (SELECT l.tree, l.idx,
  list(CASE WHEN s.digest IS NULL THEN 'N' WHEN s.idx % 2 = 0 THEN 'L' || s.digest ELSE 'R' || s.digest END ORDER BY v.level) FILTER (v.level IS NOT NULL) AS path
  FROM {leaves} l LEFT JOIN (SELECT DISTINCT tree, level FROM {nodes} WHERE level < (SELECT max(m.level) FROM {nodes} m WHERE m.tree = {nodes}.tree)) v ON v.tree = l.tree
  LEFT JOIN {nodes} s ON s.tree = l.tree AND s.level = v.level AND s.idx = xor(l.idx >> v.level, 1) GROUP BY ALL)"""


def manifest_sql() -> str:
    plain = " || ".join(_field_sql(f"CAST({c} AS VARCHAR)") for c in FIELDS)
    forged = " || ".join(_field_sql(f"CAST({'n_chars + 1' if c == 'n_chars' else c} AS VARCHAR)") for c in FIELDS)
    fold_ = "list_reduce(list_prepend(start, path), lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END))"
    return f"""WITH RECURSIVE
d AS (SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256({plain}) AS leaf,
  CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % {TAMPER_EVERY} = 0 THEN sha256({forged}) END AS forged FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS digest FROM d),
{_nodes_sql('low', 'p')}, {_path_sql('lowpath', 'p', 'low')},
g AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, tree AS name, arg_max(digest, level) AS digest FROM low GROUP BY low.tree),
{_nodes_sql('high', 'g')}, {_path_sql('highpath', 'g', 'high')},
r AS (SELECT arg_max(digest, level) AS root FROM high),
f AS (SELECT p.doc_id, p.leaf, g.digest AS subroot, r.root, coalesce(p.forged, p.leaf) AS start,
  list_concat(coalesce(a.path, []), coalesce(b.path, [])) AS path
  FROM p JOIN lowpath a ON a.tree = p.tree AND a.idx = p.idx JOIN g ON g.name = p.tree JOIN highpath b ON b.idx = g.idx, r)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
  {fold_} AS folded_root, folded_root = root AS verified FROM f"""
