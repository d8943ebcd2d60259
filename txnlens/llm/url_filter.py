"""Operator 1: URL filter.

Listed canonical URLs are folded into a blocked Bloom filter (one 512-bit
block per URL, one bit in each of its eight words). Only the pages whose
block has all eight bits go on to the exact hash join with the list, which
removes the filter's false positives. Host/path rules override that verdict.

Defined results: a null URL, or one without ``://``, has empty host, path
and canonical form and is allowed unless a rule fits; repeated pages are
judged one by one; an empty list blocks nothing; only the columns named here
are read, so further columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

WORDS = 8
KEYS_PER_BLOCK = 32  # 16 bits a key: about one false positive in a thousand
BLOCK_BYTES = 8 * (WORDS + 1)
BROADCAST_BYTES = 32 << 20

Rule = tuple[str, str, str]  # host, path, allow | block

TRACKING = r"\A(utm_[^=]*|ref|fbclid|gclid)(=|\z)"


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without closing slashes,
    query without tracking parameters and in sorted order; no scheme, no
    fragment. Empty for URLs without a host."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":(80|443)\z", ""), r"\Awww\.", "")
    path = F.regexp_replace(url_path(url), r"/+\z", "")
    query = F.coalesce(F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING)))
    joined = F.array_join(kept, "&")
    full = F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""))
    return F.when(host == "", F.lit("")).otherwise(full)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])


def _ordered(rules: Sequence[Rule]) -> list[Rule]:
    """Longest first; among equally long ones the longer host, then block."""
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block", r))


def rule_columns(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule string, its verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(_ordered(rules)):
        rule = F.when(_fits(r, host, path), F.lit(r[0] + r[1])).otherwise(rule)
        verdict = F.when(_fits(r, host, path), F.lit(r[2])).otherwise(verdict)
    return rule, verdict


def _bits(url: Column) -> list[Column]:
    h = F.xxhash64(url, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks).cast("long"))


def bloom_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(block, w0..w7) of the distinct canonical URLs in column ``canon``."""
    bits = _bits(F.col("canon"))
    return (listed.select(_block(F.col("canon"), n_blocks).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
            .groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)]))


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (),
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url) against ``listed`` (url).

    Returns page_id, url, host, path, canon, rule, verdict, possible, listed.
    The filter is broadcast only while its size, known from the number of
    listed URLs, is under ``broadcast_bytes``; beyond that it is joined by
    block. A page that is no possible hit gets a key of its own in the exact
    join, so the misses spread over all tasks.
    """
    exact = (listed.select(canonical_url(F.col("url")).alias("canon")).where("canon <> ''").distinct())
    n = exact.count()
    n_blocks = max(1, -(-n // KEYS_PER_BLOCK))
    blocks = bloom_blocks(exact, n_blocks)
    if n_blocks * BLOCK_BYTES <= broadcast_bytes:
        blocks = F.broadcast(blocks)
    url = F.col("url")
    p = pages.select("page_id", "url", url_host(url).alias("host"), url_path(url).alias("path"), canonical_url(url).alias("canon"))
    p = p.withColumn("block", _block(F.col("canon"), n_blocks))
    hit = F.lit(True)
    for i, b in enumerate(_bits(F.col("canon"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(b) != 0)
    p = p.join(blocks, "block", "left").withColumn("possible", F.coalesce(hit, F.lit(False)) & (F.col("canon") != ""))
    own = F.concat(F.lit("\u0000"), F.xxhash64("page_id", "url").cast("string"))
    p = p.withColumn("key", F.when(F.col("possible"), F.col("canon")).otherwise(own))
    j = p.join(exact.select(F.col("canon").alias("key"), F.lit(True).alias("on_list")), "key", "left")
    rule, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    on_list = F.coalesce(F.col("on_list"), F.lit(False))
    return j.select("page_id", "url", "host", "path", "canon", rule.alias("rule"),
                    F.coalesce(verdict, F.when(on_list, "block").otherwise("allow")).alias("verdict"),
                    "possible", on_list.alias("listed"))


# ---- the same in DuckDB SQL ------------------------------------------------

_SQL_HOST = ("coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), "
             "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')")


def filter_sql(pages: str, listed: str, rules: Sequence[Rule]) -> str:
    """DuckDB text; ``pages`` has page_id, url and ``listed`` has url."""
    host2 = r"regexp_replace(regexp_replace(host, ':(80|443)\z', ''), '\Awww\.', '')"
    params = (r"array_to_string(list_sort(list_filter(string_split(coalesce(regexp_extract(url, '\A[^?#]*\?([^#]*)', 1), ''), '&'), "
              rf"lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))), '&')")
    canon = (f"SELECT *, {host2} AS h2, regexp_replace(path, '/+\\z', '') AS p2, {params} AS q2 FROM "
             f"(SELECT *, {_SQL_HOST} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM %s)")
    full = "CASE WHEN h2 = '' THEN '' ELSE h2 || p2 || CASE WHEN q2 <> '' THEN '?' || q2 ELSE '' END END"
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in _ordered(rules)]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for c, s, _ in fits) + " END" if fits else "NULL"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END" if fits else "NULL"
    return (f"WITH p AS (SELECT *, {full} AS canon FROM ({canon % pages})), "
            f"l AS (SELECT DISTINCT canon FROM (SELECT {full} AS canon FROM ({canon % listed})) WHERE canon <> '') "
            f"SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN canon IN (SELECT canon FROM l) "
            "THEN 'block' ELSE 'allow' END) AS verdict FROM p")
