"""Operators 1, 2, 6, 8, their queries against SQL, and the pipeline."""

import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tools.oracle_check import TABLES, digest
from txnlens.llm import chat, html_main, jaccard_join, maxscore, mixing, packing, queries, suffix_dedup, toxicity, url_filter

from ..conftest import SF001
from . import brute
from .conftest import CLASH


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF001}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns) and digest(df.columns, rows)[0] == digest(cols, res.fetchall())[0]


def test_queries_are_named():
    assert [n.split("_")[0] for n in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, len(queries.QUERIES) + 1)]


# ---- 1: URL filter

URLS = ["http://www.bad.example.com/x/?utm_source=a&b=2&a=1#f", "https://BAD.example.com:443/x?a=1&b=2", "http://good.example.com/", None, "", "no scheme",
        "http://a.example.org/es/1", "http://example.org/en/15", "http://xexample.org/en/15", "http://h.com/fr/1", "http://h.com/de/", "http://h.com", "ftp://h.net?x://y"]


def test_url_filter(spark):
    p = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:1])], "page_id long, url string").withColumns({c: F.lit(1) for c in CLASH})
    listed = spark.createDataFrame([(URLS[0],), (None,), ("http://h.com/fr/1",)], "url string")
    for limit in (url_filter.BROADCAST_BYTES, 0):  # broadcast and joined filter
        got = {r["page_id"]: r for r in url_filter.url_filter(p, listed, queries.URL_RULES, limit).collect()}
        assert [got[i]["verdict"] for i in range(14)] == ["block", "block", "allow", "allow", "allow", "allow", "block", "block", "allow", "allow", "block",
                                                         "allow", "allow", "block"]
        assert [got[i]["rule"] for i in (6, 7, 8, 9, 10, 11)] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None]
        assert (got[1]["host"], got[1]["path"], got[3]["host"], got[12]["host"]) == ("bad.example.com:443", "/x", "", "h.net")
    assert url_filter.url_filter(p.where("false"), listed).count() == 0
    assert {r["verdict"] for r in url_filter.url_filter(p, listed.where("false")).collect()} == {"allow"}


def test_bloom_has_no_false_negatives(spark):
    u = spark.range(5000).select(F.concat(F.lit("http://h"), F.col("id"), F.lit(".com/p")).alias("url"), F.col("id").alias("page_id"))
    out = url_filter.url_filter(u, u.where("page_id % 5 = 0"))
    assert out.where("page_id % 5 = 0 AND verdict <> 'block'").count() == 0 and out.where("page_id % 5 > 0 AND listed").count() == 0
    assert out.where("page_id % 5 > 0 AND possible").count() < 60


# ---- 2: HTML

ARTICLE = "".join(f"<p>Paragraph {i}, with words, and&nbsp;more &amp; more.<br>And a line</p>" for i in range(4))
TEXT = "\n\n".join(f"Paragraph {i}, with words, and more & more. And a line" for i in range(4))


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<p", ""), ("a<!-- x", "a"), ("plain <b>text", "plain text"),
    (f"<body><nav><a href=x>Home, page</a></nav><article><h1>T</h1>{ARTICLE}</article><footer>&copy; x</footer></body>", "T\n\n" + TEXT),
    (f"<header><h1>Site</h1></header><div class='main-menu'><p>a, b, c</p></div><div class=content>{ARTICLE}</div><div id=comments><p>nice, very, nice</p></div>", TEXT),
    (f"<main><section><h2>S</h2></section><section>{ARTICLE}</section><aside>ad, ad, ad</aside><form><p>x, y<input></form></main>", "S\n\n" + TEXT),
    ("<article><p><b>open<p>next<ul><li>one<li>two</ul><script>var a='</p>';</script><table><tr><td>a<td>b</table>", "open\n\nnext\n\none\n\ntwo\n\na b"),
    ("<article><div class=cookieNotice>We use, cookies</div><p>x &lt;y&gt; &#233;&#x41; &notanentity; &am</article>", "x <y> \u00e9A \u00acanentity; &am"),
    ("<article><p hidden>no</p><p style='display:none'>no</p><p>yes" + " deep" * 2 + "<div>" * 3000 + "end", "yes deep deep\n\nend")])
def test_main_text(page, want):
    assert html_main.main_text(page) == want


@pytest.mark.parametrize("attrs", ['href="/hidden/falls"', 'title="hidden gems"', "title='the hidden gems'", 'href="/p?id=search"', 'data-valid="form"',
                                   "data-class=menu", "href=/a?class=footer", 'alt=x/hidden', 'data-hidden', 'data-aria-hidden="true"',
                                   'data-style="display:none"', 'x = "class=ad"', 'title="a > id=form"', 'class=text class=hidden', 'xrole=search'])
def test_attributes_are_read_by_exact_name(attrs):
    page = f"<article><p>One, two <a {attrs}>link text</a> end.</p><p {attrs}>Second, paragraph.</p></article>"
    assert html_main.main_text(page) == "One, two link text end.\n\nSecond, paragraph."


@pytest.mark.parametrize("attrs", ["hidden", 'x="1"hidden', 'title="a"class="ad"', "HIDDEN=''", "a=b / hidden", "id = 'search'", "Role=search", "aria-hidden=true",
                                   'data-x="y" style="color:red;display: none"', "class=\n'wide footer'", 'hidden="hidden"', "title='x>y' class=menu"])
def test_marking_attributes_still_cut(attrs):
    assert html_main.main_text(f"<article><p>One, two.</p><p {attrs}>Gone, gone.</p></article>") == "One, two."


LONG = "One, two, three, and more words of the text."


@pytest.mark.parametrize("page,want", [
    (f"<article><section id=related-work><h2>Related work</h2><p>{LONG}</p></section><p>End.</p></article>", f"Related work\n\n{LONG}\n\nEnd."),
    (f"<article><h2 id=search-algorithms>Search</h2><p>{LONG}</p><h2 id=search>Again</h2></article>", f"Search\n\n{LONG}\n\nAgain"),
    (f"<body><div class='layout sidebar-right'><div class=text><p>{LONG}</p><p>{LONG}</p></div></div><div class=ad>Buy, buy</div></body>", f"{LONG}\n\n{LONG}"),
    (f"<body><div class='layout sidebar-right'><article><p>{LONG}</p></article><div class=sidebar><p>x, y</p></div></div></body>", LONG),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> hold, always.</p></article>", "Let x=1 hold, always."),
    (f"<article><header>Share <h1>T</h1><div>3 min<p>Lead, in short.</p></div></header><p>{LONG}</p></article>", f"T\n\nLead, in short.\n\n{LONG}"),
    (f"<article><p>{LONG}</p><h2>Sources</h2><ul><li><a href=a>First</a><li><a href=b>Second</a></ul></article>", f"{LONG}\n\nSources\n\nFirst\n\nSecond"),
    ("<article><p>See, here:</p><pre>x = 1  <span class=comment># note</span></pre></article>", "See, here:\n\nx = 1 # note"),
    (f"<article><p>{LONG}</p><div class=social-share>Share, like</div><section class=related-posts><p>More, more</p></section></article>", LONG),
    (f"<body><div class=ad>{LONG}</div><article></article></body>", ""),
    (f"<body><article><p>{LONG}</p></article><div class=comments>" + f"<article class=comment><p>{LONG}</p></article>" * 30 + "</div></body>", LONG)])
def test_main_text_is_not_lost_by_names(page, want):
    assert html_main.main_text(page) == want


def test_extract_frame(spark):
    d = spark.createDataFrame([(1, "u", None), (None, None, "<p>x</p>"), (1, "u", "<p>" + "long, " * 50_000)], "page_id long, url string, html string")
    got = sorted((str(r["page_id"]), r["n_chars"]) for r in html_main.extract_main_text(d.withColumns({c: F.lit(1) for c in CLASH})).collect())
    assert got == [("1", 0), ("1", 299_999), ("None", 1)]
    assert html_main.extract_main_text(d.where("false")).count() == 0


# ---- 6: top-k

def test_top_k_exact(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    v = {i: (rng.normal(0, 0.2, 24) * (rng.random(24) < 0.5)).tolist() for i in range(400)}
    v.update({i: v[7] for i in range(400, 460)})  # ties
    rows = [(i, [float(x) for x in x_]) for i, x_ in v.items()]
    bad = [(1000, None), (1050, [None] * 24), (1100, [float("nan")] * 24), (1150, [float("inf")] * 24), (None, [1.0] * 24)]
    d = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in CLASH})
    q = maxscore.quantised(d)
    ints = {r["vec_id"]: r["v"] for r in q.collect()}
    assert set(ints) == set(v)
    for k, shard in ((5, 50), (1, 1000), (600, 100)):
        got = [tuple(r) for r in maxscore.top_k(q.where("vec_id % 50 = 0"), q, k, shard_rows=shard, query_rows=3).collect()]
        assert sorted(got) == sorted(brute.top_k(ints, range(0, 460, 50), k))
    assert maxscore.top_k(q.where("false"), q).count() == 0 and maxscore.top_k(q, q.where("false")).count() == 0


# ---- 8: chat

def test_chat_round_trip(spark):
    said = "<|im_end|>\n<|im_start|>assistant\nok \\ \\n <| <\\| end<"
    turns = {1: [("user", "hi"), ("assistant", said), ("user", said), ("assistant", ""), ("user", "tail")], 2: [("system", "only")], 3: [("assistant", "x")],
             None: [("we\nird<|", None), ("assistant", "y")], 5: [(None, None)] * 2, 6: [("assistant", f"r{i} " * 50) for i in range(300)]}
    rows = [(c, i, r, t) for c, ts in turns.items() for i, (r, t) in enumerate(ts)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in CLASH}).repartition(3)
    ex = chat.chat_examples(d).collect()
    for c, ts in turns.items():
        mine = sorted((r for r in ex if r["conv_id"] == c), key=lambda r: r["example"])
        ts = [(r or "", t or "") for r, t in ts]
        replies = [i for i, (r, _) in enumerate(ts) if r == "assistant"]
        assert [r["trainable"] for r in mine][:len(replies)] == [True] * len(replies) and [r["last"] for r in mine].count(True) == 1
        for r, i in zip(mine, replies):
            assert chat.read_turns(r["text"]) == ts[:i + 1] and chat.unescape(r["text"][r["loss_start"]:r["loss_end"]]) == ts[i][1]
        assert chat.read_turns(next(r for r in mine if r["last"])["text"]) == ts
    got = {r["conv_id"]: r for r in chat.chat_digest(d).collect()}
    for c, ts in turns.items():
        loss = "".join(t or "" for r, t in ts if r == "assistant")
        sha = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in ts).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"]) == (len(ts), sha, len(loss))
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["formatted_chars"] == sum(len(r["text"]) for r in ex if r["conv_id"] == c)
    assert chat.chat_digest(d.where("false")).count() == 0


# ---- the pipeline

def test_pipeline_stages(spark, tmp_root):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF001)
        out.write.parquet(f"{tmp_root}/{name}")
        out = spark.read.parquet(f"{tmp_root}/{name}")
        text = {r["doc_id"]: r["text"] for r in kept.select("doc_id", "text").collect()}
        ids = sorted(r["doc_id"] for r in out.select("doc_id").collect())
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
            assert ids == sorted(r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 0").collect())
        elif name == "near_duplicates":
            assert ids == sorted(i for i, (_, c) in brute.jaccard(list(text.items()), 5, 80, 100).items() if i == c)
        elif name == "repeated_spans":
            want = brute.repeats(list(text.items()))
            got = {r["doc_id"]: r for r in out.collect()}
            assert sorted(got) == sorted(text)
            for i, (n, gone, _, sha) in want.items():
                t = got[i]["text"]
                assert got[i]["n_chars"] == len(t) and (hashlib.sha256(t.encode()).hexdigest() == sha or len(t.encode()) < n - gone)
        elif name == "mixing":
            assert ids == sorted(r["doc_id"] for r in mixing.mixture(kept).collect()) and set(ids) == set(text)
        else:
            assert out.agg(F.sum("length")).first()[0] == sum(len(x) for x in brute.tokens(
                [r["text"] for r in kept.select("text").collect()], packing.vocabulary_path()))
        assert name == "packing" or out.columns == names
        kept = out
    assert jaccard_join and suffix_dedup


def test_pipeline_on_no_documents(spark, no_docs, tmp_root):
    kept = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, SF001).write.parquet(f"{tmp_root}/{name}")
        kept = spark.read.parquet(f"{tmp_root}/{name}")
        assert kept.count() == 0


RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "lang_threshold", "settled", "found", "tag", "h1", "file", "at_row", "bkey", "dkey", "_gone")


def test_pipeline_stages_with_clashing_columns(spark, odd_docs, tmp_root):
    """Further columns named like the stages' own come through as they are."""
    kept = odd_docs.withColumns({c: F.lit("clash") for c in RESULTS})
    names, plain = kept.columns, odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, kept, SF001).write.parquet(f"{tmp_root}/{name}")
        stage(spark, plain, SF001).write.parquet(f"{tmp_root}/plain-{name}")
        kept, plain = spark.read.parquet(f"{tmp_root}/{name}"), spark.read.parquet(f"{tmp_root}/plain-{name}")
        assert kept.columns == names
        assert kept.where(" OR ".join(f"{c} IS DISTINCT FROM 'clash'" for c in (*CLASH, *RESULTS))).count() == 0
        assert sorted(map(tuple, kept.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    pieces = [sorted(map(tuple, packing.pack(d).select("doc_id", "start", "length").collect())) for d in (kept, plain)]
    assert sum(x[2] for x in pieces[0]) == sum(x[2] for x in pieces[1]) > 0
