"""Operator 2: main text of HTML pages by tree scoring.

A page is read into a small tree. Menus, headers, footers, sidebars, adverts,
notices, forms, scripts, styles and reader comments are cut off by element,
role, class or id. Outside an article or main element one telling word of a
class or id is enough, unless what it marks has most of the page's points and
all of its articles (a wrapper named after its layout). Inside, all words of a
class or id must be telling, and headings and code are never cut by name; such
a full name is overruled only by nine tenths of the points. Each paragraph then passes points (one, plus one for each
comma, plus one for each hundred characters up to three) to its parent, half
of them to the grandparent and a third, a quarter, ... further up; a
container's points are discounted by its link density. The best container is
kept with those siblings that score a fifth of its points or more; inside it
nothing more is dropped, but for lists made of links where there is no article
or main element, and the loose lines of an article's header.

Defined results: null or empty HTML, or a page without text, gives the empty
text; broken markup (missing end tags, a tag or comment cut off at the end)
is read as far as it goes; repeated pages are extracted one by one; only
page_id, url and html are read. White space inside a block becomes one space
(a line break and a table cell are white space), blocks are joined by an
empty line.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Element names of HTML by their role in a page.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav header footer aside form script style noscript template iframe svg annotation annotation-xml canvas object embed applet "
                    "audio video map button select option optgroup textarea input label fieldset legend dialog menu title".split())
BLOCKS = frozenset("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody "
                   "tfoot tr figure figcaption address hr details summary center hgroup search".split())
PARAGRAPHS = frozenset("p pre blockquote li td dd h1 h2 h3 h4 h5 h6".split())
LOOSE = frozenset("div section article main html body".split())
NEVER_CUT = frozenset("html body article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert status menu menubar toolbar note".split())
CUT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted sidebar sidebars "
                      "aside nav navbar navigation menu menus breadcrumb breadcrumbs footer foot header masthead topbar toolbar comment comments "
                      "commentlist respond reply replies disqus cookie cookies consent gdpr notice notices notification alert banner popup modal "
                      "overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations widget "
                      "widgets copyright disclaimer pagination pager skip search form hidden outbrain taboola adsense".split())
STRUCTURE = frozenset("area articles bar block box button buttons container item items label links list panel post posts section slot title unit "
                      "wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hgroup hr main menu nav ol p pre section table ul li dd dt tr td th tbody thead tfoot".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th")}
SCOPE = frozenset("html body article main section div ul ol dl table blockquote td th nav header footer aside form".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z",
                  re.S)
_ATTR = re.compile(r"(=?[^\s/>=]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]*))?")  # one after another; an open quote takes the rest
_TELLING = re.compile(r"class|id|role|hidden|style", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


KEPT, PARTLY, FULLY, CUT = range(4)  # how far a node is cut: by part of a name, by a whole name, for good


class Node:
    __slots__ = ("tag", "parent", "kids", "cut", "score", "inside", "code")

    def __init__(self, tag, parent, cut=KEPT):
        self.tag, self.parent, self.cut, self.kids, self.score = tag, parent, cut, [], 0.0
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.code = tag in ("pre", "code") or parent is not None and parent.code


def _named(name: str, value: str, inside: bool) -> int:
    """How far a class or id marks an element as no part of the main text."""
    most = KEPT
    for cls in value.split():
        words = [w.lower() for w in _WORD.findall(cls)]
        if words[:1] in (["no"], ["has"], ["with"]) or not any(w in CUT_WORDS for w in words):
            continue
        if all(w in CUT_WORDS or name == "class" and w in STRUCTURE for w in words):
            return FULLY
        most = KEPT if inside else PARTLY
    return most


def _marked(tag: str, attrs: str, parent: Node) -> int:
    """How far attributes mark an element as no part of the main text."""
    if tag in NEVER_CUT or not _TELLING.search(attrs):
        return KEPT
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(attrs):
        found.setdefault(name.lower(), value.strip("\"'"))  # of equal names the first counts
    most = KEPT
    for name, value in found.items():
        if name == "hidden" and value.lower() in ("", "hidden", "true") or name == "aria-hidden" and value.lower() == "true":
            return CUT
        if name == "style" and _GONE.search(value) or name == "role" and value.lower().strip() in ROLES:
            return CUT
        if name in ("class", "id") and not parent.code and not (tag in HEADINGS and (parent.inside or name == "id")):
            most = max(most, _named(name, value, parent.inside))
    return most


def parse(page: str) -> Node:
    """A tree of nodes whose children are nodes or decoded strings."""
    root = Node("html", None)
    cur, pos, n = root, 0, len(page)
    while pos < n:
        m = _TAG.search(page, pos)
        end = m.start() if m else n
        if end > pos:
            cur.kids.append(_html.unescape(page[pos:end]))
        if not m:
            break
        pos = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            x = cur
            while x is not root and x.tag != tag:
                if x.tag in SCOPE and tag not in SCOPE:
                    break  # an inline end tag does not close blocks
                x = x.parent
            if x.tag == tag and x is not root:
                cur = x.parent
            elif tag == "p":
                cur.kids.append(Node("p", cur))
            continue
        if tag in ("html", "body") and cur is root:
            continue
        if tag in CLOSES_P:
            x = cur
            while x is not root and x.tag not in SCOPE and x.tag != "p" and x.tag not in SAME.get(tag, ()):
                x = x.parent
            if x.tag == "p":
                cur = x.parent
            if tag in SAME:
                x = cur
                while x is not root and x.tag not in SAME[tag] and (x.tag not in SCOPE or x.tag in ("td", "th") and x.tag in SAME[tag]):
                    x = x.parent
                while x is not root and x.tag in SAME[tag]:
                    cur = x = x.parent
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS and tag not in RAW:
            if tag not in DROPPED:
                cur.kids.append(Node(tag, cur))
            continue
        inside = tag == "header" and cur.inside  # the header of an article may hold its title
        node = Node("header" if inside else tag, cur, CUT if tag in DROPPED and not inside else _marked(tag, attrs, cur))
        cur.kids.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>?", re.I).search(page, pos)
            pos = close.end() if close else n
        else:
            cur = node
    return root


def _walk(node: Node, least: int = PARTLY):
    """Nodes that are not cut as far as ``least``, parents before children."""
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str) or x.cut >= least:
            continue
        yield x
        stack.extend(k for k in reversed(x.kids) if not isinstance(k, str))


def _length(node: Node) -> tuple[int, int, int]:
    """(characters, characters in links, links) without white space at ends."""
    chars = linked = links = 0
    stack = [(node, False)]
    while stack:
        x, a = stack.pop()
        if isinstance(x, str):
            k = len(x.strip())
            chars, linked = chars + k, linked + (k if a else 0)
        elif not x.cut:
            links += x.tag == "a"
            stack.extend((k, a or x.tag == "a") for k in x.kids)
    return chars, linked, links


def _points(x: Node) -> int:
    """Points of a paragraph or of loose text in a container."""
    loose = x.tag in LOOSE and any(isinstance(k, str) and k.strip() for k in x.kids)
    text = _paragraph_text(x) if loose or x.tag in PARAGRAPHS else ""
    return 1 + sum(text.count(c) for c in ",،、，") + min(len(text) // 100, 3) if text else 0


def _restore_wrappers(root: Node) -> None:
    """Undo cuts by name where the name is that of a wrapper of the page."""
    nodes = list(_walk(root, CUT))
    if not any(x.cut for x in nodes):
        return
    points: dict[int, int] = {id(x): 0 for x in nodes}
    mains = dict(points)
    for x in reversed(nodes):  # children before parents
        cut, x.cut = x.cut, KEPT
        points[id(x)] += _points(x)
        x.cut = cut
        mains[id(x)] += x.tag in ("article", "main")
        if x.parent is not None:
            points[id(x.parent)] += points[id(x)]
            mains[id(x.parent)] += mains[id(x)]
    total, all_mains = points[id(root)], mains[id(root)]
    for x in nodes:
        share = points[id(x)] / total if total else 0.0
        if mains[id(x)] == all_mains and (x.cut == PARTLY and share > 0.5 or x.cut == FULLY and share > 0.9 and all_mains):
            x.cut = KEPT


def _paragraph_text(node: Node) -> str:
    """Text of a paragraph without that of paragraphs inside it."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.cut and (x is node or x.tag not in BLOCKS):
            stack.extend(reversed(x.kids))
    return " ".join("".join(out).split())


def score(root: Node) -> list[Node]:
    """Pass points up from paragraphs; containers that have points."""
    found: dict[int, Node] = {}
    for x in list(_walk(root)):
        points = _points(x)
        if not points:
            continue
        up, level = x if x.tag in LOOSE else x.parent, 0
        while up is not None:
            up.score += points / (1 if level == 0 else 2 if level == 1 else level + 1)
            found[id(up)] = up
            up, level = up.parent, level + 1
    nodes = list(found.values())
    for x in nodes:
        if x.tag in ("article", "main"):
            x.score = x.score * 1.5 + 5
        chars, linked, _ = _length(x)
        x.score *= 1 - (linked / chars if chars else 0)
    return nodes


def _blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, in page order."""
    out, buf = [], []

    def close():
        text = " ".join("".join(buf).split())
        if text:
            out.append(text)
        buf.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            buf.append(x)
        elif x.cut:
            buf.append(" ")
        elif x.tag in ("br", "wbr"):
            buf.append(" " if x.tag == "br" else "")
        elif x.tag in BLOCKS or x.tag == "header":
            close()
            if x.tag in ("ul", "ol", "dl") and x is not node and not x.inside:
                chars, linked, links = _length(x)
                if links >= 2 and linked > 0.8 * chars:
                    continue
            stack.append(None)
            kids = x.kids
            if x.tag == "header":
                kids = [k for k in x.kids if not isinstance(k, str) and (k.tag in HEADINGS or k.tag in ("header", "div", "section", "p", "blockquote"))]
                for k in kids:
                    k.tag = "header" if k.tag in ("div", "section") else k.tag
            stack.extend(reversed(kids))
        else:
            if x.tag in ("td", "th"):
                buf.append(" ")
            stack.extend(reversed(x.kids))
            if x.tag in ("td", "th"):
                stack_end = " "
                buf.append(stack_end)
    close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    _restore_wrappers(root)
    nodes = score(root)
    if not nodes:
        return "\n\n".join(_blocks(root))
    best = max(nodes, key=lambda x: x.score)
    x = best
    while x is not None:  # the whole article, not its best section
        if x.tag in ("article", "main") and x.score > 0:
            best = x
        x = x.parent
    if best.parent is None:
        return "\n\n".join(_blocks(best))
    kept = []
    for s in best.parent.kids:
        if s is best:
            kept.append(s)
        elif isinstance(s, str) or s.cut:
            continue
        elif best.tag not in ("article", "main") or s.tag in ("article", "main", "section", "p", "div"):
            chars, linked, _ = _length(s)
            dense = linked / chars if chars else 1.0
            if s.tag in ("p", "h1", "h2") and best.tag not in ("article", "main"):
                if chars and dense < 0.25:
                    kept.append(s)
            elif s.score >= max(10.0, 0.2 * best.score) and dense < 0.5:
                kept.append(s)
    return "\n\n".join(b for k in kept for b in _blocks(k))


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        text = [main_text(h) for h in b["html"]]
        yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page; a map-only
    plan, so no page meets another."""
    return pages.select("page_id", "url", "html").mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
