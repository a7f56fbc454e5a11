"""Operator 3: main text of web pages by a site style tree.

Pages become trees of block elements (presentation: tag and classes) with
text blocks as content. The trees of one host are merged by labels that its
pages share: without ids and the names of html and body, digits of a class
as ``#``, and only classes on at least ``MIN_PAGES`` pages and one page in
``NAME_SHARE``; a rarer class would give its pages a path of their own that
the tree can't judge. Per node

* presentation importance is the entropy, to the base of the number of
  pages, of the child sequences seen under it, and
* content importance is one minus the mean entropy of its text blocks: a
  block on every page has entropy 1, a block of one page 0.

A node's importance blends both, content weighing ``GAMMA`` per level, and
takes its whole branch into account. Branches below ``MIN_IMPORTANCE`` on a
host with at least ``MIN_PAGES`` distinct pages are cut from its pages.
Equal pages of a host are merged as one, so copies don't make an article
look like boilerplate; a page that would lose all its text keeps what is
unmarked, or else all of it.

The markup's own evidence is a prior. It marks branches for navigation,
forms, asides, footers and the like (by tag, role, class or id), and what
stands outside the page's ``article`` (or else ``main``) elements if these
hold at least ``ARTICLE_SHARE`` of the unmarked text. No branch is marked
that contains a ``main`` or the largest ``article``, nor by a name alone one
with most of the page's text. All blocks are given to the tree; a marked
node's importance is weighed by its mean share of its pages' text, so a
marked branch stays if it holds much text that differs from page to page.
Entropy says nothing about nodes on fewer than ``MIN_PAGES`` distinct pages:
there the marks decide alone. Only elements that never show text (scripts,
options, media and the like) are left out from the start.

The tree is aggregated from one narrow row per distinct (page, node, block);
a host with any share of the pages is pre-aggregated by node and block.
Cut and kept marked branches come back by a join on the host: that table
holds only such nodes, and Spark broadcasts it if its files are small.

Text blocks: character references decoded, white space of a block (also a
line break) turned into one space, trimmed, empty ones dropped, joined by
one newline in page order.

Defined results: null html or html without text gives an empty text; a null
or odd url belongs to the host ''; rows sharing a page_id stay rows of their
own; an empty table gives an empty table.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import table, text_of
from corate.session import materialize

GAMMA = 0.9
MIN_PAGES = 8
MIN_IMPORTANCE = 0.2
ARTICLE_SHARE = 1 / 3
NAME_SHARE = 1000

# HTML's element kinds and usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rt rtc rp s samp "
    "small span strike strong sub sup time tt u var wbr br center picture source track param map meter progress "
    "output slot math".split())
NEVER_TAGS = frozenset(
    "head script style noscript template button select option textarea iframe svg canvas object embed applet audio "
    "video title input".split())
NOISE_TAGS = frozenset("nav footer aside form menu dialog".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                        "menubar toolbar status".split())
NOISE_NAMES = frozenset(
    "nav navbar navigation menu menubar sidebar footer header masthead topbar ad ads advert adverts advertisement "
    "advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notification alert "
    "comment comments disqus replies reactions share sharing social related recommended newsletter subscribe signup "
    "breadcrumb breadcrumbs popup modal overlay widget login search pagination pager toolbar form".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody"), "tfoot": ("tbody",)}

#: A whole tag; one with a < inside an attribute is found by :class:`_Tags`.
_TAG = re.compile(r"""</?[a-zA-Z][^<>"']*+(?:"[^<"]*+"[^<>"']*+|'[^<']*+'[^<>"']*+)*+>""")
_LETTER = re.compile(r"</?[a-zA-Z]")
_SPECIAL = re.compile(r"""[>"']""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""\b(class|id|role|aria-hidden|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_CUT = re.compile(r"[\s_\-]+")
_DIGITS = re.compile(r"[0-9]+")


STYLE, CONTENT, MARK, NAME = range(4)  # kinds of the tree's rows
NOISE = "!"  # in the label of an element that markup calls noise


#: Elements nested deeper belong to the tree node of this depth (texts stay).
MAX_DEPTH = 256


class _Tags:
    """Where tags end. A quoted value may hold any character; a tag whose
    quotes never close is none. Linear over a page: quotes that open a value
    without a way to the tag's end are remembered."""

    def __init__(self, source: str):
        self.source, self.dead, self.open = source, set(), {'"': len(source), "'": len(source)}
        self.next = _SPECIAL.search(source)  # the next special character from the last tag on

    def end(self, at: int) -> int:
        """The end of the tag that begins at ``at``, or -1."""
        source, passed = self.source, []
        if self.next and at > self.next.start():
            self.next = _SPECIAL.search(source, at)
        m = self.next
        while m:
            if m[0] == ">":
                return m.end()
            x, quote = m.start(), m[0]
            if x in self.dead or x >= self.open[quote]:
                break
            passed.append(x)
            close = source.find(quote, x + 1)
            if close < 0:
                self.open[quote] = x  # no such quote closes from here on
                break
            m = _SPECIAL.search(source, close + 1)
        self.dead.update(passed)
        return -1


class _Node:
    __slots__ = ("tag", "label", "never", "noise", "named", "up", "path", "depth", "kids", "size", "holds", "inside",
                 "marks", "within")

    def __init__(self, tag: str, label: str, noise: bool = False, named: bool = False, up: _Node | None = None):
        self.tag, self.label, self.noise, self.named, self.up = tag, label, noise, named, up
        self.depth = up.depth + 1 if up else 0
        if up and self.depth > MAX_DEPTH:
            self.path = up.path
        else:
            self.path = up.path + ">" + label if up and up.up else label
        self.never = tag in NEVER_TAGS or bool(up and up.never)
        #: the kinds of chosen elements around it
        self.within = up.within if up else frozenset()
        if up and up.tag in ("article", "main"):
            self.within |= {up.tag}
        self.kids, self.size, self.holds, self.inside, self.marks = [], 0, False, False, ()


def _node(tag: str, raw: str, up: _Node, in_article: bool) -> _Node:
    """An element with its presentation label, whether markup says noise, and
    whether only a name, a form or hiding does."""
    sure, named, names = tag in NOISE_TAGS - {"form"} or (tag == "header" and not in_article), tag == "form", []
    for m in _ATTR.finditer(raw, raw.find(tag) + len(tag)) if " " in raw or "\n" in raw else ():
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() in ("class", "id"):
            if m[1].lower() == "class":
                names += _DIGITS.sub("#", value).replace(".", "_").replace(">", "_").split()
            named = named or bool(NOISE_NAMES & {*value.split(), *_CUT.split(value)})
        elif m[1].lower() == "role":
            sure = sure or value in NOISE_ROLES
        elif m[1].lower() == "hidden" or value == "true":
            named = True
    if tag in ("html", "body", "article", "main"):
        sure = named = False
        names = [] if tag in ("html", "body") else names
    names += [NOISE] if sure or named else []
    return _Node(tag, ".".join([tag, *sorted(set(names))]), sure or named, not sure, up)


@cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*+>", re.I)


def parse(source: str) -> tuple[list[tuple[str, str, tuple[str, ...]]], dict[str, str]]:
    """The text blocks (path, text, paths of the marked nodes around it) of a
    page, and each path's child tags in order."""
    blocks: list[tuple[_Node, str]] = []
    styles: dict[str, str] = {}
    root = _Node("", "")
    stack: list[_Node] = [root]
    nodes: list[_Node] = []
    opened: Counter[str] = Counter()
    text: list[str] = []

    def flush() -> None:
        """Ends a block. Inside an element that never shows text there is
        none to end: the text before it goes on behind it."""
        if text and not stack[-1].never:
            words = _html.unescape("".join(text)).split()
            text.clear()
            if words:
                blocks.append((stack[-1], " ".join(words)))
                stack[-1].size += len(blocks[-1][1])

    def say(part: str) -> None:
        if not stack[-1].never:
            text.append(part)

    def close(count: int) -> None:
        for _ in range(count):
            flush()
            node = stack.pop()
            opened[node.tag] -= 1
            if node.size:
                styles[node.path] = " ".join(node.kids)
                stack[-1].size += node.size

    def depth_of(tag: str) -> int:
        """The place of the innermost open ``tag``, 0 if none is."""
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag) if opened[tag] else 0

    at = start = 0  # where to look for a tag, where the text before it begins
    end, tags = len(source), _Tags(source)
    while at < end:
        lt = source.find("<", at)
        if lt < 0:
            break
        what = source[lt + 1:lt + 2]
        if what in ("!", "?") and what:
            over = source.find("-->", lt + 4) if source.startswith("<!--", lt) else source.find(">", lt)
            if lt > start:
                say(source[start:lt])
            at = start = end if over < 0 else over + (3 if source.startswith("<!--", lt) else 1)
            continue
        m = _TAG.match(source, lt)
        over = m.end() if m else tags.end(lt) if _LETTER.match(source, lt) else -1
        if over < 0:
            at = lt + 1  # no tag: text
            continue
        if lt > start:
            say(source[start:lt])
        raw = source[lt:over]
        at = start = over
        tag = _NAME.match(raw)[1].lower()
        if raw[1] == "/":
            if tag not in INLINE and (depth := depth_of(tag)):
                close(len(stack) - depth)
            continue
        if tag in RAW and not raw.endswith("/>"):
            over = _closing(tag).search(source, at)
            at = start = over.end() if over else end
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in INLINE:
            continue
        if tag not in NEVER_TAGS or tag == "head":
            flush()
        if tag in CLOSES_P and (depth := depth_of("p")):
            close(len(stack) - depth)
        for other in SELF_CLOSING.get(tag, ()):
            if stack[-1].tag == other:
                close(1)
        up = stack[-1]
        node = _node(tag, raw, up, bool(up.within) or up.tag in ("article", "main"))
        if not up.kids or up.kids[-1] != tag:
            up.kids.append(tag)  # runs of like children count once
        if tag not in VOID:
            stack.append(node)
            nodes.append(node)
            opened[tag] += 1
    if start < end:
        say(source[start:])
    while stack[-1].never:
        close(1)
    flush()
    close(len(stack) - 1)
    return _marked(root, nodes, blocks, styles), styles


def _with_mark(n: _Node) -> tuple[str, ...]:
    """The marks around a marked node and its own, paths once."""
    above = n.up.marks
    return above if above and above[-1] == n.path else (*above, n.path)


def _marked(root: _Node, nodes: list[_Node], blocks: list[tuple[_Node, str]],
            styles: dict[str, str]) -> list[tuple[str, str, tuple[str, ...]]]:
    """The blocks with the marked nodes around them, by the markup's evidence."""
    for n in nodes:
        if n.noise and n.named and 2 * n.size > root.size:
            n.noise = False
    tops: dict[str, list[_Node]] = {"article": [], "main": []}
    for n in nodes:  # outermost ones with text
        if n.tag in tops and n.size and n.tag not in n.within:
            tops[n.tag].append(n)
    cleared: set[int] = set()
    for n in [*tops["main"], *sorted(tops["article"], key=lambda n: -n.size)[:1]]:
        while n and id(n) not in cleared:
            cleared.add(id(n))
            n.noise, n = False, n.up
    for n in nodes:
        n.marks = _with_mark(n) if n.noise else n.up.marks
    plain = sum(len(t) for n, t in blocks if not n.marks)
    chosen: list[_Node] = []
    for kind in ("article", "main"):
        mine = [n for n in tops[kind] if not n.marks]
        if mine and sum(n.size for n in mine) >= ARTICLE_SHARE * plain:
            chosen = mine
            break
    if chosen:
        for n in chosen:
            n.inside, up = True, n.up
            while up and not up.holds:
                up.holds, up = True, up.up
        for n in nodes:  # the topmost ones beside the chosen are marked
            n.inside = n.inside or n.up.inside
            beside = n.up.holds and not n.holds and not n.inside
            n.marks = _with_mark(n) if n.noise or beside else n.up.marks
    out = []
    for n, t in blocks:
        path, marks = n.path, n.marks
        if n.holds and not n.inside:  # text straight in an element around the chosen
            path = path + ">#"
            marks = (*marks, path)
            styles[path] = ""
        out.append((path, t, marks))
    return out


def unmarked_texts(blocks: list[tuple[str, str, tuple[str, ...]]]) -> list[str]:
    """The texts that markup alone keeps, or else all."""
    return [t for _, t, marks in blocks if not marks] or [t for _, t, _ in blocks]


def _hash(text: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                          "little", signed=True)


def shared_path(path: str, names: set[str]) -> str:
    """The path with only those classes that are among the host's names."""
    return ">".join(".".join(x for i, x in enumerate(n.split(".")) if not i or x == NOISE or x in names)
                    for n in path.split(">"))


def _shared_path(path: Column, names: Column) -> Column:
    keep = lambda x, i: (i == 0) | (x == NOISE) | F.array_contains(names, x)
    return F.array_join(F.transform(F.split(path, ">"), lambda n: F.array_join(
        F.filter(F.split(n, "[.]"), keep), ".")), ">")


def _tree_rows(batches):
    """(host, page, kind, path, feature): the distinct text blocks, child
    sequences, marked nodes (with their share of the page's text in
    thousandths) and classes (and '' for the page) of each page; equal pages
    of a batch once."""
    seen: set[tuple[str, int]] = set()
    for b in batches:
        out = []
        for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            blocks, styles = parse(source or "")
            page = _hash("\n".join(unmarked_texts(blocks)))
            if (host, page) in seen:
                continue
            seen.add((host, page))
            total, marked = sum(len(t) for _, t, _ in blocks), Counter()
            for _, t, marks in blocks:
                for p in set(marks):
                    marked[p] += len(t)
            rows = {(CONTENT, p, _hash(t)) for p, t, _ in blocks}
            rows |= {(STYLE, p, _hash(s)) for p, s in styles.items()}
            rows |= {(MARK, p, 1000 * n // total) for p, n in marked.items()}
            rows |= {(NAME, x, 0) for p in styles for n in p.split(">") for x in n.split(".")[1:]} | {(NAME, "", 0)}
            out += [(host, page, *r) for r in rows]
        if out:
            cols = list(zip(*out, strict=True))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)],
                                             ["host", "page", "kind", "path", "feature"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def tree_rows(pages: DataFrame, min_pages: int = MIN_PAGES) -> tuple[DataFrame, DataFrame]:
    """The rows of the pages' trees and ``(host, names)``, the classes that a
    host's labels keep, from ``(host, html)``."""
    rows = materialize(pages.select("host", "html").mapInArrow(
        _tree_rows, "host string, page bigint, kind int, path string, feature bigint").distinct(), "page-nodes")
    names = (rows.where(F.col("kind") == NAME).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_pages))
    total = names.where("path = ''").select("host", F.col("n").alias("total"))
    names = (names.join(total, "host").where((F.col("path") != "") & (F.col("n") * NAME_SHARE >= F.col("total")))
             .groupBy("host").agg(F.collect_set("path").alias("names")))
    return rows.where(F.col("kind") != NAME), materialize(names, "host-names")


def node_importance(rows: DataFrame, names: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """``(host, path, pages, importance, content, weight, marked)`` of every
    node of the sites' style trees, from ``tree_rows``: ``weight`` is the
    markup's prior, ``marked`` the number of pages whose markup marks it."""
    path = F.when(F.col("names").isNull(), _shared_path(F.col("path"), F.array().cast("array<string>"))) \
        .otherwise(_shared_path(F.col("path"), F.col("names")))
    is_style, is_content = (F.col("kind") == k for k in (STYLE, CONTENT))
    # nodes of a page that got the same path: one style, their marks together
    rows = (rows.join(names, "host", "left")
            .groupBy("host", "page", "kind", path.alias("path"), F.when(is_content, F.col("feature")).alias("block"))
            .agg(F.min("feature").alias("low"), F.least(F.sum(F.when(F.col("kind") == MARK, F.col("feature"))),
                                                        F.lit(1000)).alias("share"))
            .select("host", "kind", "path", F.when(is_content, F.col("block")).when(is_style, F.col("low"))
                    .otherwise(F.col("share")).alias("feature")))
    uses = rows.groupBy("host", "kind", "path", "feature").agg(F.count(F.lit(1)).alias("df"))
    uses = materialize(uses, "node-features")
    # pages that hold a path: each page has one style per path
    df = F.col("df")
    style = uses.where(~is_content).groupBy("host", "path").agg(
        F.sum(F.when(is_style, df).otherwise(0)).alias("pages"),
        F.sum(F.when(is_style, df * F.log(df.cast("double"))).otherwise(0.0)).alias("x"),
        F.sum(F.when(is_style, 0).otherwise(df)).alias("marked"),
        F.sum(F.when(is_style, 0).otherwise(df * F.col("feature"))).alias("share"))
    m, marked = F.col("pages"), F.col("marked")
    spread = F.when(m > 1, (F.log(m.cast("double")) - F.col("x") / m) / F.log(m.cast("double"))).otherwise(F.lit(1.0))
    weight = F.when(marked > 0, (F.col("share") / 1000 + F.greatest(m - marked, F.lit(0))) / F.greatest(m, marked))
    style = style.select("host", "path", "pages", spread.alias("presentation"), "marked",
                         F.coalesce(weight, F.lit(1.0)).alias("weight"))
    leaf = uses.where(is_content).join(style.select("host", "path", "pages"), ["host", "path"])
    entropy = F.when(m > 1, F.log(F.col("df").cast("double")) / F.log(m.cast("double"))).otherwise(F.lit(0.0))
    leaf = leaf.groupBy("host", "path").agg(F.sum(1.0 - entropy).alias("imp"), F.count(F.lit(1)).alias("n"))
    parts = F.split("path", ">")
    below = (leaf.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(
            F.array_join(F.slice(parts, 1, i), ">").alias("node"),
            (F.size(parts) - i).alias("levels")))).alias("a"), "imp", "n")
        .groupBy("host", F.col("a.node").alias("path"))
        .agg((F.sum("imp") / F.sum("n")).alias("content"), F.max("a.levels").alias("levels")))
    share = F.pow(F.lit(gamma), F.col("levels") + 1)
    return (below.join(style, ["host", "path"])
            .select("host", "path", "pages",
                    ((1 - share) * F.col("presentation") + share * F.col("content")).alias("importance"),
                    "content", "weight", "marked"))


def _is_cut(path: str, cut: set[str]) -> bool:
    """Whether the path or one around it is cut."""
    at = len(path)
    while at >= 0:
        if path[:at] in cut:
            return True
        at = path.rfind(">", 0, at)
    return False


def _extract(batches):
    for b in batches:
        texts = []
        for source, cut, saved, names in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
            blocks, cut, saved, names = parse(source or "")[0], *(set(x or ()) for x in (cut, saved, names))
            shared = {p: shared_path(p, names) for p in {x for p, _, marks in blocks for x in (p, *marks)}}
            left = [t for p, t, marks in blocks if all(shared[m] in saved for m in marks) and not _is_cut(shared[p], cut)]
            texts.append("\n".join(left or unmarked_texts(blocks)))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_pages: int = MIN_PAGES, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """``(page_id, url, text)`` per row of ``pages``."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        text_of(F.col(f"`{html_col}`")).alias("html"),
                        host_of(F.col(f"`{url_col}`")).alias("host"))
    weighed = [F.col("weight") * F.col(c) < min_importance for c in ("content", "importance")]
    nodes, names = tree_rows(rows, min_pages)
    low = (node_importance(nodes, names).where(F.col("pages") >= min_pages)
           .select("host", "path", "marked", (weighed[0] & weighed[1]).alias("low"))
           .where("low OR marked > 0").groupBy("host").agg(
               F.collect_set(F.when(F.col("low"), F.col("path"))).alias("cut"),
               F.collect_set(F.when(~F.col("low"), F.col("path"))).alias("saved"))
           .join(names, "host", "left"))
    low = materialize(low, "judged-branches")  # such nodes and classes of templates: few per host
    kind = rows.schema["page_id"].dataType.simpleString()
    return (rows.join(low, "host", "left").select("page_id", "url", "html", "cut", "saved", "names")
            .mapInArrow(_extract, f"page_id {kind}, url string, text string"))


def query(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
