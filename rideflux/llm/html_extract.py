"""Main text of web pages: site template removal.

1. Every page is parsed into an element tree and each subtree hashed (tag,
   attributes, text, children's hashes); hashes inside and outside articles
   are kept apart.
2. Spark counts, per host, on how many different pages each subtree hash
   occurs; equal copies of a page count once.  Subtrees on ``MIN_PAGES`` pages
   and ``MIN_SHARE`` of the host's pages or more are its template; blocks also
   on a large host's ``MANY_PAGES`` and ``SMALL_SHARE``, for its sections and
   rotating notices.  Inside
   articles different articles are counted, and a block is template from
   ``MIN_ARTICLES`` and ``ARTICLE_SHARE`` of the host's articles: a sentence
   that many articles share is text, one that nearly all have is not.
3. Pages are extracted without template subtrees and without what its markup
   declares to be a menu, header, footer, sidebar, notice, advert, form,
   script, style or comment section.  Where a page has an article, its text is
   the article's, otherwise what is left of the body; the body also where the
   articles hold less than ``MINOR`` of its words.

Headings, list items and table parts go only with the block that holds them,
and an article that would keep less than ``MINOR`` of its words keeps its
blocks: it is one of a host's near copies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm.common import ship, stored

MIN_PAGES = 3
MIN_SHARE = 0.3
MANY_PAGES = 100
SMALL_SHARE = 0.01
MIN_ARTICLES = 5
ARTICLE_SHARE = 0.8
#: A smaller share of the words is a minor part.
MINOR = 0.25
#: So many words outside links that a body has besides its articles to stand for them.
MIN_BODY = 50
#: Words outside links below which a block's name may decide inside an article.
SHORT = 50
#: Most template hashes (and hosts) that are broadcast; beyond, pages are shuffled by host.
MAX_BROADCAST = 1_000_000

# Fixed values of HTML: elements without an end tag, elements that end a
# paragraph, elements that stand in the flow of text, and optional end tags.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "option": frozenset({"option", "optgroup"}), "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
}
CLOSES: dict[str, list[str]] = {}
for _name, _tags in CLOSED_BY.items():
    for _tag in _tags:
        CLOSES.setdefault(_tag, []).append(_name)
SCOPE = frozenset("article aside body div footer header html main nav section table td th ul ol dl".split())
# Parts of a heading, list or table: alone they are no template inside an article, and elsewhere only from MIN_SHARE.
PARTS = frozenset("h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption col colgroup summary legend".split())
# Fixed values of the extraction: elements that are no article text, and words
# in class, id or role that say so.
DROPPED = frozenset(
    "head title script style noscript template iframe object embed applet svg canvas audio video map nav aside footer form "
    "button select textarea input datalist dialog menu frameset".split())
SIGNALS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion promoted "
    "cookie cookies consent gdpr notice notices alert sidebar sidebars menu menus nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer header masthead topbar toolbar comment comments commentlist disqus respond reply "
    "replies share sharing social related recommended recommendations popup modal overlay newsletter subscribe "
    "subscription signup login search widget widgets skip copyright contentinfo complementary form dialog".split())
#: These also where the element holds an article: that is a reader's or another page's.
FOREIGN = frozenset(
    "comment comments commentlist disqus respond reply replies related recommended recommendations".split())
#: Words that say nothing beside a signal.
COMPANIONS = frozenset(
    "area bar block box button buttons container group inner item items link links list section unit wrap wrapper".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attrs", "items", "mark", "holds", "words")

    def __init__(self, tag: str, attrs: list):
        self.tag, self.attrs, self.items, self.mark = tag, attrs, [], None
        self.holds = False  # an article or main element below
        self.words = -1  # outside links, once counted


class Tree(HTMLParser):
    """Element tree with HTML's optional end tags; stray end tags are ignored.

    For every tag the positions of its open elements are kept, so a tag costs
    no walk over the open elements, however many are never closed.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", [])
        self.open = [self.root]
        self.at: dict[str, list[int]] = {}
        self.scopes = [0]

    def _close(self, k: int) -> None:
        """Close the open elements from position ``k`` on."""
        for node in self.open[k:]:
            self.at[node.tag].pop()
            if node.tag in SCOPE:
                self.scopes.pop()
        del self.open[k:]

    def handle_starttag(self, tag, attrs):
        k = max((self.at[name][-1] for name in CLOSES.get(tag, ()) if self.at.get(name)), default=0)
        if k and k >= self.scopes[-1]:
            self._close(k)
        node = Node(tag, attrs)
        self.open[-1].items.append(node)
        if tag in ("article", "main"):
            for above in reversed(self.open):
                if above.holds:
                    break
                above.holds = True
        if tag not in VOID:
            self.at.setdefault(tag, []).append(len(self.open))
            if tag in SCOPE:
                self.scopes.append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style", "iframe", "svg", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = self.at.get(tag)
        if at and not (tag in INLINE and self.scopes[-1] > at[-1]):
            self._close(at[-1])

    def handle_data(self, data):
        self.open[-1].items.append(data)


def parse(html: str) -> Node:
    t = Tree()
    t.feed(html)
    t.close()
    return t.root


def in_order(root: Node) -> list[Node]:
    """All elements, each before what it holds."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return out


def plain_words(node: Node) -> int:
    """Words below an element that are not in links."""
    if node.words < 0:
        for x in reversed(in_order(node)):
            if x.words < 0:
                x.words = 0 if x.tag == "a" else sum(
                    y.words if isinstance(y, Node) else len(y.split()) for y in x.items)
    return node.words


def boilerplate(node: Node, inside: bool) -> bool:
    """Whether markup declares an element to be no article text; ``inside``:
    it is part of an article, whose own header and title stay.

    Inside an article a name counts only if it says nothing else
    (``ad-box``, not ``notice-period``), and it decides by itself only for
    readers' comments and links to other pages; any other block goes only if
    it has less than ``SHORT`` words outside links.
    """
    if node.tag in DROPPED or (node.tag == "header" and not inside):
        return True
    for name, value in node.attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and value and HIDDEN.search(value):
            return True
        if name in ("class", "id", "role") and value and node.tag not in ("html", "body", "main"):
            own = node.holds or node.tag == "article" or (inside and node.tag in ("h1", "h2", "h3", "header"))
            if not inside:
                words = {w.lower() for w in WORDS.findall(value)}
                if words & (FOREIGN if own else SIGNALS):
                    return True
                continue
            for token in value.split():
                words = {w.lower() for w in WORDS.findall(token)}
                if words & SIGNALS and words <= SIGNALS | COMPANIONS and (
                        words & FOREIGN or (not own and plain_words(node) < SHORT)):
                    return True
    return False


def articles(root: Node) -> list[Node]:
    """Outermost article elements (or main ones, without any) that are not in boilerplate."""
    for tag in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag != "#root" and boilerplate(node, False):
                continue
            if node.tag == tag:
                found.append(node)
            else:
                todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
        if found:
            return found
    return []


def subtree_hashes(root: Node, tops: list[Node]) -> tuple[list[int], list[int], int]:
    """Hashes of the subtrees outside articles (even) and of the blocks inside
    the articles ``tops`` (odd), set as each element's ``mark``, and one hash
    of what the articles hold.  Bit 1 is set for what is not a block of its own."""
    inner = {id(node) for a in tops for node in in_order(a)}
    own = {id(a) for a in tops}
    outside, inside, held = [], [], {}
    for node in reversed(in_order(root)):
        within = id(node) in inner
        # An element that holds an article is no template.
        if not within and any(isinstance(x, Node) and x.mark == 0 for x in node.items):
            node.mark = 0
            continue
        parts = [node.tag, *(f"{k}={v}" for k, v in sorted((k, v or "") for k, v in node.attrs))]
        parts += [str(x.mark) if isinstance(x, Node) else " ".join(x.split()) for x in node.items]
        block = node.tag not in INLINE and node.tag not in PARTS
        h = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "replace"), seed=11) & ~3 | within | (not block) << 1
        h = h - (1 << 64) if h >= 1 << 63 else h
        if id(node) in own:
            held[id(node)] = h
            node.mark = 0
            continue
        node.mark = h or 4
        if node.tag in VOID:
            continue
        if not within:
            if node.tag not in ("#root", "html", "body"):
                outside.append(node.mark)
        elif block:
            inside.append(node.mark)
    articles_hash = xxhash.xxh64_intdigest(",".join(str(held[id(a)]) for a in tops), seed=11) >> 1
    return outside, inside, articles_hash


def _blocks(tops: list[Node], own: list[Node], template: frozenset[int]) -> tuple[list[str], int]:
    """Blocks of text below ``tops`` and the number of words outside links;
    ``own``: the articles, whose own header and title stay."""
    blocks, run, links, n = [], [], 0, 0

    def flush():
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    starts, tops_ids = {id(x) for x in own}, {id(x) for x in tops}
    todo: list = [(x, False) for x in reversed(tops)]
    while todo:
        x, inside = todo.pop()
        if x is None:
            flush()
        elif x == "</a>":
            links -= 1
        elif isinstance(x, tuple):
            run.append(x[0])
            n += 0 if links else len(x[0].split())
        elif x.tag == "br":
            run.append(" ")
        elif (x.mark and x.mark in template) or (id(x) not in tops_ids and boilerplate(x, inside)):
            if x.tag not in INLINE:
                flush()
        else:
            inside = inside or id(x) in starts
            if x.tag not in INLINE:
                flush()
                todo.append((None, inside))
            elif x.tag == "a":
                links += 1
                todo.append(("</a>", inside))
            todo.extend((y if isinstance(y, Node) else (y,), inside) for y in reversed(x.items))
    flush()
    return blocks, n


def main_text(root: Node, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the page's text joined by a line break."""
    own = articles(root)
    inside = any(t & 1 for t in template)
    if own and not inside:
        # No template inside articles.  Where even all the page's words outside links
        # leave the articles a major part, the rest needs no look.
        blocks, n = _blocks(own, own, frozenset())
        if n >= MINOR * plain_words(root):
            return "\n".join(blocks)
    if template:
        subtree_hashes(root, own)
    if not own:
        return "\n".join(_blocks([root], [], template)[0])
    if inside:
        blocks, n = _blocks(own, own, template)
        whole, n_whole = _blocks(own, own, frozenset())
        if n < MINOR * n_whole:
            template = frozenset(t for t in template if not t & 1)
            blocks, n = whole, n_whole
    body, n_body = _blocks([root], own, template)
    return "\n".join(body if n_body - n >= MIN_BODY and n < MINOR * n_body else blocks)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hosts, page, hashes = [], [], []
        for host, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            content = xxhash.xxh64_intdigest((html or "").encode()) >> 1
            root = parse(html or "")
            tops = articles(root)
            outside, inside, held = subtree_hashes(root, tops)
            # 0 counts the pages, 1 the articles
            for of, marks in ((content, {0, *outside}), (held, {1, *inside} if tops else ())):
                hosts += [host] * len(marks)
                page += [of] * len(marks)
                hashes += marks
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(page, pa.int64()), pa.array(hashes, pa.int64())],
            ["host", "page", "subtree"])


def host(url: str) -> F.Column:
    """Lower-cased host of a url column; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def site_templates(pages: DataFrame) -> DataFrame:
    """``host, template``: hashes of the subtrees that recur on the host.

    A template hash is on ``SMALL_SHARE`` of a host's pages at least (the odd
    ones, from inside articles, on ``ARTICLE_SHARE`` of its articles), so a host
    has at most 1 / ``SMALL_SHARE`` times as many as a page has elements.
    """
    counts = stored(pages.mapInArrow(_subtrees, "host string, page long, subtree long")
                    .groupBy("host", "subtree").agg(F.count_distinct("page").alias("n")), "html-counts")
    total = counts.where("subtree IN (0, 1)").groupBy("host").agg(
        F.sum(F.expr("IF(subtree = 0, n, 0)")).alias("pages"), F.sum(F.expr("IF(subtree = 1, n, 0)")).alias("articles"))
    often = counts.where(f"subtree NOT IN (0, 1) AND n >= {MIN_PAGES}").join(total, "host").where(
        f"IF(subtree & 1 = 0, n >= {MIN_SHARE} * pages OR subtree & 2 = 0 AND n >= {MANY_PAGES} AND n >= {SMALL_SHARE} * pages, n >= {MIN_ARTICLES} AND n >= {ARTICLE_SHARE} * articles)")
    return often.groupBy("host").agg(F.collect_list("subtree").alias("template"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        known: dict[tuple, frozenset] = {}
        texts = []
        for html, template in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            key = tuple(template or ())
            if key not in known:
                known[key] = frozenset(key)
            texts.append(main_text(parse(html or ""), known[key]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages (page_id, url, html)``.

    White space inside a block becomes one space, blocks are joined by a line
    break, character references are decoded.  Null and empty html give an
    empty text; pages without a host form one site.  Ids and urls are only
    carried: null and repeated rows are fine.  Other columns are not read; an
    empty table gives no rows.  Work and memory of a very long page grow with it,
    also where its tags are never closed.
    """
    ship(pages.sparkSession)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", host("url"))
    templates = stored(site_templates(rows.select("host", "html")), "html-templates")
    held = templates.agg(F.count("*") + F.coalesce(F.sum(F.size("template")), F.lit(0))).first()[0]
    if held <= MAX_BROADCAST:
        templates = F.broadcast(templates)
    kind = dict(rows.dtypes)["page_id"]
    texts = rows.join(templates, "host", "left").select("page_id", "url", "html", "template").mapInArrow(
        _extract, f"page_id {kind}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
