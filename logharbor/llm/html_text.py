"""Main text of web pages by site template removal.

Every element's subtree is hashed (tag, class, id, text and the hashes below it). Spark counts in
how many different pages of a host each hash occurs, and subtrees that recur across many of them
are template and are deleted, as are elements that are never article text (menus, forms, scripts,
asides, marked adverts or comments, ...). What remains of the article is the text.

A page's content roots are its outermost articles and its main elements (a main with text of its
own besides its articles is one root with them), else the outermost elements marked as content,
else its body. Recurring blocks are deleted inside roots too, with one exception: bare paragraphs and
headings of an article, list items, cells and inline elements are an author's own and stay there.

A subtree counts once per distinct article or root it lies in (outside roots: per distinct page), so
copies of an article or a page count once. The count needed does not grow with the host. A page's
recurring hashes are found by a join, so there is no list per host.
Parsing takes time in proportion to the length, however broken the markup. A class or id marks an
element by its whole name: a compound one only if all its words are known ("site-nav", not "ad-free").
Rows with a null or empty html have no text; a null or strange url puts the page on
a host of its own name (the empty host is never counted). Repeated rows give repeated results.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored

MIN_PAGES = 5           # a template subtree is in as many different roots or pages of the host, at least

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 "
    "h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCKS - frozenset("body head html legend option optgroup summary tbody td tfoot th thead title tr".split())
CLOSED_BY_SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SCOPES = frozenset("article body div section table td th ul ol dl html main aside nav header footer form blockquote".split())

# Elements and markings that are never article text.
NEVER = frozenset(
    "head script style noscript template iframe object embed svg canvas nav aside footer form button select textarea input dialog "
    "menu audio video noembed noframes title".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pager pagination popup promo promoted promotion reader-comments related replies respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar widget".split())
MARK_STEMS = ("advert", "breadcrumb", "comment", "cookie", "navbar", "newsletter", "sidebar", "sponsor")
PAGE_MARKS = frozenset("header logo topbar".split())        # of the page's frame; inside an article they may hold its title
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
CONTENT = frozenset("article content entry main post story".split())
HEADED = frozenset("p h1 h2 h3 h4 h5 h6".split())
PARTS = frozenset("li dt dd tr td th thead tbody tfoot article main".split())
SENTENCES = HEADED | frozenset("li dt dd td th blockquote pre figcaption".split())

# Words that say nothing by themselves in a compound name: "site-nav" is a menu, "nav-theory" is not.
NEUTRAL = frozenset(
    "area articles bar block body bottom box button buttons col column container desktop form global google head holder inline inner item "
    "items leaderboard left link links list main mobile module outer page panel posts primary rail reader right row secondary section "
    "site slot stories text thread top trail unit user wrap wrapper x".split())

NAMES = MARKS | PAGE_MARKS | CONTENT | NEUTRAL

_ASIDE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?", re.DOTALL)
_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
_UNQUOTED = re.compile(r"[^>\"']*+")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/<>]*+)([^<>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "attributes", "children", "parent", "hash")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.hash = 0


class Tags:
    """The tags of a source in order, in time linear in its length.

    A tag whose quotes never close cannot be told from text. Up to the last such quote a tag then
    ends at the next ``>`` that no ``<`` comes before, quotes or not; each kind of quote, and the
    lack of a ``>``, is found out once.
    """

    def __init__(self, source: str):
        self.source, self.loose_until = source, 0

    def at(self, start: int) -> tuple[int, str, str, str] | None:
        """End, slash, name and attributes of the tag at ``start``; None if there is none."""
        if start >= self.loose_until:
            m = _NAME.match(self.source, start)
            if not m:
                return None
            end = self._end(m.end())
            if end is not None:
                return end, m.group(1), m.group(2), self.source[m.end():end - 1]
        m = _LOOSE.match(self.source, start)
        return (m.end(), *m.groups()) if m else None

    def _end(self, at: int) -> int | None:
        while True:
            at = _UNQUOTED.match(self.source, at).end()
            if at == len(self.source):
                self.loose_until = at
                return None
            if self.source[at] == ">":
                return at + 1
            closing = self.source.find(self.source[at], at + 1)
            if closing < 0:
                self.loose_until = at + 1
                return None
            at = closing + 1


class Path:
    """Open elements from the root on, with their depths by tag, so that no search walks up a deep tree."""

    def __init__(self, root: Node):
        self.nodes, self.depths, self.scopes = [root], {}, [0]

    def open(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in SCOPES:
            self.scopes.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        """Close the element of that depth and all below it."""
        while len(self.nodes) > depth:
            tag = self.nodes.pop().tag
            self.depths[tag].pop()
            if tag in SCOPES:
                self.scopes.pop()

    def close(self, tag: str) -> None:
        depths = self.depths.get(tag)
        if depths and (tag in BLOCKS or depths[-1] > self.scopes[-1]):
            self.cut(depths[-1])

    def close_implied(self, tag: str) -> None:
        """Close what a new ``tag`` ends: an open paragraph, or an open item of the same list."""
        ends = CLOSED_BY_SAME.get(tag, "").split()
        at = len(self.scopes) - 1
        while at > 0 and self.nodes[self.scopes[at]].tag in ends:
            at -= 1
        stop = self.scopes[at]
        items = [d for d in (self._within(e, stop) for e in ends) if d]
        if items:
            self.cut(min(d[0] for d in items) if tag == "tr" else max(d[-1] for d in items))
        elif tag in CLOSES_P:
            paragraphs = self._within("p", stop)
            if paragraphs:
                self.cut(paragraphs[0] if ends else paragraphs[-1])

    def _within(self, tag: str, stop: int) -> list[int]:
        depths = self.depths.get(tag)
        return depths[bisect_right(depths, stop):] if depths and depths[-1] > stop else []


def parse(source: str) -> Node:
    """Element tree; unclosed and stray tags are mended the way browsers do in the common cases."""
    root = Node("html", {}, None)
    path, tags = Path(root), Tags(source)
    at = look = 0               # where the open text starts, and where the next "<" is looked for
    has_body = False
    while True:
        start = source.find("<", look)
        if start < 0:
            break
        aside = _ASIDE.match(source, start)
        tag = None if aside else tags.at(start)
        if not aside and not tag:
            look = start + 1
            continue
        if start > at:
            path.nodes[-1].children.append(entities.unescape(source[at:start]))
        if aside:
            at = look = aside.end()
            if aside.group().startswith("<![CDATA["):
                path.nodes[-1].children.append(aside.group()[9:].removesuffix("]]>"))
            continue
        at, slash, name, inside = tag
        look, name = at, name.lower()
        if slash:
            path.close(name)
            continue
        if name == "html" or name == "body" and has_body:
            continue
        if name in CLOSES_P or name in CLOSED_BY_SAME:
            path.close_implied(name)
        attributes = {k.lower(): entities.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(inside)} if inside else {}
        above = path.nodes[-1]
        node = Node(name, attributes, above)
        above.children.append(node)
        has_body = has_body or name == "body" and above is root
        if name in VOID or inside.endswith("/") and name not in BLOCKS:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*+>", re.IGNORECASE).search(source, at)
            node.children.append(source[at:end.start() if end else len(source)])
            at = look = end.end() if end else len(source)
            continue
        path.open(node)
    if at < len(source):
        path.nodes[-1].children.append(entities.unescape(source[at:]))
    return root


def never_text(node: Node, in_content: bool) -> bool:
    """By its tag or markings, an element that holds no article text."""
    a = node.attributes
    if node.tag in NEVER or node.tag == "header" and not in_content:
        return True
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none", a.get("style", ""), re.IGNORECASE):
        return True
    if node.tag in ("html", "body", "article", "main") and not _marks(a) & {"comment", "comments", "ad", "ads", "advert", "promo", "related", "sponsored"}:
        return False
    marks = _marks(a)
    return bool(marks & MARKS) or any(m.startswith(MARK_STEMS) for m in marks) or not in_content and bool(marks & PAGE_MARKS)


def _marks(a: dict[str, str]) -> set[str]:
    """Class and id names, and the words of compound names that consist of known words alone."""
    found: set[str] = set()
    for name in f"{a.get('class', '')} {a.get('id', '')}".split():
        words = [w.lower() for w in _WORD.findall(name)]
        if len(words) == 1 or all(w in NAMES or w.startswith(MARK_STEMS) for w in words):
            found.update(words)
        else:
            found.add(name.lower())
    return found


def marked_content(a: dict[str, str]) -> bool:
    marks = _marks(a)
    return bool(marks & CONTENT) and not marks & PAGE_MARKS


def walk(root: Node) -> Iterator[Node]:
    """All elements, children before parents."""
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, done = stack.pop()
        if done:
            yield node
        else:
            stack.append((node, True))
            stack += [(c, False) for c in reversed(node.children) if isinstance(c, Node)]


def hash_subtrees(root: Node) -> None:
    for node in walk(root):
        parts = [node.tag, node.attributes.get("class", ""), node.attributes.get("id", "")]
        parts += [str(c.hash) if isinstance(c, Node) else " ".join(c.split()) for c in node.children]
        node.hash = xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def is_main(node: Node) -> bool:
    return node.tag == "main" or node.attributes.get("role", "").lower() == "main"


def content_roots(root: Node) -> list[Node]:
    """The elements that hold the page's own text in page order, and nothing of each other."""
    found: list[tuple[Node, Node | None]] = []
    marked: list[Node] = []
    stack: list[tuple[Node, bool, Node | None, bool]] = [(root, False, None, False)]
    while stack:
        node, inside, main, within = stack.pop()
        if node is not root and never_text(node, inside):
            continue
        if node.tag == "article" and not inside:
            found.append((node, main))
            inside = True
        elif is_main(node) and not inside and main is None:
            found.append((node, None))
            main = node
        elif not within and (node.tag in ("div", "section") and marked_content(node.attributes) or
                             node.attributes.get("itemprop", "").lower() == "articlebody"):
            marked.append(node)
            within = True
        stack += [(c, inside, main, within) for c in reversed(node.children) if isinstance(c, Node)]
    whole = {id(n) for n, _ in found if n.tag != "article" and has_own_text(n)}
    roots = [n for n, main in found if id(n) in whole or n.tag == "article" and id(main) not in whole]
    return roots or [n for n, _ in found] or marked


def has_own_text(main: Node) -> bool:
    """Whether a main element has text besides its articles."""
    stack: list[Node | str] = [main]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            if item.strip():
                return True
        elif item is main or item.tag != "article" and not never_text(item, True):
            stack += item.children
    return False


def text_of(node: Node, recurring: frozenset[int], in_content: bool) -> str:
    """Text of the blocks below ``node``, deleted elements left out."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    stack: list[tuple[Node | str | None, bool]] = [(node, False)]
    while stack:
        item, in_article = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            line.append(item)
        elif item is not node and (never_text(item, in_content) or item.hash in recurring and deletable(item, in_content, in_article)):
            if item.tag in BLOCKS:
                close()
        elif item.tag == "br":
            line.append(" ")
        else:
            if item.tag in BLOCKS:
                close()
                stack.append((None, False))
            inside = in_article or item.tag == "article"
            stack += [(c, inside) for c in reversed(item.children)]
    close()
    return " ".join(blocks)


def deletable(node: Node, in_content: bool, in_article: bool) -> bool:
    """Whether a recurring subtree goes; parts of an author's sentences, lists and tables do not."""
    if not in_content:
        return node.tag in BLOCKS or node.parent.tag in BLOCKS and node.parent.tag not in SENTENCES
    if node.tag in BLOCKS and node.tag not in PARTS and \
            not (in_article and node.tag in HEADED and not node.attributes.get("class") and not node.attributes.get("id")):
        return True
    return node.tag == "p" and mostly_links(node)


def mostly_links(node: Node) -> bool:
    text = links = 0
    stack: list[tuple[Node | str, bool]] = [(node, False)]
    while stack:
        item, linked = stack.pop()
        if isinstance(item, str):
            size = len(item.strip())
            text += size
            links += size if linked else 0
        else:
            stack += [(c, linked or item.tag == "a") for c in item.children]
    return text > 0 and 2 * links >= text


def main_text(source: str | None, recurring: frozenset[int] = frozenset()) -> str:
    if not source:
        return ""
    root = parse(source)
    if recurring:
        hash_subtrees(root)
    roots = content_roots(root)
    if not roots:
        return text_of(root, recurring, False)
    return " ".join(t for t in (text_of(r, recurring, True) for r in roots) if t)


def subtree_hashes(source: str | None) -> list[tuple[int, int]]:
    """The distinct hashes of a page's elements, each with that of the outermost article, root or page it is in.

    html and body, which are the page, are left out.
    """
    if not source:
        return []
    root = parse(source)
    hash_subtrees(root)
    roots = {id(n) for n in content_roots(root)}
    out: set[tuple[int, int]] = set()
    stack: list[tuple[Node, int, bool]] = [(root, root.hash, False)]
    while stack:
        node, owner, in_article = stack.pop()
        if node.tag not in ("html", "body", "head", "br"):
            out.add((node.hash, owner))
        if not in_article and (node.tag == "article" or id(node) in roots):
            owner, in_article = node.hash, node.tag == "article"
        stack += [(c, owner, in_article) for c in node.children if isinstance(c, Node)]
    return sorted(out)


# --- on tables ---------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def page_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, page, recurring`` of ``pages (host, page, html)``: the template subtrees of each page that has some, a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [subtree_hashes(h.as_py()) for h in batch.column(2)]
            lists = [pa.array([[pair[k] for pair in pairs] for pairs in found], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["host", "page", "hashes", "owners"])

    hashed = small_batches(pages.filter("host <> ''").select("host", "page", "html")).mapInArrow(
        run, "host string, page bigint, hashes array<bigint>, owners array<bigint>")
    firsts = [F.first(c).alias(c) for c in ("hashes", "owners")]
    once = stored(hashed.groupBy("host", "page").agg(*firsts), "subtrees")
    owned = once.select("host", F.explode(F.arrays_zip("hashes", "owners")).alias("_s")).select(
        "host", F.col("_s.hashes").alias("hash"), F.col("_s.owners").alias("owner")).distinct()
    many = stored(owned.groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages).select("host", "hash"), "recurring")
    found = once.select("host", "page", F.explode(F.array_distinct("hashes")).alias("hash")).join(many, ["host", "hash"])
    return stored(found.groupBy("host", "page").agg(F.collect_list("hash").alias("recurring")), "templates")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages (page_id, url, html)``."""
    types = dict(pages.dtypes)
    named = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("page"))
    joined = named.join(page_templates(named, min_pages), ["host", "page"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), frozenset(hashes.as_py() or ()))
                     for html, hashes in zip(batch.column("html"), batch.column("recurring"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return small_batches(joined.select("page_id", "url", "html", "recurring")).mapInArrow(
        run, f"page_id {types['page_id']}, url string, text string, n_chars bigint")
