"""Main text of web pages by composite text density.

The page becomes a tree of elements. Every node gets its characters per tag, adjusted for links
(Sun, Song and Liao, 2011): text in links, and few tags without links, count against it. The
node with the largest sum of its children's densities holds the article; the least density on
its path to the body is the threshold that a neighbouring subtree must reach to belong to it.
Elements that are no article text by their kind (scripts, forms, menus, adverts, notices, reader
comments ...) are taken out first and count for nothing. A tag, class or id is a hint only: a part
that holds nearly all of the page's text outside links stays whatever it is called, one that is
called after a layout (``has-sidebar``) already with more than half of it, and within an article a
name that articles use themselves (``related-work``) only counts for short or link-heavy parts.

Defined results: null or empty html gives an empty text; character references are decoded;
white space (ASCII) inside a block is one space, blocks are joined by one space in page order;
nothing of the chosen subtree is dropped for being short. Broken markup is closed as browsers do
for paragraphs, list items and table parts; stray end tags are ignored.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody "
                  "td tfoot th thead tr ul".split())
NO_TEXT = frozenset("script style noscript template iframe object svg canvas select option button textarea head title "
                    "input label audio video map".split())
NO_ARTICLE = frozenset("nav footer aside form menu dialog".split())
# Names that pages give to parts which are no article text; of these, names of reader
# comments, and names that parts of an article bear as well; words that only speak of a part elsewhere.
NAMES = re.compile(
    r"(^|[\s_-])(ad|adbox|adsbygoogle|adslot|advert|advertisement|advertising|banner|breadcrumb|comment|commentlist|cookie|"
    r"consent|disqus|footer|global-header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|page-header|pagination|"
    r"popup|promo|promoted|promotion|related|respond|share|sharing|side-bar|sidebar|site-header|skip|skip-link|social|"
    r"sponsor|sponsored|subscribe|toolbar|top-bar|topbar|widget)(s?([\s_\d-]|$))", re.I)
COMMENTS = re.compile(r"comment|disqus|respond", re.I)
ALSO_ARTICLE = frozenset("banner breadcrumb consent cookie menu modal nav navigation newsletter notice popup promo promotion related "
                         "share sharing skip social sponsor sponsored subscribe toolbar widget".split())
ELSEWHERE = re.compile(r"(^|[\s_-])(has|have|with|without|no|not|hide|hidden|show)([_-]\w+)+", re.I)
#: A part that bears such a name within an article is short up to so many characters.
SHORT = 80
# What may stand in a head; anything else ends it.
IN_HEAD = frozenset("title meta base link script style noscript template noframes bgsound basefont head html".split())
#: A part that holds this share of the page's text outside links is the page, whatever its tag.
NEARLY_ALL = 0.9
#: The share for parts that are named after something else than reader comments.
MOST = 0.5
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_CLOSES = {"li": ("li", ("ul", "ol")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)), "tr": ("tr", ("table",)),
           "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "option": ("option", ("select",))}
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "depth", "items", "skip", "soft", "short", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, parent: Node | None, skip: bool):
        self.tag, self.parent, self.skip = tag, parent, skip
        self.depth = 0 if parent is None else parent.depth + 1
        self.soft = 0.0  # skipped for its tag or name unless it holds this share of the page
        self.short = False  # and only if it is short or link-heavy
        self.items: list = []  # child nodes and texts in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def _by_tag(tag: str, attrs, in_article: bool, names: bool) -> bool:
    """Whether a part is no article text by its tag, as long as it does not hold the page."""
    if tag in NO_ARTICLE:
        return True
    head = tag == "header" or names and any(k == "class" and v and "header" in v.lower().split() for k, v in attrs)
    return head and not in_article  # a page header, not an article's


def _by_name(tag: str, attrs, in_article: bool) -> tuple[float, bool]:
    """(share, short) of a part whose class or id names it as no article text; share 0 if none does."""
    if tag in ("html", "body", "article", "main"):
        return 0.0, False
    for name, value in attrs:
        if name not in ("class", "id") or not value:
            continue
        plain = ELSEWHERE.sub(" ", _CAMEL.sub("-", value))
        found = NAMES.search(plain)
        if found:
            if COMMENTS.search(plain):
                return NEARLY_ALL, False
            whole = found[2].lower() in re.split(r"\s+", plain.lower())
            return MOST, in_article and not whole and found[2].lower() in ALSO_ARTICLE
    return 0.0, False


def _is_boilerplate(tag: str, attrs) -> bool:
    if tag in NO_TEXT:
        return True
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and (value or "").strip().lower() in ROLES and not (tag == "form" and (value or "").strip().lower() == "form"):
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


class _Tree(HTMLParser):
    def __init__(self, names: bool = True):
        super().__init__(convert_charrefs=True)
        self.names = names
        self.root = self.at = Node("#document", None, False)
        self.nodes = [self.root]
        self.open: dict[str, list[Node]] = {}  # open elements by tag, innermost last

    def _leave(self, node: Node) -> None:
        """Close ``node`` and all that is open in it."""
        while self.at is not node.parent:
            self.open[self.at.tag].pop()
            self.at = self.at.parent

    def _close(self, tag: str, until: tuple = ()) -> None:
        """Close the innermost open ``tag`` unless one of ``until`` is open inside it."""
        if self.open.get(tag):
            node = self.open[tag][-1]
            if not any(self.open.get(u) and self.open[u][-1].depth > node.depth for u in until):
                self._leave(node)

    def _end_head(self) -> None:
        """Close an open head unless something other than noscript is open in it."""
        if self.open.get("head"):
            node = self.at
            while node.tag == "noscript":
                node = node.parent
            if node.tag == "head":
                self._leave(node)

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self._close("head")
        elif tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCK and tag not in ("html", "body"):
            self._close("p", ("td", "th", "table", "button", "object"))
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
            if tag in ("dt", "dd"):
                self._close("dd" if tag == "dt" else "dt", ("dl",))
            if tag in ("td", "th"):
                self._close("th" if tag == "td" else "td", ("tr", "table"))
        node = Node(tag, self.at, self.at.skip or _is_boilerplate(tag, attrs))
        if not node.skip:
            in_article = bool(self.open.get("article") or self.open.get("main"))
            if _by_tag(tag, attrs, in_article, self.names):
                node.soft = NEARLY_ALL
            elif self.names and attrs:
                node.soft, node.short = _by_name(tag, attrs, in_article)
        self.at.items.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.at = node
            self.open.setdefault(tag, []).append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close(tag, ("td", "th") if tag not in ("td", "th", "tr", "table", "tbody", "thead", "body", "html") else ())

    def handle_data(self, data):
        if self.at.tag == "head" and data.strip():
            self._end_head()
        if not self.at.skip:
            self.at.items.append(data)


def _skip_parts(nodes: list[Node]) -> None:
    """Skip what is no article text by its tag or name, but for parts that hold the page's text outside links."""
    plain, every = {}, {}  # characters outside links, and all, of each subtree
    for node in reversed(nodes):
        n = m = 0
        for item in node.items:
            if isinstance(item, str):
                size = len(item.strip())
                n, m = n + size, m + size
            else:
                n, m = n + plain[id(item)], m + every[id(item)]
        plain[id(node)], every[id(node)] = 0 if node.tag == "a" else n, m
    page = plain[id(nodes[0])]
    for node in nodes[1:]:
        own, whole = plain[id(node)], every[id(node)]
        if node.parent.skip:
            node.skip = True
        elif node.soft and own < max(1, node.soft * page):
            node.skip = not node.short or whole <= SHORT or 2 * own < whole


def _weigh(nodes: list[Node]) -> None:
    """Characters, tags and their link shares of each subtree; parents come before children."""
    for node in reversed(nodes):
        if node.skip:
            continue
        in_link = node.tag == "a"
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(item.strip())
            elif not item.skip:
                node.chars += item.chars
                node.tags += item.tags + 1
                node.link_chars += item.link_chars
                node.link_tags += item.link_tags + (item.tag == "a")
        if in_link:
            node.link_chars = node.chars


def _densities(nodes: list[Node], body: Node) -> None:
    body_links = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.skip or not node.chars:
            continue
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        base = math.log(c / max(c - lc, 1) * lc + body_links * c + math.e)
        node.density = c / t * math.log(c / max(lc, 1) * t / lt + 1e-9, max(base, 1.0 + 1e-9)) if base > 1 else \
            c / t * math.log(max(c / max(lc, 1) * t / lt, 1.0) + math.e - 1)


def _chosen(nodes: list[Node], body: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    best, most = body, -1.0
    for node in nodes:
        if node.skip:
            continue
        total = sum(x.density for x in node.items if not isinstance(x, str) and not x.skip)
        if any(isinstance(x, str) and x.strip() for x in node.items) and node.tag in BLOCK:
            total += node.density if total == 0 else 0  # bare text directly in a block
        if total > most:
            best, most = node, total
    limit, node = best.density, best
    while node is not None:
        if node is body or node.chars:
            limit = min(limit, node.density)
        if node is body:
            break
        node = node.parent
    top = best  # an article or main element around the densest node widens the choice to all of it
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            top = node
            if node.tag == "article":
                break
        node = node.parent
    while top.tag not in BLOCK and top.parent is not None:
        top = top.parent
    out = [top]
    while top is not body and top.parent is not None:  # neighbours as dense as the path belong to it
        mates = [x for x in top.parent.items if not isinstance(x, str) and (
            x is top or not x.skip and x.chars and x.density >= limit > 0)]
        if len(mates) > 1:
            at = mates.index(top)
            out = mates[:at] + out + mates[at + 1:]
        top = top.parent
    return out


def _blocks(top: Node, out: list[str]) -> None:
    """The texts of the blocks below ``top``."""
    run: list[str] = []

    def flush():
        text = _SPACE.sub(" ", "".join(run)).strip(" \t\n\r\f\v")
        run.clear()
        if text:
            out.append(text)

    stack = [(top, 0)]
    while stack:
        node, i = stack.pop()
        if i == 0 and node.tag in BLOCK:
            flush()
        while i < len(node.items):
            item = node.items[i]
            i += 1
            if isinstance(item, str):
                run.append(item)
            elif item.skip:
                if item.tag in BLOCK:
                    flush()
            elif item.tag == "br":
                run.append(" ")
            else:
                stack.append((node, i))
                stack.append((item, 0))
                break
        else:
            if node.tag in BLOCK:
                flush()
    flush()


def main_text(html: str | None) -> str:
    """The article's text; where parts' names would leave nothing of a page, they are not believed."""
    if not html:
        return ""
    return _text(html, True) or _text(html, False)


def _text(html: str, names: bool) -> str:
    tree = _Tree(names)
    tree.feed(html)
    tree.close()
    _skip_parts(tree.nodes)
    body = next((n for n in tree.nodes if n.tag == "body"), tree.root)
    _weigh(tree.nodes)
    if not body.chars:
        body = tree.root
    _densities(tree.nodes, body)
    out: list[str] = []
    for top in _chosen(tree.nodes, body):
        _blocks(top, out)
    return " ".join(out)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, text and n_chars of every page."""
    slim = pages.select(*keep, F.col(html).alias("__html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [main_text(x) for x in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    names=[*keep, "text", "n_chars"])

    return slim.mapInArrow(run, f"{fields}, text string, n_chars long")
