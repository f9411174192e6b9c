"""Main text of web pages by composite text density.

A page becomes a tree of elements.  Elements that are never article text (menus,
scripts, asides and the like, by tag) leave the tree first.  Forms, hidden elements and
those with a whole class, id or role of ``FOREIGN`` (notices, comments of readers) leave
it too, unless they wrap the article: what lies in them has a far greater density sum
than the page around them.  Every remaining node has

* C characters and T tags below it, of which LC and LT within links, and
* a composite density: C / T, scaled by a logarithm whose argument falls and whose
  base grows with the share of links, so that lists of links fall behind prose;
* a density sum: the densities of its children added up.

The node with the greatest density sum is the core.  The least density on its path to
the body is the threshold.  From the body down, every node that reaches the threshold
gives the subtree below it with the greatest density sum to the text, so that an
article of several sections is found whole.  Where the core lies in an ``article`` or
``main`` element, that element is the text.

Blocks of the chosen subtrees come in page order.  Each page is parsed in one task by
the standard library's tokenizer, which also decodes character references.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What HTML says of these elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NOT_TEXT = frozenset(
    "script style noscript template head title iframe object embed canvas svg math audio video map select option textarea "
    "button input nav menu footer aside dialog".split()
)
FORMS = frozenset(["form", "fieldset"])
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSED_BY_SAME = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
    "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"},
}
ALIKE = [{"dt", "dd"}, {"td", "th"}, {"thead", "tbody", "tfoot"}]

# Classes, ids and roles that mark an element as no part of the article.
FOREIGN = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "contentinfo cookie cookies copyright disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup promo promoted promotion recommended related replies respond search share sharing "
    "sidebar social sponsor sponsored subscribe subscription teaser toolbar topbar widget alert complementary "
    "dialog disclaimer signup".split()
)
# How often the density sum around it a marked element must hold to be a wrapper; one around a single article or a main element.
WRAPS, WRAPS_ARTICLE = 10.0, 3.0
_BLANKS = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "items", "foreign", "mark", "marked", "chars", "tags", "link_chars", "link_tags", "own", "density", "sum", "best", "best_node")

    def __init__(self, tag: str, foreign: bool = False):
        self.tag, self.foreign, self.mark, self.marked = tag, foreign, "", False
        self.items: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.own = [0, 0, 0, 0]
        self.density = self.sum = self.best = 0.0
        self.best_node: Node = self


class Tree(HTMLParser):
    """Elements and texts of a page; unclosed elements end where HTML ends them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.path = [self.root]
        self.places: dict[str, list[int]] = {}  # of each tag's open elements in the path

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            if self.places.get(tag):
                return
            if tag == "body":
                self._close("head")
        elif tag == "head" and self.path[-1].tag not in ("#root", "html"):
            return
        elif self.path[-1].tag == "head" and tag not in IN_HEAD:
            self._begin_body()
        if tag not in INLINE and tag not in VOID:
            # A block ends an open paragraph, with whatever is open inside it.
            self._close("p", within=frozenset(["table", "td", "th", "button", "li", "div", "article", "section"]))
        if tag in CLOSED_BY_SAME:
            for same in next((s for s in ALIKE if tag in s), {tag}):
                self._close(same, within=CLOSED_BY_SAME[tag])
        node = Node(tag, tag in NOT_TEXT or self._is_foreign(tag))
        if not node.foreign:
            node.mark = self._mark(tag, attrs)
            node.foreign = bool(node.mark)  # until unwrapped
            self.path[-1].marked |= node.foreign
        self.path[-1].items.append(node)
        if tag not in VOID:
            self._open(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.path[-1].tag == tag and tag in ("svg", "math", "path"):
            self._cut(len(self.path) - 1)

    def handle_endtag(self, tag):
        if tag not in VOID and tag not in ("html", "body"):
            self._close(tag)

    def handle_data(self, data):
        if self.path[-1].tag == "head" and data.strip():
            self._begin_body()
        self.path[-1].items.append(data)

    def _begin_body(self) -> None:
        """What cannot stand in the head ends it."""
        self._close("head")
        self.path[-1].items.append(node := Node("body"))
        self._open(node)

    def _open(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.path))
        self.path.append(node)

    def _cut(self, place: int) -> None:
        while len(self.path) > place:
            self.places[self.path.pop().tag].pop()

    def _close(self, tag: str, within: frozenset | set = frozenset()) -> None:
        places = self.places.get(tag)
        if places and all(not self.places.get(w) or self.places[w][-1] <= places[-1] for w in within):
            self._cut(places[-1])

    def _is_foreign(self, tag: str) -> bool:
        # The heading of an article stays, that of the page goes.
        return tag == "header" and not (self.places.get("article") or self.places.get("main"))

    def _mark(self, tag: str, attrs) -> str:
        """Why an element may be foreign; empty for others."""
        inside = self.places.get("article") or self.places.get("main")
        if tag in ("html", "body", "main", "header") or tag == "article" and not inside:
            return ""
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return name
            if name in ("class", "id", "role") and value:
                for token in value.lower().split():
                    if token in FOREIGN:
                        return token
        return tag if tag in FORMS else ""


def parse(html: str) -> Node:
    """The tree of a page.  From the first ``<`` that no ``>`` follows all is text.

    The library comes to the same end, but tries each further ``<`` up to the end of the page.
    """
    cut = html.find("<", html.rfind(">") + 1)
    whole, rest = (html, "") if cut < 0 else (html[:cut], html[cut:])
    tree = Tree()
    try:
        tree.feed(whole)
        tree.close()
    except AssertionError:  # a malformed declaration; what was read stays
        pass
    if rest:
        tree.handle_data(unescape(rest))
    return tree.root


def _visible(node: Node) -> list[tuple[Node, int]]:
    """A node and all below that are not foreign, each before its children, with its parent's place."""
    order, todo = [], [(node, -1)]
    while todo:
        node, parent = todo.pop()
        todo += [(item, len(order)) for item in reversed(node.items) if not isinstance(item, str) and not item.foreign]
        order.append((node, parent))
    return order


def _measure(order: list[tuple[Node, int]]) -> None:
    """Characters and tags below each node; foreign elements count for nothing."""
    in_link: list[bool] = []
    for node, parent in order:
        in_link.append(node.tag == "a" or parent >= 0 and in_link[parent])
        node.chars = sum(len(_BLANKS.sub("", item)) for item in node.items if isinstance(item, str))
        node.link_chars = node.chars * in_link[-1]
        node.tags = node.link_tags = 0
    for node, parent in reversed(order[1:]):
        above = order[parent][0]
        above.chars += node.chars
        above.tags += node.tags + 1
        above.link_chars += node.link_chars
        above.link_tags += node.link_tags + (node.tag == "a")


def _density(chars: int, tags: int, link_chars: int, link_tags: int, page_links: float) -> float:
    """Characters per tag, adjusted for links; ``page_links`` is the page's share of characters in links.

    One is added to the logarithm of the base, which a page without links would make zero.
    """
    if not chars:
        return 0.0
    base = math.log(chars / max(1, chars - link_chars) * link_chars + page_links * chars + math.e)
    inside = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
    return chars / max(1, tags) * math.log(max(inside, 1.0) + 1e-9) / (1.0 + math.log(base))


def _weigh(order: list[tuple[Node, int]], page_links: float) -> None:
    """Density, density sum and best sum of each node; ``own`` is the inline text in it.

    Inline elements belong to the text of the block around them, which is a child like
    the blocks in it.  Of equal sums the outer node's counts.
    """
    for node, _ in reversed(order):
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, page_links)
        own, node.sum = [0, 0, 0, 0], 0.0
        best, best_node = -1.0, node
        for item in node.items:
            if isinstance(item, str):
                n = len(_BLANKS.sub("", item))
                own[0] += n
                own[2] += n * (node.tag == "a")
            elif not item.foreign:
                if item.tag in INLINE:
                    inner = item.own
                    own = [own[0] + inner[0], own[1] + inner[1] + 1, own[2] + inner[2], own[3] + inner[3] + (item.tag == "a")]
                else:
                    node.sum += item.density
                if item.best > best:
                    best, best_node = item.best, item.best_node
        if node.tag in INLINE:
            node.best, node.best_node, node.own = best, best_node, own
            continue
        node.sum += _density(*own, page_links)
        node.best, node.best_node = (node.sum, node) if node.sum >= best and node.chars else (best, best_node)
        node.own = [0, 0, 0, 0]


def _weighed(top: Node) -> list[tuple[Node, int]]:
    order = _visible(top)
    _measure(order)
    _weigh(order, top.link_chars / top.chars if top.chars else 0.0)
    return order


def _unwrap(page: Node) -> list[tuple[Node, int]]:
    """The weighed nodes of a page.  Let marked elements that wrap the article be part of the page.

    Each marked element is weighed without the marked ones in it, innermost first, and
    held against what lies around it in the next marked element or the page.  Of several
    the one that holds the most counts, and those marked like it.  Where the page around
    has an article or main element with text, one outside of that is no wrapper.
    """
    regions, at, page_order = [page], 0, []
    found: list[tuple[list[tuple[Node, bool]], float, bool, int, bool]] = []
    while at < len(regions):
        top = regions[at]
        order = _weighed(top)
        page_order = page_order or order
        within: list[bool] = []
        marked, mains, articles, holds = [], False, 0, False
        for node, parent in order:
            outer = parent >= 0 and within[parent]
            within.append(outer or node.tag in ("article", "main"))
            if within[-1] and not outer:
                mains |= node.tag == "main"
                articles += node.tag == "article"
                holds |= node.chars > 0
            if node.marked:
                marked += [(item, within[-1]) for item in node.items if not isinstance(item, str) and item.mark]
        found.append((marked, max(top.best, top.sum), mains, articles, holds))
        regions += [item for item, _ in marked]
        at += 1
    worth = [f[1] for f in found]
    kinds = [(f[2], f[3]) for f in found]
    place = {id(node): i for i, node in enumerate(regions)}
    for i in range(len(regions) - 1, -1, -1):
        marked, around, mains, articles, holds = found[i]
        scores = []
        for item, inside in marked:
            j = place[id(item)]
            of_article = kinds[j][0] or kinds[j][1] == 1
            score = worth[j] / (WRAPS_ARTICLE if of_article else WRAPS)
            if score > around and (inside or not holds):
                scores.append((score, j))
        if not scores:
            continue
        best = regions[max(scores)[1]]
        for _, j in scores:
            if (regions[j].tag, regions[j].mark) == (best.tag, best.mark):
                regions[j].foreign = False
                worth[i] = max(worth[i], worth[j])
                mains, articles = mains or kinds[j][0], articles + kinds[j][1]
        kinds[i] = (mains, articles)
        if i == 0:
            return _weighed(page)
    return page_order


def _path_to(order: list[tuple[Node, int]], goal: Node) -> list[Node]:
    at = next(i for i, (node, _) in enumerate(order) if node is goal)
    path = []
    while at >= 0:
        path.append(order[at][0])
        at = order[at][1]
    return path[::-1]


def _select(node: Node, threshold: float, chosen: set[int]) -> None:
    todo = [node]
    while todo:
        node = todo.pop()
        if node.density >= threshold and node.chars:
            chosen.add(id(node.best_node))
            todo += [item for item in node.items if not isinstance(item, str) and not item.foreign]


def _blocks(node: Node, chosen: set[int]) -> list[list[str]]:
    blocks: list[list[str]] = [[]]
    path: list[tuple[Node, bool, Iterator]] = []

    def enter(node: Node, taken: bool) -> None:
        if node.tag not in INLINE and blocks[-1]:
            blocks.append([])
        path.append((node, taken or id(node) in chosen, iter(node.items)))

    enter(node, False)
    while path:
        node, taken, items = path[-1]
        for item in items:
            if isinstance(item, str):
                if taken:
                    blocks[-1].append(item)
            elif item.tag == "br":
                blocks[-1].append(" ")
            elif not item.foreign:
                enter(item, taken)
                break
        else:
            path.pop()
            if node.tag not in INLINE and blocks[-1]:
                blocks.append([])
    return blocks


def main_text(html: str | None) -> str:
    """Blocks of the article, joined by newlines; empty for a page without text."""
    if not html:
        return ""
    root = parse(html)
    body = _find(root, "body") or root
    order = _unwrap(body)
    if not body.chars:
        return ""
    path = _path_to(order, body.best_node)
    chosen: set[int] = set()
    marked = [n for n in path if n.tag in ("article", "main")]
    if marked:
        # The page itself says where the core's article begins and ends.
        chosen.add(id(marked[-1]))
    else:
        _select(body, min(n.density for n in path), chosen)
    lines = (_BLANKS.sub(" ", "".join(b)).strip() for b in _blocks(body, chosen))
    return "\n".join(x for x in lines if x)


def _find(node: Node, tag: str) -> Node | None:
    todo = [node]
    while todo:
        for item in reversed((node := todo.pop()).items):
            if not isinstance(item, str):
                todo.append(item)
        if todo and todo[-1].tag == tag:
            return todo[-1]
    return None


def extracted(html: Column) -> Column:
    """Main text of a whole page; null and empty pages give the empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text, na_action=None).astype(object)

    return run(html)


def page_texts(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """All columns of ``pages`` but the html, with ``text`` and its length ``n_chars``.

    Rows are independent: null ids and urls, repeated rows and an empty table need no
    care.  Columns of ``pages`` named like a result are replaced.
    """
    others = [c for c in pages.columns if c.lower() not in {html.lower(), text.lower(), "n_chars"}]
    return pages.select(*others, extracted(F.col(html)).alias(text)).withColumn(
        "n_chars", F.char_length(text).cast("long")
    )
