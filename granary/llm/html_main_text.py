"""The main text of web pages by scoring the tree of elements.

Each paragraph passes points (for being there, for its length, for its commas) to its nearest ancestors, less the further up; a container's
points are discounted by the share of its text that lies in links. The best container and those of its siblings that score well are kept.
Parts that are no article by their element, role or name (menus, headers, footers, sidebars, notices, adverts, forms, comments) are
left out of the tree before anything is scored. A page is one row's work, nothing is shuffled.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never text of an article.
GONE = frozenset("head title script style noscript template svg math iframe object embed applet canvas audio video map nav footer aside dialog menu search select option textarea button input datalist output progress meter".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split())
#: Words of class and id that mark parts beside the article, whatever else the name says.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promotion promoted comment comments commentlist disqus respond replies sidebar nav navbar navigation menu breadcrumb breadcrumbs cookie cookies consent gdpr newsletter subscribe subscription signup login popup modal overlay share sharing social related recommended recommendations outbrain taboola footer masthead pagination pager paywall".split()
)
#: Words that do so unless the name also has one of ARTICLE.
PERHAPS = frozenset("header banner notice notices alert widget widgets toolbar tags skip hidden discussion aside teaser copyright".split())
ARTICLE = frozenset("article content main body entry post story text page hentry".split())
#: What a start tag of a group ends, up to the nearest element of its scope.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Ancestors that a paragraph passes points to.
LEVELS = 5


class Node:
    __slots__ = ("tag", "parent", "inside", "names", "gone", "points", "chars", "linked", "links")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str] = frozenset(), gone: bool = False):
        self.tag, self.parent, self.names, self.gone = tag, parent, names, gone
        self.inside: list[Node | str] = []
        self.points, self.chars, self.linked, self.links = 0.0, 0, 0, 0


def _names(attrs: dict[str, str | None]) -> frozenset[str]:
    """The words of class and id; humps and separators part them."""
    name = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
    return frozenset(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())) if name != " " else frozenset()


class Tree(HTMLParser):
    """Elements and texts of a page; missing end tags are implied, superfluous ones passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.depth: dict[str, int] = {}

    def _close(self, node: Node) -> None:
        while True:
            closed, self.at = self.at, self.at.parent
            self.depth[closed.tag] -= 1
            if closed is node:
                return

    def _open(self, tags: set[str], scope: set[str]) -> Node | None:
        """The nearest open element of these, not beyond an element of the scope."""
        if not any(self.depth.get(t) for t in tags):
            return None
        node = self.at
        while node is not self.root and node.tag not in scope:
            if node.tag in tags:
                return node
            node = node.parent
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag in BLOCK and (p := self._open({"p"}, {"td", "th", "table", "button", "object"})):
            self._close(p)
        if tag in ENDS:
            while node := self._open(*ENDS[tag]):
                self._close(node)
        if tag == "body" and (head := self._open({"head"}, set())):
            self._close(head)
        given = dict(attrs)
        gone = tag in GONE or "hidden" in given or given.get("aria-hidden") == "true" or (given.get("role") or "").lower() in ROLES or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style") or "") is not None
        node = Node(tag, self.at, _names(given), gone)
        self.at.inside.append(node)
        if tag not in VOID:
            self.at = node
            self.depth[tag] = self.depth.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.at.inside.append(Node("br", self.at))
        # an inline element does not end what lies around it
        elif node := self._open({tag}, set() if tag in BLOCK else BLOCK - {tag}):
            self._close(node)

    def handle_data(self, data: str) -> None:
        self.at.inside.append(data)


def _pruned(root: Node) -> None:
    """Marks as gone what its name, or its place, shows to lie beside the article; a part that holds the page's headline or article stays."""
    order = _ordered(root)
    holds: dict[int, bool] = {}
    paragraphs: dict[int, int] = {}
    for n in reversed(order):
        own = not n.gone and (n.tag in ("h1", "main") or n.tag == "article" and not n.names & BESIDE)
        below = [c for c in n.inside if isinstance(c, Node) and not c.gone]
        holds[id(n)] = own or any(holds[id(c)] for c in below)
        paragraphs[id(n)] = (n.tag == "p") + sum(paragraphs[id(c)] for c in below)
    article: set[int] = set()
    for n in order:
        if n.tag == "article" or n.parent is not None and id(n.parent) in article:
            article.add(id(n))
        within = id(n) in article
        if n.tag in ("html", "body", "main") or n.gone:
            continue
        if n.tag == "header":
            n.gone = not within
        elif n.tag in ("form", "fieldset"):
            # some pages are one form
            n.gone = not holds[id(n)] and paragraphs[id(n)] < 3
        elif n.names & BESIDE or n.names & PERHAPS and not n.names & ARTICLE:
            n.gone = n.tag not in HEADINGS and not (holds[id(n)] and not n.names & {"comment", "comments", "commentlist", "disqus"})


def _ordered(root: Node) -> list[Node]:
    """All elements, each before those inside it; a loop, because pages may be nested deeply."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [c for c in reversed(n.inside) if isinstance(c, Node)]
    return out


def _scored(root: Node) -> list[Node]:
    """Sizes and points of what is left; the containers that got points, in page order."""
    order, live, todo = [], [], [(root, False)]
    while todo:
        n, linked = todo.pop()
        order.append(n)
        linked = linked or n.tag == "a"
        n.links = int(n.tag == "a")
        for c in n.inside:
            if isinstance(c, str):
                size = len("".join(c.split()))
                n.chars += size
                n.linked += size if linked else 0
        todo += [(c, linked) for c in reversed(n.inside) if isinstance(c, Node) and not c.gone]
    blocks: dict[int, bool] = {}
    for n in reversed(order):
        below = [c for c in n.inside if isinstance(c, Node) and not c.gone]
        blocks[id(n)] = any(c.tag in BLOCK or blocks[id(c)] for c in below)
        for c in below:
            n.chars, n.linked, n.links = n.chars + c.chars, n.linked + c.linked, n.links + c.links
    for n in order:
        if n.tag in BLOCK and not blocks[id(n)] and n.tag not in HEADINGS and n.chars and n.parent is not None:
            text = _inline(n)
            points = (1 + text.count(",") + text.count("，") + text.count("、") + min(3, len(text) // 100)) * (1 - n.linked / n.chars)
            up, level = n.parent, 0
            while up is not None and level < LEVELS:
                up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                up, level = up.parent, level + 1
    for n in order:
        if n.points and n.chars:
            hint = 25 * bool(n.names & ARTICLE) if n.tag not in ("html", "body") else 0
            n.points = (n.points + hint + (25 if n.tag in ("article", "main") else 0)) * (1 - n.linked / n.chars)
            live.append(n)
    return live


def _inline(n: Node) -> str:
    out, todo = [], [n]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.gone:
            out += [" "] if x.tag == "br" else []
            todo += reversed(x.inside)
    return " ".join("".join(out).split())


def _menu(n: Node) -> bool:
    """A list or block of links and nothing else."""
    return n.tag in ("ul", "ol", "dl", "div", "section", "table") and n.links >= 3 and n.linked >= 0.9 * n.chars


def _blocks(n: Node) -> list[str]:
    """The texts of the blocks of an element in page order; two line breaks part blocks, one is white space."""
    out: list[str] = []
    now: list[str] = []
    breaks = 0

    def ended() -> None:
        if line := " ".join("".join(now).split()):
            out.append(line)
        now.clear()

    todo: list[Node | str | None] = [n]
    while todo:
        x = todo.pop()
        if x is None:
            ended()
        elif isinstance(x, str):
            now.append(x)
            breaks = 0 if x.strip() else breaks
        elif x.tag == "br":
            breaks += 1
            now.append(" ")
            if breaks == 2:
                ended()
        elif not x.gone and (x is n or not _menu(x)):
            breaks = 0
            if x.tag in BLOCK:
                ended()
                todo.append(None)
            todo += reversed(x.inside)
    ended()
    return out


def _chosen(root: Node, live: list[Node]) -> list[Node]:
    """The best container, or the article around it, with the siblings that belong to it."""
    best = max(live, key=lambda n: n.points)  # the first of equal ones
    up = best
    while up is not None:
        if up.tag == "article":
            best = up
        up = up.parent
    if best.parent is None or best.tag in ("article", "body"):
        return [best]
    limit = max(10.0, 0.2 * best.points)
    out = []
    for c in best.parent.inside:
        if isinstance(c, str) or c.gone:
            continue
        density = c.linked / c.chars if c.chars else 1.0
        alike = 0.2 * best.points if c.names and c.names == best.names else 0.0
        long = c.tag == "p" and density < 0.25 and (c.chars > 80 or density == 0)
        if c is best or c.points + alike >= limit or long or c.tag in ("h1", "h2") and density < 0.5:
            out.append(c)
    return out


def main_text(html: str | None) -> str:
    """The blocks of a page's article, a line each."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    _pruned(tree.root)
    live = _scored(tree.root)
    parts = _chosen(tree.root, live) if live else [tree.root]
    return "\n".join(line for n in parts for line in _blocks(n))


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with text (never null) and n_chars (long, its code points) in the place of columns of these names; the others stay.

    Character references are decoded; white space (as str.split sees it) inside a block becomes one blank. Null, empty and blank pages, and
    pages that have nothing beside menus and the like, have the empty text; a page without any element is one block. Very long and deeply
    nested pages are read whole, cut-off ones as far as they go. Repeated rows give repeated rows, an empty table an empty one.
    """

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return pages.withColumn("text", run(F.col(f"`{html}`").cast("string"))).withColumn("n_chars", F.length("text").cast("long"))
