"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to the elements around them, the
points shrink with the share of link text, and the best container is kept together with
those of its siblings that score well. Elements that hold no article by their name, role
or class (menus, footers, adverts, forms, comments and so on) never enter the tree.

A page is one row and never meets another, so the work is a narrow map over batches.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tripartite.llm.common import append, map_batches, packed, read, text_column, text_of

# Elements without an end tag, with raw text, and with no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math object textarea title".split())
NO_TEXT = RAW | frozenset(
    "head nav footer aside form button select dialog menu canvas audio video map label fieldset".split()
)
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table"
    " thead tbody tfoot tr td th caption figure figcaption address header hgroup center details"
    " summary hr".split()
)
# An opening tag of the first kind ends an open element of the second, up to the third.
ENDS_P = BLOCK - frozenset("html body td th tr".split())
ENDS_LIKE = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
}
NO_ARTICLE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split()
)
NO_ARTICLE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc sidebar aside rail widget"
    " footer masthead topbar toolbar header siteheader comment comments commentlist respond reply replies"
    " disqus discussion share sharing social related recommended recommendations newsletter subscribe"
    " subscription signup login popup modal overlay cookie cookies consent gdpr notice notices alert"
    " disclaimer skip hidden print copyright".split()
)
# Names that take an element out inside articles too: where a class or id begins with one,
# and, unless the element has a third of the points, where one is a part of it.
ASIDE_NAMES = frozenset(
    "comment comments commentlist disqus respond replies share sharing social cookie cookies consent gdpr".split()
)
BASE = {"article": 30.0, "main": 20.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0,
        "ul": -3.0, "ol": -3.0, "dl": -3.0, "address": -3.0, "header": -5.0}
NAME_MALUS = 5.0  # points that a name of no article, in part or as id, costs an element
SCORED = frozenset("p pre td blockquote li dd figcaption div section article main body center".split())
LEVELS = 32  # ancestors that a paragraph's points reach
KEEP_ANYWAY = frozenset("html body main article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)(?=[\s/])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(?P<raw>" + "|".join(sorted(RAW)) + r")(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/<>]*+)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>"
    r"|<[a-z][^<>]*>?",
    re.S | re.I,
)
# Behind the last ">" no tag ends: what looks like one there is left out up to the next.
_UNENDED = re.compile(r"<!--.*|<[a-z!?/][^<]*", re.S | re.I)
_ATTR = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME_PARTS = re.compile(r"[^a-z0-9]+")


# No article by tag or role; by how a name begins; by a part of a name; by a class; neither.
NOT, ASIDE, PARTLY, NAMED, KEPT = 4, 3, 2, 1, 0


def _no_article(tag: str, attrs: str, inside_article: bool) -> tuple[int, bool]:
    """Whether an element holds no article, and whether its names cost points."""
    if tag in NO_TEXT or (tag == "header" and not inside_article):
        return NOT, False
    if not attrs or "=" not in attrs and "hidden" not in attrs or tag in KEEP_ANYWAY - {"article"}:
        return KEPT, False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    if found.get("role", "").lower() in NO_ARTICLE_ROLES or found.get("aria-hidden") == "true":
        return NOT, False
    if _HIDDEN.search(found.get("style", "")) or re.search(r"(?:^|\s)hidden(?:\s|$)", _ATTR.sub("", attrs)):
        return NOT, False
    classes = found.get("class", "").lower()
    names = f"{classes} {found.get('id', '').lower()}".split()
    parts = [part for name in names for part in _NAME_PARTS.split(name)]
    less = not NO_ARTICLE_NAMES.isdisjoint(parts)
    if tag == "article":  # may say of itself that it has comments; a comment has that name whole
        begins, holds = classes.split(), []
    else:
        begins, holds = [_NAME_PARTS.split(name)[0] for name in names], parts
    if not ASIDE_NAMES.isdisjoint(begins):
        return ASIDE, less
    if not ASIDE_NAMES.isdisjoint(holds):
        return PARTLY, less
    return KEPT if NO_ARTICLE_NAMES.isdisjoint(classes.split()) else NAMED, less


TAKEN = (NAMED, PARTLY, ASIDE)


class _Node:
    """An element; what its ancestors say about it is kept with it, so nobody walks up."""

    __slots__ = (
        "tag", "parent", "at", "depth", "holder", "in_article", "in_link", "score", "chars", "links", "dropped",
        "kind", "malus", "holds", "heads", "points", "nearest",
    )

    def __init__(self, tag: str, parent: _Node | None, at: int, dropped: bool, kind: int = KEPT, malus: float = 0.0):
        self.tag, self.parent, self.at, self.dropped, self.kind, self.malus = tag, parent, at, dropped, kind, malus
        self.score, self.chars, self.links, self.points = 0.0, 0, 0, 0.0
        self.holds = self.heads = False
        self.nearest: _Node | None = None
        self.depth = parent.depth + 1 if parent else 0
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        self.in_link = tag == "a" or (parent is not None and parent.in_link)
        # The element that text inside belongs to.
        self.holder: _Node = self if parent is None or kind in TAKEN or tag in BLOCK else parent.holder


def _ended(token: re.Match) -> bool:
    """Whether a comment or raw text has come to its own end."""
    if token["raw"]:
        return re.search(rf"</{token['raw']}\s*>\Z", token[0], re.I) is not None
    return not token[0].startswith("<!--") or token[0].endswith("-->")


class _Page:
    """One pass over the markup: a stack of open elements and the blocks of text seen."""

    def __init__(self) -> None:
        self.root = _Node("#root", None, 0, False)
        self.stack = [self.root]
        self.nodes = [self.root]  # parents before their children
        self.open: Counter[str] = Counter()
        self.blocks: list[tuple[_Node, str]] = []
        self.linked_chars: list[int] = []
        self.named: list[_Node] = []  # outer ones first
        self.text: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        """End the block that is open."""
        if self.text:
            block = " ".join("".join(self.text).split())
            if block:
                self.blocks.append((self.stack[-1].holder, block))
                self.linked_chars.append(min(self.linked, len(block)))
        self.text, self.linked = [], 0

    def pop_to(self, depth: int) -> None:
        if any(n.tag in BLOCK or n.dropped or n.kind != KEPT for n in self.stack[depth:]):
            self.flush()
        self.open.subtract(n.tag for n in self.stack[depth:])
        del self.stack[depth:]

    def close(self, tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth].tag
            if tag in tags:
                self.pop_to(depth)
                return
            if tag in until:
                return

    def start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        if tag in BLOCK:
            if tag in ENDS_P:
                self.close({"p"}, {"td", "th", "table", "button"})
            if tag in ENDS_LIKE:
                self.close(*ENDS_LIKE[tag])
        top = self.stack[-1]
        dropped, kind, less = top.dropped, KEPT, False
        if not dropped:
            kind, less = _no_article(tag, attrs, top.in_article)
            dropped = kind == NOT
        if tag in BLOCK or kind in TAKEN or (dropped and not top.dropped):
            self.flush()
        if tag in VOID or attrs.endswith("/"):
            return
        node = _Node(tag, top, len(self.blocks), dropped, kind, NAME_MALUS if less else 0.0)
        if not dropped:
            if tag in ("article", "main") and kind != ASIDE:
                self.mark("holds")
            elif tag == "h1":
                self.mark("heads")
        self.stack.append(node)
        self.nodes.append(node)
        self.open[tag] += 1
        if kind in TAKEN:
            self.named.append(node)

    def mark(self, flag: str) -> None:
        """Tell the open elements what they hold; the ancestors of one that knows know it."""
        for node in reversed(self.stack):
            if getattr(node, flag):
                return
            setattr(node, flag, True)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.text.append(" ")
        if not self.open[tag]:
            return
        inline = tag not in BLOCK and tag not in NO_TEXT
        for depth in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[depth].tag
            if open_tag == tag:
                self.pop_to(depth)
                return
            if inline and open_tag in BLOCK:
                return

    def words(self, text: str) -> None:
        if text and not self.stack[-1].dropped:
            text = html.unescape(text) if "&" in text else text
            self.text.append(text)
            if self.stack[-1].in_link:
                self.linked += len(text.strip())

    def read(self, page: str) -> None:
        at, upto, token = 0, page.rfind(">") + 1, None
        for token in _TOKEN.finditer(page, 0, upto):
            self.words(page[at : token.start()])
            at = token.end()
            tag = token["tag"]
            if tag and token["end"]:
                self.end(tag.lower())
            elif tag:
                self.start(tag.lower(), token["attrs"])
        self.words(page[at:upto])
        if token is None or token.end() < upto or _ended(token):
            self.words(_UNENDED.sub("", page[upto:]))
        self.flush()
        self.settle()

    def settle(self) -> None:
        """Take out the elements that their names name, and add up the text of the others."""
        total = 0.0
        for holder, block in self.blocks if self.named else ():
            holder.points += _points(block)
            total += _points(block)
        for node in reversed(self.nodes if self.named else []):
            if node.parent is not None:
                node.parent.points += node.points
        for node in self.named:
            most = {NAMED: 0.5, PARTLY: 1 / 3, ASIDE: 0.9}[node.kind] * total
            spared = node.holds or (node.heads and node.kind != NAMED)
            node.dropped = not spared and node.points <= most
        for node in self.nodes:
            node.dropped = node.dropped or (node.parent is not None and node.parent.dropped)
        left = []
        for (holder, block), links in zip(self.blocks, self.linked_chars, strict=True):
            if not holder.dropped:
                left.append((holder, block))
                holder.chars += len(block)
                holder.links += links
        for node in reversed(self.nodes):
            if node.parent is not None:
                node.parent.chars += node.chars
                node.parent.links += node.links
        self.blocks = left


def _points(block: str) -> float:
    return 1.0 + block.count(",") + block.count("،") + block.count("、") + min(len(block) / 100.0, 3.0)


def _score(page: _Page) -> dict[int, _Node]:
    """Points of every paragraph to its ancestors, less with each step away."""
    candidates: dict[int, _Node] = {}
    for holder, block in page.blocks:
        points = _points(block)
        paragraph = holder.tag in ("p", "pre", "td", "li", "dd", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6")
        node, share, level = (holder.parent if paragraph else holder), 1.0, 0
        if holder.tag not in SCORED:
            points *= 0.25
        while node is not None and node is not page.root and level < LEVELS:
            node.score += points * share
            candidates[id(node)] = node
            level += 1
            share = 0.5 if level == 1 else 1.0 / (3 * level)
            node = node.parent
    return candidates


def _final(node: _Node) -> float:
    density = node.links / node.chars if node.chars else 0.0
    return (node.score + BASE.get(node.tag, 0.0) - node.malus) * (1.0 - density)


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by an empty line; empty if there is none.

    Null and text without markup are read as a page as well: the latter is one block.
    """
    tree = _Page()
    tree.read(page or "")
    if not tree.blocks:
        return ""
    candidates = _score(tree)
    if not candidates:
        return "\n\n".join(block for _, block in tree.blocks)
    # Ties go to the element that begins first, then to the inner one.
    best = max(candidates.values(), key=lambda n: (_final(n), -n.at, n.depth))
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            best = node
        node = node.parent
    kept = {id(best)}
    if best.tag not in ("article", "main", "body", "html"):
        least = max(5.0, 0.2 * _final(best))
        for other in candidates.values():
            if other.parent is best.parent and _final(other) >= least:
                kept.add(id(other))
        for holder, block in tree.blocks:
            density = holder.links / holder.chars if holder.chars else 1.0
            if holder.parent is best.parent and holder.tag == "p" and len(block) > 80 and density < 0.25:
                kept.add(id(holder))
            elif holder.parent is best.parent and holder.tag in ("h1", "h2") and density == 0:
                kept.add(id(holder))
    for node in tree.nodes:
        node.nearest = node if id(node) in kept else node.parent and node.parent.nearest
    out = []
    for holder, block in tree.blocks:
        node = holder.nearest
        # The container's own lists stay, unless it is the whole page.
        inside = node is best and best.tag not in ("body", "html")
        if node is not None and (inside or not (holder.tag in ("ul", "ol", "li") and _mostly_links(holder))):
            out.append(block)
    return "\n\n".join(out)


def _mostly_links(item: _Node) -> bool:
    """Whether the whole list that an item belongs to is links, as a menu without a name is."""
    group = item.parent if item.tag == "li" and item.parent is not None else item
    return group.chars > 0 and group.links >= 0.9 * group.chars and group.tag in ("ul", "ol", "li")


def extract(pages: DataFrame, markup: str = "html") -> DataFrame:
    """Each row as a struct ``row`` with ``text`` and ``n_chars`` (code points).

    Null markup counts as empty; an empty table gives an empty one; repeated rows are
    read each for itself, and columns of any name may be there.
    """
    whole = packed(pages, text_of(markup).alias("markup"))
    schema = StructType([whole.schema["row"], StructField("text", StringType()), StructField("n_chars", LongType())])

    def each():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(page) for page in text_column(batch, "markup")]
            return append(
                batch, ["row"], text=pa.array(texts, pa.string()), n_chars=pa.array(map(len, texts), pa.int64())
            )

        return work

    return map_batches(whole, each, schema)


def op9_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    pages = read(spark, root, "pages").select("page_id", "url", F.col("html"))
    return extract(pages).select("row.page_id", "row.url", "text", "n_chars")
