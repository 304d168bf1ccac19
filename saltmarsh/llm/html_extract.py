"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks: runs of text between block-level tags, in page order. A linear classifier gives each block a
score from its ancestors' tags and names, its length and the share of its text inside links. Names are read whole: one
speaks against content if all its words do, or the last one does ("post-comments"), and says nothing if it tells of a state
or a layout ("has-sidebar", "ad-free", "nav-open"). What an element holds outweighs its name: a container of the article,
or, on a page without one, of most of the running text, is no boilerplate whatever it is called. In a flow network, a block with a positive score is tied to the source by that capacity, one with a negative score to the sink; neighbours
in page order, and neighbours among the blocks of one parent element, are tied to each other by smoothness edges. The
minimum cut, found by max-flow, is the labelling with the least total of classifier costs and broken edges; the blocks
on the source side are the content.

Before the flow, blocks whose own capacity is at least the sum of their edges are labelled by it (such a label is in
some minimum cut) and their edges are added to their neighbours' capacities; few pages have anything left after that.

Pages are independent, so the operator is one narrow pass; a page's work is in proportion to its size but for the flow,
which runs on the undecided blocks only. Everything is parsed, unclosed and cut-off markup included.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, types
from pyspark.sql import functions as F

from . import tokens

# Names of HTML elements, and words in classes and ids.
BLOCK = frozenset(
    "address article aside blockquote body br button canvas caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li link main menu meta nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Scripts, styles, form controls, and what is no part of the page shown. What is between their tags is no markup.
SKIPPED = frozenset("script style template iframe title textarea select datalist xmp noembed noframes".split())
CLOSES_P = BLOCK - frozenset("br button option optgroup link meta title caption col colgroup tbody td tfoot th thead tr".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: End tags of these close nothing outside the article or body that they stand in.
INNER = frozenset("p div section li h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text and not parts of a page; their own names say little.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption caption".split())
BAD_TAGS = {"nav": 4.0, "footer": 4.0, "aside": 4.0, "form": 4.0, "header": 4.0, "menu": 4.0, "dialog": 4.0, "head": 9.0, "fieldset": 2.0, "button": 4.0}
GOOD_TAGS = {"article": 3.0, "main": 2.0}
#: Words that name boilerplate, and words that do so only in a name without others.
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox adsense breadcrumb breadcrumbs comment comments commentlist cookie cookies disqus footer gdpr login masthead modal nav navbar navigation navi newsletter overlay pager pagination pagenav popup sidebar signin signup skyscraper sponsor sponsored subscribe subscription tagcloud toolbar topbar".split()
)
WEAK_WORDS = frozenset(
    "banner consent copyright disclaimer discussion feedback header menu notice notification paging promo promoted promotion recommend recommended related replies reply respond response responses search share sharing side skip social tags trending widget widgets".split()
)
GOOD_WORDS = frozenset("article articlebody body content entry main maintext post posttext story text".split())
#: Words that add nothing to a name, and those that make it one of a state or a layout.
PLAIN_WORDS = frozenset(
    "area bar block bottom box button buttons center col column container footer form global group holder icons inner item items left links list main module outer page panel primary region right row secondary section site thread top wrap wrapper".split()
)
STATE_WORDS = frozenset("active collapsed closed disabled enabled expanded fixed free has hidden hide is layout no non not open opened off on required show sticky toggle toggled with without".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: The classifier's weights: of a name that speaks against content, of one that does so in part, of a role, of being hidden;
#: of links (outside articles and in them), length, and a block's place.
NAME, PART, ROLE, HIDDEN = 4.5, 1.0, 4.0, 9.0
LINKS, LINKS_INSIDE, LENGTH, BIAS, HEADING, PARAGRAPH, ITEM, BARE = 2.5, 1.0, 0.5, 0.7, 0.5, 0.5, 0.2, 0.4
#: The share of a page's running text that makes a container of it more than its name.
OWN_TEXT = 2 / 3
#: Smoothness: neighbours in page order under one parent, or whose parents are related; others; neighbours in a group; and
#: the part of it that goes between unlike blocks.
BROTHERS, NEAR, FAR, GROUP, CONTRAST = 0.7, 0.4, 0.15, 0.2, 0.8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


@dataclass(slots=True)
class Element:
    tag: str
    parent: Element | None
    attributes: str = ""
    bad: float = 0.0  # of this element and all above
    good: float = 0.0
    in_article: bool = False
    running: int = 0  # characters outside links, in this element
    headed: bool = False  # holds a first heading
    holds: bool = False  # holds the page's own article
    inside: bool = False  # stands in it


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    parent: Element
    heading: bool

    @property
    def density(self) -> float:
        return min(1.0, self.linked / len(self.text))


def _badness(words: list[str], textual: bool) -> float:
    """How much a name speaks against content."""
    if not STATE_WORDS.isdisjoint(words):
        return 0.0
    telling = [w for w in words if w not in PLAIN_WORDS] or words
    named = [w in BAD_WORDS or w in WEAK_WORDS for w in telling]
    if all(named):
        return NAME * (0.5 if textual else 1.0)
    if textual or not any(named):
        return 0.0
    return NAME if telling[-1] in BAD_WORDS else PART


@lru_cache(maxsize=1 << 14)
def _evidence(attributes: str, textual: bool) -> tuple[float, bool, str, bool, bool]:
    """(badness of the worst name in class and id, whether one is only "header", role, hidden, whether one names content) of a tag's attributes."""
    worst, header, role, hidden, good = 0.0, False, "", False, False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id"):
            for x in value.split():
                words = _WORD.findall(_CAMEL.sub(r"\1 \2", x).lower())
                if words == ["header"]:
                    header = True
                elif words:
                    worst = max(worst, _badness(words, textual))
                    good = good or not GOOD_WORDS.isdisjoint(words)
        elif name == "role":
            role = value.lower()
        elif name == "hidden":
            hidden = value.lower() != "until-found"
        elif name == "style":
            hidden = hidden or "display:none" in value.replace(" ", "").lower()
    return (worst, header, role, hidden, good)


def _judge(elements: list[Element], blocks: list[Block]) -> None:
    """Sets what is known of each element. Parents come before their children in ``elements``."""
    total = 0
    for b in blocks:
        own = len(b.text) - b.linked
        b.parent.running += max(own, 0)
        total += max(own, 0)
    for e in reversed(elements):
        if e.tag == "h1":
            e.headed = True
        if (up := e.parent) is not None:
            up.running += e.running
            up.headed = up.headed or e.headed
    # the page's own article is the first one with the first heading in it, or else the one with most text
    articles = [e for e in elements if e.tag in GOOD_TAGS and e.running]
    own = next((e for e in articles if e.headed), max(articles, key=lambda e: e.running, default=None))
    if own:
        own.inside, e = True, own
        while e:
            e.holds, e = True, e.parent
    root = elements[0]
    for e in elements[1:]:
        up = e.parent
        worst, header, role, hidden, good = _evidence(e.attributes, e.tag in TEXTUAL) if e.attributes else (0.0, False, "", False, False)
        e.in_article, e.inside = up.in_article or e.tag in GOOD_TAGS, up.inside or e.inside
        e.bad, e.good = up.bad, max(up.good, GOOD_TAGS.get(e.tag, 0.0))
        if header and not up.in_article:  # an article's own header is part of it
            worst = max(worst, NAME)
        if e.tag in ("body", "html", "article", "main"):
            worst = 0.0
        tag = BAD_TAGS.get(e.tag, 0.0) if not (e.tag == "header" and up.in_article) else 0.0
        if (worst or tag or role) and e.running:
            all_there_is = e.running >= OWN_TEXT * total and e.headed == root.headed and (own is None or e.inside)
            if e.holds or all_there_is:
                worst = 0.0
                if e.tag in ("form", "fieldset"):
                    tag = 0.0
                role = role if role in ("main", "article") else ""
        e.bad += tag + worst + (ROLE if role in BAD_ROLES else 0.0) + (HIDDEN if hidden else 0.0)
        if role in ("main", "article") or good:
            e.good = max(e.good, 1.5)


class _Open:
    """The open elements, outermost first, and where those of each name are, so that no end tag searches through them."""

    def __init__(self) -> None:
        self.stack = [Element("html", None)]
        self.elements = list(self.stack)
        self.places: dict[str, list[int]] = {}

    @property
    def here(self) -> Element:
        return self.stack[-1]

    def last(self, *tags: str) -> int:
        """The place of the innermost open element with one of these names; 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def push(self, tag: str, attributes: str) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Element(tag, self.here, attributes.strip(" /")))
        self.elements.append(self.here)

    def close(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order, in time proportional to the page."""
    open_, out, pieces, linked, in_link = _Open(), [], [], 0, 0
    heading = False
    unclosed: set[str] = set()  # skipped elements that have no end tag from here on

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                out.append(Block(text, linked, open_.here, heading))
        linked = 0

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            raw = page[at:stop]
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing = tag.lower(), bool(m[1] or m[4])
        if not m[0].endswith(">"):
            break  # the page ends inside a tag
        if closing:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in BLOCK:
                flush()
                place = open_.last(tag)
                if place > (open_.last("article", "body") if tag in INNER else 0):  # a stray end tag closes no article
                    open_.close(place)
                    in_link = 0
                heading = False
            continue
        attributes = (m[3] if m[2] else m[6]) or ""
        if tag in SKIPPED:
            if tag in BLOCK or tag == "title":
                flush()
            if not attributes.endswith("/") and tag not in unclosed:
                end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.IGNORECASE).search(page, at)
                if end:
                    at = end.end()
                else:
                    unclosed.add(tag)
                    # what is never closed: scripts and styles take the rest of the page, others are ignored
                    at = n if tag in ("script", "style", "title", "textarea") else at
            continue
        if tag == "a":
            in_link += 1
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:
                place = len(open_.stack)
                while open_.stack[place - 1].tag == "p":
                    place -= 1
                open_.close(place)
            if tag in SAME and (place := open_.last(tag)) > open_.last(*SAME[tag]):
                open_.close(place)
            if tag not in VOID:
                open_.push(tag, attributes)
                heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
    flush()
    _judge(open_.elements, out)
    return out


def score(block: Block) -> float:
    """The classifier: positive for content."""
    size = len(block.text)
    out = block.parent.good - block.parent.bad - (LINKS_INSIDE if block.parent.in_article else LINKS) * block.density + LENGTH * min(6.0, (size / 40) ** 0.5) - BIAS
    if block.heading:
        out += HEADING
    if block.parent.tag in ("p", "pre", "blockquote"):
        out += PARAGRAPH
    elif block.parent.tag in ("li", "td", "th", "dd", "dt"):
        out -= ITEM
    elif block.parent.tag in ("html", "body"):
        out -= BARE
    return out


def edges(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness: page order, stronger under one parent; neighbours among the blocks of one grandparent; less between unlike blocks."""
    out: dict[tuple[int, int], float] = {}
    for i in range(len(blocks) - 1):
        a, b = blocks[i].parent, blocks[i + 1].parent
        related = a.parent is b.parent or a.parent is b or b.parent is a
        out[i, i + 1] = BROTHERS if a is b or a.parent is b.parent and a.tag == b.tag else NEAR if related else FAR
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        above = id(b.parent.parent or b.parent)
        if above in last:
            pair = (last[above], i)
            out[pair] = out.get(pair, 0.0) + GROUP
        last[above] = i
    density = [b.density for b in blocks]
    bad = [b.parent.bad for b in blocks]
    # unlike blocks, of which one is all links or whose elements differ in badness, are less tied
    return {(a, b): w * (1 - CONTRAST * max(abs(density[a] - density[b]), min(1.0, abs(bad[a] - bad[b]) / 2))) for (a, b), w in out.items()}


def minimum_cut(capacity: list[float], edge: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes are on the source side. capacity: to the source if positive, to the sink if negative."""
    n = len(capacity)
    if not n:
        return []
    weight = [0.0] * n
    for (a, b), w in edge.items():
        weight[a] += w
        weight[b] += w
    if all(abs(c) >= w for c, w in zip(capacity, weight)):
        return [c > 0 for c in capacity]
    own = list(capacity)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), w in edge.items():
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        v = queue.popleft()
        if label[v] is None and abs(own[v]) >= weight[v]:
            label[v] = own[v] > 0
            for u, w in near[v].items():
                if label[u] is None:
                    own[u] += w if label[v] else -w
                    weight[u] -= w
                    del near[u][v]
                    queue.append(u)
    rest = [v for v in range(n) if label[v] is None]
    if rest:
        for v, side in zip(rest, _flow(rest, own, near)):
            label[v] = side
    return [bool(x) for x in label]


def _flow(nodes: list[int], own: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Max-flow by shortest augmenting paths; the nodes still reachable from the source."""
    left: dict[int, dict[int, float]] = {v: dict(near[v]) for v in nodes}
    source, sink = -1, -2
    left[source], left[sink] = {}, {}
    for v in nodes:
        if own[v] > 0:
            left[source][v] = own[v]
            left[v][source] = 0.0
        elif own[v] < 0:
            left[v][sink] = -own[v]
            left[sink][v] = 0.0
    while True:
        before = {source: source}
        queue = deque([source])
        while queue and sink not in before:
            v = queue.popleft()
            for u, c in left[v].items():
                if c > 1e-12 and u not in before:
                    before[u] = v
                    queue.append(u)
        if sink not in before:
            return [v in before for v in nodes]
        path, v = [], sink
        while v != source:
            path.append((before[v], v))
            v = before[v]
        pushed = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= pushed
            left[b][a] = left[b].get(a, 0.0) + pushed


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    content = minimum_cut([score(b) for b in blocks], edges(blocks))
    return " ".join(b.text for b, kept in zip(blocks, content) if kept)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with _text (string; empty if there is no content) in place of ``column``.

    Null counts as an empty page. Repeated rows get equal results; other columns pass through, but for one named _text.
    """
    pages = pages.drop("_text")
    kept = [f for f in pages.schema.fields if f.name != column]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = tokens.column_of(batch, column)
            for a in range(0, batch.num_rows, 256):  # so that few texts are held at once
                part = batch.slice(a, 256)
                texts = pa.array([main_text(x.as_py()) for x in sources.slice(a, 256)], pa.string())
                yield pa.RecordBatch.from_arrays([*(tokens.column_of(part, c) for c in names), texts], names=[*names, "_text"])

    return pages.mapInArrow(run, types.StructType([*kept, types.StructField("_text", types.StringType())]))


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))
