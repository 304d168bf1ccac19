"""Pages as trees: a row for each element and each text, so that a scrape is a query.

``nodes`` parses pages in Arrow batches, a page at a time, in one narrow pass. A node has its number in page order and that of its last
descendant, so "inside" is an interval, "the next one" is a minimum, and a text is put together from the text nodes in an
interval. (Arrow table functions take no part in lateral joins in this Spark, hence a pass over batches.)
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, types
from pyspark.sql import functions as F

from .tags import fed

# Elements without content, and those that a start tag closes up to an element that bounds them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select", "datalist")),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "thead": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)), "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
}
#: Start tags that end an open paragraph.
BLOCKS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: An end tag reaches no farther out than these.
BOUNDS = frozenset("table td th caption body html".split())
TEXT = "#text"
_ATTRIBUTES = pa.map_(pa.string(), pa.string())
_FIELDS = [("node", pa.int32()), ("parent", pa.int32()), ("last", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("attributes", _ATTRIBUTES), ("text", pa.string())]
_INT, _STRING = types.IntegerType(), types.StringType()
_SPARK = types.StructType([types.StructField(n, types.MapType(_STRING, _STRING) if t == _ATTRIBUTES else _STRING if t == pa.string() else _INT) for n, t in _FIELDS])


class _Tree(HTMLParser):
    """Nodes in page order. ``open`` holds the open elements' numbers, and ``places`` where those of a name stand in it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.last, self.depth, self.tags, self.attributes, self.texts = [], [], [], [], [], []
        self.running = False  # the last node is a text that goes on
        self.open: list[int] = []
        self.places: dict[str, list[int]] = {}

    def _add(self, tag: str, attributes: list | None, text: list[str] | None) -> int:
        node = len(self.tags)
        self.parent.append(self.open[-1] if self.open else None)
        self.depth.append(len(self.open))
        self.last.append(node)
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.texts.append(text)
        return node

    def _innermost(self, tags) -> int:
        found = -1
        for t in tags:
            if (p := self.places.get(t)) and p[-1] > found:
                found = p[-1]
        return found

    def _close(self, place: int) -> None:
        """Closes the open elements from this place on."""
        end = len(self.tags) - 1
        for node in self.open[place:]:
            self.last[node] = end
            self.places[self.tags[node]].pop()
        del self.open[place:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.running = False
        if tag in CLOSES:
            closed, bounds = CLOSES[tag]
            bound = self._innermost(bounds)
            inside = [p[k] for t in closed if (p := self.places.get(t)) and (k := bisect_right(p, bound)) < len(p)]
            if inside:
                self._close(min(inside))
        if self.places.get("p") and tag in BLOCKS and (place := self.places["p"][-1]) > self._innermost(("table", "td", "th", "li", "button")):
            self._close(place)
        first: dict[str, str | None] = {}
        for name, value in attrs:
            first.setdefault(name, value)  # of repeated attributes the first counts
        node = self._add(tag, list(first.items()), None)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        self.running = False
        open_ = self.places.get(tag)
        place = open_[-1] if open_ else -1
        if place >= 0 and (tag in BOUNDS or place > self._innermost(BOUNDS)):
            self._close(place)

    def handle_data(self, data: str) -> None:
        if self.running:
            self.texts[-1].append(data)
        else:
            self._add(TEXT, None, [data])
            self.running = True

    def handle_comment(self, data: str) -> None:
        self.running = False

    handle_decl = handle_pi = unknown_decl = handle_comment

    def finished(self) -> _Tree:
        self._close(0)
        self.texts = [t and "".join(t) for t in self.texts]
        return self


def _parsed(page: str | None) -> _Tree:
    tree = _Tree()
    fed(tree, page or "", close=True)
    return tree.finished()


def nodes(pages: DataFrame, column: str = "html") -> DataFrame:
    """The other columns of ``pages``, and node, parent, last, depth, tag, attributes, text: a row for each node of each page.

    Nodes are numbered from 0 in page order; ``last`` is the last node inside; ``parent`` is null at the top. Texts are
    nodes with the tag ``#text``; only they have a text, with character references decoded and white space as it is;
    a text with a comment or a stray end tag in it is several nodes. Names are in lower case; an attribute without a value has a null one. Unclosed list
    items, cells, options and paragraphs end where the next one begins, all others where an element around them ends; end
    tags that close nothing are left out. Comments and declarations are no nodes. Null and empty pages have none.
    """
    taken = {f.name for f in _SPARK.fields}
    kept = [f for f in pages.schema.fields if f.name != column]
    if clash := taken & {f.name for f in kept}:
        raise ValueError(f"rename the columns {sorted(clash)}, which nodes have as well")
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(batch.schema.get_field_index(column))
            for k in range(batch.num_rows):
                tree = _parsed(sources[k].as_py())
                if not tree.tags:
                    continue
                n = len(tree.tags)
                own = pa.array([k] * n)
                values = [range(n), tree.parent, tree.last, tree.depth, tree.tags, tree.attributes, tree.texts]
                arrays = [batch.column(batch.schema.get_field_index(c)).take(own) for c in names]
                yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(v, t) for v, (_, t) in zip(values, _FIELDS))], names=[*names, *(c for c, _ in _FIELDS)])

    return pages.mapInArrow(run, types.StructType([*kept, *_SPARK.fields]))


def texts_of(wanted: DataFrame, all_nodes: DataFrame, keys: list[str], separator: str = "", name: str = "text") -> DataFrame:
    """``wanted`` (nodes: keys, node, last and others) with the text inside each: its text nodes, each stripped of white
    space, the empty ones left out, joined by ``separator``.
    """
    texts = all_nodes.where(F.col("tag") == TEXT).select(*keys, F.col("node").alias("_t"), _stripped(F.col("text")).alias("_s")).where("_s <> ''")
    inside = wanted.select(*keys, "node", "last").distinct().join(texts, keys).where(F.col("_t").between(F.col("node"), F.col("last")))
    joined = inside.groupBy(*keys, "node").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_t", "_s"))), lambda x: x["_s"]), separator).alias(name))
    return wanted.join(joined, [*keys, "node"], "left").withColumn(name, F.coalesce(name, F.lit("")))


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def items_after_headers(pages: DataFrame, keys: list[str], headers: list[str], column: str = "html", tags: tuple[str, ...] = ("strong", "h3")) -> DataFrame:
    """(keys, header, item, name, details, link): the items of the first ``ul`` behind each of these headings.

    A heading is an element named in ``tags`` whose whole text is one of ``headers``; its list is the next one in page order,
    wherever it stands; all items inside count, those of nested lists as well. ``name`` and ``link`` are those of an item's
    first link ('' without one), ``details`` is its text, parts joined by spaces, without the name's first occurrence. Items
    are numbered from 1 under each heading; a heading that occurs again adds its items. Keys must tell pages apart.
    """
    given = pages.select(*keys, column)
    own = [f for f in given.schema.fields if f.name != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, found = [], []
            for k, page in enumerate(batch.column(column)):
                items = _items(_parsed(page.as_py()), headers, tags)
                place += [k] * len(items)
                found += items
            at = pa.array(place, pa.int64())
            columns = [pa.array([i[n] for i in found], t) for n, (_, t) in enumerate(_ITEM)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name).take(at) for f in own), *columns], names=[*(f.name for f in own), *(n for n, _ in _ITEM)])

    fields = [types.StructField(n, _INT if t == pa.int32() else _STRING) for n, t in _ITEM]
    return given.mapInArrow(run, types.StructType([*own, *fields])).dropna(subset=keys)


_ITEM = [("header", pa.string()), ("item", pa.int32()), ("name", pa.string()), ("details", pa.string()), ("link", pa.string())]
#: White space as Unicode has it.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _items(tree: _Tree, headers: list[str], tags: tuple[str, ...]) -> list[tuple]:
    """(header, item, name, details, link) of one page's items."""
    names, last = tree.tags, tree.last
    texts = [(n, s) for n, t in enumerate(tree.texts) if t and (s := t.strip(_WHITE))]
    at = [n for n, _ in texts]
    text = lambda n, separator: separator.join(s for _, s in texts[bisect_right(at, n - 1) : bisect_right(at, last[n])])
    lists, lis, links = ([n for n, t in enumerate(names) if t == tag] for tag in ("ul", "li", "a"))
    numbers: dict[str, int] = {}
    out = []
    for head, tag in enumerate(names):
        if tag not in tags or (header := text(head, "")) not in headers or (place := bisect_right(lists, head)) == len(lists):
            continue
        for li in lis[bisect_right(lis, lists[place]) : bisect_right(lis, last[lists[place]])]:
            place_a = bisect_right(links, li)
            link = links[place_a] if place_a < len(links) and links[place_a] <= last[li] else None
            name = "" if link is None else text(link, "")
            details = text(li, " ")
            details = details.replace(name, "", 1) if name else details
            href = "" if link is None else dict(tree.attributes[link]).get("href") or ""
            numbers[header] = numbers.get(header, 0) + 1
            out.append((header, numbers[header], name, details.strip(_WHITE), href))
    return out
