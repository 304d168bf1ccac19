"""Pages as trees: random trees there and back, unclosed tags, nested lists, odd pages."""

import random

import pytest
from pyspark.sql import functions as F

from saltmarsh.sources import markup


def tree(rnd, depth=0):
    """(tag, attributes, children) or a text."""
    if depth > 5 or depth and rnd.random() < 0.3:
        return rnd.choice(["text", "a &amp; b", " x ", "é &lt;p&gt;"])
    tag = rnd.choice(["div", "span", "em", "section", "b", "ul"])
    attributes = rnd.choice([{}, {"class": "a b"}, {"id": "x>y", "hidden": None}, {"data-x": "1 &amp; 2"}])
    children, before = [], None
    for _ in range(rnd.randrange(4)):
        child = tree(rnd, depth + 1)
        if not (isinstance(child, str) and isinstance(before, str)):
            children.append(child)
            before = child
    return tag, attributes, children


def written(t):
    if isinstance(t, str):
        return t
    tag, attributes, children = t
    inner = "".join(f" {k}" if v is None else f' {k}="{v}"' for k, v in attributes.items())
    return f"<{tag.upper() if len(tag) > 3 else tag}{inner}>{''.join(map(written, children))}<!-- <p> --></{tag}>"


def expected(t):
    import html

    out = []

    def walk(t, parent, depth):
        node = len(out)
        if isinstance(t, str):
            out.append([node, parent, node, depth, "#text", None, html.unescape(t)])
            return
        tag, attributes, children = t
        out.append([node, parent, None, depth, tag, {k: v and html.unescape(v) for k, v in attributes.items()}, None])
        for c in children:
            walk(c, node, depth + 1)
        out[node][2] = len(out) - 1

    walk(t, None, 0)
    return out


def parsed(page):
    t = markup._parsed(page)
    return [list(x) for x in zip(range(len(t.tags)), t.parent, t.last, t.depth, t.tags, [a if a is None else dict(a) for a in t.attributes], t.texts)]


@pytest.mark.parametrize("seed", range(40))
def test_random_trees(seed):
    t = tree(random.Random(seed))
    assert parsed(written(t)) == expected(t)


def outline(page):
    """Nested lists of tags and stripped texts."""
    rows = parsed(page)
    made = {None: []}
    for node, parent, _, _, tag, _, text in rows:
        made[node] = [tag]
        if tag == "#text":
            if text.strip():
                made[parent].append(text.strip())
        else:
            made[parent].append(made[node])
    return made[None]


def test_unclosed_and_stray_tags():
    assert outline("<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>x") == [["ul", ["li", "a"], ["li", "b", ["ul", ["li", "c"], ["li", "d"]]], ["li", "e"]], "x"]
    assert outline("<p>a<p>b<div>c<p>d</div>e") == [["p", "a"], ["p", "b"], ["div", "c", ["p", "d"]], "e"]
    assert outline("<table><tr><td>1<td>2<tr><th>3</table>y") == [["table", ["tr", ["td", "1"], ["td", "2"]], ["tr", ["th", "3"]]], "y"]
    assert outline("<tr><td><table><tr><td>in</table><td>out") == [["tr", ["td", ["table", ["tr", ["td", "in"]]]], ["td", "out"]]]
    assert outline("</p><b>x</i></b></div>y<br/>z") == [["b", "x"], "y", ["br"], "z"]
    assert outline("<table><tr><td><div>a</table>b") == [["table", ["tr", ["td", ["div", "a"]]]], "b"]
    assert outline("<div><table><tr><td></div>a") == [["div", ["table", ["tr", ["td", "a"]]]]]
    assert outline("<dl><dt>a<dd>b<dt>c</dl><select><option>1<option>2</select>") == [["dl", ["dt", "a"], ["dd", "b"], ["dt", "c"]], ["select", ["option", "1"], ["option", "2"]]]
    assert outline("<script>if (a<b) '</p>'</script><style>p{}</style>t") == [["script", "if (a<b) '</p>'"], ["style", "p{}"], "t"]
    assert outline("") == [] and outline("<") in ([], ["<"]) and outline("a < b") == ["a < b"]


def test_long_and_deep_pages_take_linear_time():
    import time

    def took(page):
        began = time.perf_counter()
        markup._parsed(page)
        return time.perf_counter() - began

    for piece in ("<div>", "<li>", "<p>x", "</div>", "<ul><li>", "<td>"):
        took(piece * 100)
        assert took(piece * 40_000) < 20 * max(took(piece * 4_000), 0.02)


def test_nodes_of_a_table(spark):
    rows = [(1, "<p id=a ID=b>x</p>"), (2, None), (3, ""), (1, "<p id=a ID=b>x</p>")]
    found = markup.nodes(spark.createDataFrame(rows, "key int, html string")).collect()
    assert [(r["key"], r["node"], r["tag"], r["attributes"], r["text"]) for r in found] == [(1, 0, "p", {"id": "a"}, None), (1, 1, "#text", None, "x")] * 2
    assert markup.nodes(spark.createDataFrame([], "key int, html string")).count() == 0
    with pytest.raises(ValueError, match="tag"):
        markup.nodes(spark.createDataFrame([], "tag int, html string"))


def test_items_after_headers(spark):
    pages = [
        (1, "<h3> Open </h3><p>none<ul><li><a href=/1> One </a> One again <li>plain<ul><li><a>no href</a></ul></ul><ul><li>other</ul>"),
        (2, "<strong>Open</strong>no list"),
        (3, "<ul><li>before</ul><h2>Open</h2><ul><li>wrong tag</ul>"),
        (4, None),
        (5, "<strong>O<b>pe</b>n</strong><div><div><ul><li> a\n b <i> c</i></ul></div></div><h3>Shut</h3><ul><li></ul>"),
    ]
    found = markup.items_after_headers(spark.createDataFrame(pages, "key int, html string").withColumn("text", F.lit("z")).drop("text"), ["key"], ["Open", "Shut"])
    rows = sorted(map(tuple, found.collect()))
    assert rows == [
        (1, "Open", 1, "One", "One again", "/1"),
        (1, "Open", 2, "no href", "plain", ""),
        (1, "Open", 3, "no href", "", ""),
        (5, "Open", 1, "", "a\n b c", ""),
        (5, "Shut", 1, "", "", ""),
    ]
