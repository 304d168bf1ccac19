"""Plain pages are cut into tags as html.parser does it, and without it."""

import random
from html.parser import HTMLParser

import pytest

from saltmarsh.sources import html_tables, markup, tags


class Seen(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.calls = []

    def handle_starttag(self, tag, attrs):
        self.calls.append(("start", tag, attrs))

    def handle_endtag(self, tag):
        self.calls.append(("end", tag))

    def handle_data(self, data):
        self.calls.append(("data", data))

    def handle_comment(self, data):
        self.calls.append(("comment", data))


PIECES = [
    "<p>", "</p>", "<LI class=x>", "<td\n a='1'  b=\"2 3\" C>", "</TD >", "<br/>", "<a href='/p/1'>", "<a href=/p/1>", "<a b=1 b=2>", "<i x= 3>", "<!-- c -->", "<script>", "</script>", "<title>", "</title>", "<", ">", "& ", "&amp;", "&lt", "&#65;", "<a t='&amp;'>", "<a t='<'>",
    "text ", " x", "\n", "</", "<p/x>", "</p x>", "<x-y z>", "<!doctype html>", "<?pi?>", "<a b>", "<a b='>'>", "\0", "<p a='1'b='2'>", "<ſcript>", "<a İ>", "<style>", "</style>",
]


@pytest.mark.parametrize("close", [False, True])
def test_same_calls_as_the_parser(close):
    rnd = random.Random(7)
    plain = [p for p in PIECES if p[0] not in "<&" or p in ("<p>", "</p>", "<LI class=x>", "<td\n a='1'  b=\"2 3\" C>", "</TD >", "<a href='/p/1'>", "&amp;")]
    for n in range(20_000):
        page = "".join(rnd.choice(plain if n % 2 else PIECES) for _ in range(rnd.randint(0, 8)))
        short, whole = Seen(), Seen()
        tags.fed(short, page, close)
        whole.feed(page)
        if close:
            whole.close()
        assert short.calls == whole.calls, page


def test_plain_pages_take_the_short_way(monkeypatch):
    def no(*_):
        raise AssertionError("html.parser was asked")

    page = "<TABLE border=1><tr><th>a<th class='b c'>b</tr>\n<tr><td>1 &amp; 2<td><b>3</b></tr></TABLE><h3>Now</h3><ul><li><a href='/x'>X</a> y</ul>"
    monkeypatch.setattr(HTMLParser, "feed", no)
    one = html_tables._Tables()
    tags.fed(one, page, close=False)
    assert one.tables == [[["a", "b\n"], ["1 & 2", "3"]]]
    assert markup._items(markup._parsed(page), ["Now"], ("h3",)) == [("Now", 1, "X", "y", "/x")]
