"""HTML text against a tree walk with the Python library's parser."""

import html.entities
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from vigil.functions import html as H
from vigil.operators import letters as L

VOID = {"br", "img", "hr", "meta", "link", "input"}


class Strings(HTMLParser):
    """Stripped strings of the first ``root`` element (of everything without one)."""

    def __init__(self, root=None):
        super().__init__(convert_charrefs=False)
        self.root, self.depth, self.done, self.found, self.strings, self.open_text, self.silent = root, 0, False, root is None, [], "", 0

    def _inside(self):
        return (self.root is None or self.depth > 0) and not self.done

    def _flush(self):
        if self.open_text.strip():
            self.strings.append(self.open_text.strip())
        self.open_text = ""

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.silent += tag in ("script", "style")
        if tag == self.root and not self.done:
            self.found, self.depth = True, self.depth + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        self.silent -= tag in ("script", "style")
        if tag == self.root and self.depth:
            self.depth -= 1
            self.done = self.done or self.depth == 0

    def handle_comment(self, data):
        self._flush()

    def handle_data(self, data):
        if self._inside() and not self.silent:
            self.open_text += data

    def handle_entityref(self, name):
        rest = self.rawdata[self.offset_of(name):]
        known = html.entities.html5.get(name + ";")
        self.handle_data(known if known is not None else f"&{name}" + (";" if rest.startswith(";") else ""))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        try:
            own = bytes([code]).decode("cp1252") if 128 <= code < 160 else chr(code)
            own.encode()
        except (ValueError, OverflowError):
            own = "�"
        self.handle_data(own)

    def offset_of(self, name):
        return self.rawdata.index(f"&{name}", self._position()) + len(name) + 1

    def _position(self):
        line, column = self.getpos()
        return sum(len(x) + 1 for x in self.rawdata.split("\n")[: line - 1]) + column


def strings(text, root=None):
    p = Strings(root)
    p.feed(text)
    p.close()
    p._flush()
    return p.strings if p.found else None


FRAGMENTS = [
    "plain", "", "  a  <b> b </b>c ", "It&#8217;s R&amp;D &mdash; &frac12;", "&#x1F600;&#X1f600;&#150;&#153; x", "&bogus; &amp;lt; &amp;amp; &", "1 < 2 and 3 > 2 ",
    "caf&eacute;s &Eacute;&nbsp;x&nbsp;", "&NotEqualTilde; &fjlig; &lang;", "&#55296; &#1114112; &#99999999999; &#65;", "<p title='a>b' class=\"x>y\">in</p>out",
    "<script>var t = '<p>no</p>';</script>a<style>p{}</style>b<!-- <p>no</p> -->c", "a<br>b<br/>c", " nbsp ", "x &copy; y &reg z",
]


@pytest.mark.parametrize("sep", [" ", "\n"])
def test_fragment_text_equals_a_tree_walk(spark, sep):
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(FRAGMENTS)], "i int, h string")
    got = {r.i: r.t for r in rows.select("i", L.fragment_text(F.col("h"), sep).alias("t")).collect()}
    assert got == {i: sep.join(strings(f)) for i, f in enumerate(FRAGMENTS)}


def test_every_named_reference(spark):
    names = sorted({n.rstrip(";") for n in html.entities.html5})
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.t for r in rows.select("n", H.unescape(F.concat(F.lit("["), F.concat(F.lit("&"), "n", F.lit(";]")))).alias("t")).collect()}
    assert got == {n: f"[{html.entities.html5[n + ';']}]" for n in names} and len(names) > 2000


PAGES = [
    "<main><h1>T</h1><p>a</p></main>tail", "<p>no root</p>", "<main>out<main>in</main>after</main><main>second</main>", "x</main><main>a<main/>b</main>c",
    "<MAIN class='m'><main><main>deep</main></main><h1>A <b>B</b></h1></Main >z", "<main>never closed <p>b", "<main/><main>x</main>", "<mainly>no</mainly><main>yes</main>",
    "<!-- <main>no</main> --><main>yes<script></main></script>more</main>", "<main><h1>One</h1><h1>Two</h1></main>", "<main></main>", "<main>a<article><main>b</main></article>c</main>d",
]


def test_nested_roots_equal_a_tree_walk(spark):
    rows = spark.createDataFrame([(str(i), p) for i, p in enumerate(PAGES)], "url string, html string")
    got = {int(r.url): (r.title, r.content) for r in L.parse_detail(rows, "main").collect()}
    for i, page in enumerate(PAGES):
        content = strings(page, "main")
        assert got[i][1] == (None if content is None else "\n".join(content)), page
    assert got[0][0] == "T" and got[1] == (None, None) and got[4][0] == "A B" and got[9][0] == "One" and got[2][0] is None
    assert got[2][1] == "out\nin\nafter"


def test_href_references(spark):
    cell = ['<a href="/x?a=1&amp;b=2">n</a>', '<a href="/x?a=1&copy=2">n</a>', "<b>none</b>"]
    rows = spark.createDataFrame([(c,) for c in cell], "c string")
    assert [r[0] for r in rows.select(L.first_href(F.col("c"))).collect()] == ["/x?a=1&b=2", "/x?a=1&copy=2", None]


def test_a_very_long_page(spark):
    body = "<p class='k'>word &amp; &#8217;word</p>" * 20000
    row = L.parse_detail(spark.createDataFrame([("u", f"<main><h1>T</h1>{body}</main>")], "url string, html string"), "main").first()
    assert row.content == "T" + "\nword & ’word" * 20000
