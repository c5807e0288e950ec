import re
import time
from html.parser import HTMLParser

import pytest

from editscope.llm import html_text

from . import odd

CASES = [
    ("<p>a<p>b<ul><li>x<li>y<ol><li>1<li>2</ol></ul>c", "a\n\nb\n\n- x\n- y\n  1. 1\n  2. 2\n\nc"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>z", "a     bbb\ncccc  d\n\nz"),
    ("<div hidden>no</div><div style='display: none'>no</div>yes<script>var a='</p>';</script>", "yes"),
    ("<head><title>t</title><style>p{}</style></head><body>b", "b"),
    ("<title>t</title>b<template>x</template><input type=hidden value=q>", "b"),
    ("x<pre> a\n  b\n\nc</pre>t&amp;u &lt;", "x\n\n a\n  b\n\nc\n\nt&u <"),
    ("<b>a</b>  <i>b</i>c<br>d", "a bc\nd"),
    ('<p title="x>y">q<p title="broken>z', "q\n\nz"),
    ("a < b <3 <!-- c --> <?x?> </> <!doctype html>d", "a < b <3 d"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<details><summary>s</summary>gone</details><details open><summary>r</summary>here</details>", "s\nr\nhere"),
    ("<table><tr><th colspan=2>head</th></tr><tr><td rowspan=2>r</td><td>1<br>2</td></tr><tr><td>3</td></tr></table>",
     "head\nr  1\n   2\n   3"),
    ("<table>loose<tr><td><table><tr><td>in<td>ner</table><td>o</table>", "loose\nin  ner  o"),
    ("<ol start=7><li>a<li></ol><hr>", "7. a\n\n---"),
    ("<ul><li><p>one</p><p>two</p><li>b</ul>", "- one\n\n  two\n\n- b"),
    ("</p>a</div></td>b", "ab"),
    ("<svg><text>a</text></svg><select><option>b</select>c", "a b c"),
    ("tail <a href=", "tail"),
    ("", ""), (None, ""), ("   ", ""), ("&nbsp;&#x41;&bogus;", "\xa0A&bogus;"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert html_text.render(page) == text


STYLES = [
    ("<h1 style='backface-visibility: hidden'>card</h1>", "card"),
    ("<p style='-x-display:none;--visibility:hidden'>kept", "kept"),
    ("<p style='display:none;display:block'>a</p><p style='display:block;display:none'>b", "a"),
    ("<p style='display:none!important;display:block'>a</p><p style='DISPLAY : None'>b</p><p style='display:none;display:bogus'>c", ""),
    ("<p style='background:url(x;display:none)'>a<p style=\"content:';display:none'\">b<p style='/*;display:none;*/color:red'>c",
     "a\n\nb\n\nc"),
    ("<div style='visibility:hidden'>no<p style='visibility:visible'>yes<b style='visibility:hidden'>no</b></p>no</div>", "yes"),
    ("<div style='display:none'>no<p style='display:block;visibility:visible'>no</p></div>yes", "yes"),
    ("<ol><li>a<li style='visibility:hidden'>b<li>c</ol>", "1. a\n3. c"),
    ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "- b"),
    ("<table><tr><td>aa<td style='visibility:hidden'>b<td>c<tr><td>d<td>ee<td>f</table>", "aa      c\nd   ee  f"),
    ("<table><tr style='visibility:collapse'><td style='visibility:visible'>a<tr><td>b</table>", "b"),
    ("<table style='visibility:hidden'>no<tr>no<td>no<td style='visibility:visible'>yes</table>", "yes"),
    ("<pre style='visibility:hidden'>a\n<b style='visibility:visible'>b</b></pre>c", "b\n\nc"),
]


@pytest.mark.parametrize("page,text", STYLES)
def test_styles_hide_only_what_a_browser_hides(page, text):
    assert html_text.render(page) == text


FORMS = [
    ("a<textarea rows=2>\nx &amp;\n  y</textarea>b<textarea placeholder='say'></textarea>", "a\nx &\n  y\nb\nsay"),
    ("<svg><rect/><defs><text>no</text></defs><title>no</title><text x=1>a<tspan>b</tspan></text><circle r=1 /><text>c</text></svg>d",
     "ab c d"),
    ("<svg><text display=none>no</text><g visibility=hidden><text>no</text><text visibility=visible>yes</text></g></svg>", "yes"),
    ("<svg><foreignObject><p>page</p></foreignObject><style>p{}</style><path d=1><p>out", "page\n\nout"),
    ("x<select><option>a<option selected>b<option>c</select>y", "x b y"),
    ("<select><option disabled>a<option label=L>b</select>", "L"),
    ("<select><optgroup disabled label=g><option>a<optgroup label=h><option>b</select>", "b"),
    ("<select multiple><option>a<optgroup label=g><option>b</select>z", "a\ng\n  b\nz"),
    ("<select size=3><option>a<option style='display:none'>b<option hidden>c<option>d</select>", "a\nd"),
    ("<select><option>a &amp;lt;</select><select size=2><option>b &amp;lt;</select>", "a &lt;\nb &lt;"),
    ("<select><option>a<textarea>t</textarea>z", "a\nt\nz"),
    ("<input type=submit value='Send it'><input type=RESET value=Clear><input type=button value=&lt;>x", "Send it Clear < x"),
    ("<input type=checkbox value=no><input type=password value=no><input type=hidden value=no><input type=submit>x", "x"),
    ("Name <input value=Ann> <input type=email placeholder='your mail'><input type=odd value=o>", "Name Ann your mail o"),
    ("<input value=no style='visibility:hidden'><select hidden><option>no</select><textarea style='display:none'>no</textarea>x", "x"),
    ("<object>no</object><audio>no</audio><video>no</video><canvas>no</canvas><iframe>no</iframe><noscript>no</noscript>x", "x"),
]


@pytest.mark.parametrize("page,text", FORMS)
def test_forms_and_drawings_keep_what_a_browser_shows(page, text):
    assert html_text.render(page) == text


def test_long_styles():
    assert html_text.render(f"<p style='{'(' * 50_000}display:none'>a") == "a"
    assert html_text.render(f"<p style='{'a:b;' * 50_000}display:none'>a") == ""


def test_deep_and_long_pages():
    assert html_text.render("<div>" * 100_000 + "deep") == "deep"
    assert html_text.render("<table><tr><td>" * 2000 + "x").strip() == "x"
    assert html_text.render('<a title="' * 20_000) == ""
    long = "word " * 200_000
    assert html_text.render(f"<p>{long}</p>") == long.strip()


@pytest.mark.parametrize("depth", [150, 300, 5000])
@pytest.mark.parametrize("wrap", ["div", "span", "b", "blockquote", "ul", "svg", "table><tr><td"])
def test_depth_changes_nothing(depth, wrap):
    if wrap in ("blockquote", "ul") or wrap.startswith("table"):
        depth = min(depth, 1500)  # each level indents or lays out anew
    around = f"<{wrap}>" * depth
    inner = "<foreignObject>" if wrap == "svg" else ""
    page = (
        around + inner + "<p>seen<span style='display:none'>no</span><script>var no = '</p>';</script><style>no{}</style>"
        "<i hidden>no</i><i style='visibility:hidden'>no<b style='visibility:visible'>back</b></i><template>no</template>"
        "<ol><li>one<li>two</ol><table><tr><td>a<td>bb<tr><td>ccc<td>d</table><pre>x\n  y</pre><select><option>no<option selected>s</select>"
    )
    text = html_text.render(page)
    assert text.split() == ["seenback", "1.", "one", "2.", "two", "a", "bb", "ccc", "d", "x", "y", "s"] or wrap == "ul"
    assert "no" not in text.split() and "seenback" in text and "var" not in text
    assert {len(line) - len(line.lstrip()) for line in text.split("\n") if line.strip().startswith(("a  ", "ccc"))} != set()


def test_long_and_deep_pages_take_time_in_proportion():
    page = "<b><table>" + "<span>" * 60_000 + "</b>" * 60_000 + "x"
    began = time.time()
    assert html_text.render(page) == "x"
    assert html_text.render("<p>" + "<span>" * 60_000 + "<div>a" * 2000).count("a") == 2000
    assert html_text.render("<select>" + "<b>" * 20_000 + "<option>" + "<i>" * 20_000 + "in</select>") == "in"
    assert time.time() - began < 20


def test_columns_stay_aligned_beside_long_cells():
    long = " ".join(["word"] * 100)
    text = html_text.render(f"<table><tr><td>{long}<td>right<tr><td>a<td>b<tr><td>{'y' * 450}<td>c</table>")
    lines = text.split("\n")
    places = [line.index(mark) for mark in ("right", "b", "c") for line in lines if line.endswith(mark)]
    assert len(places) == 3 and len(set(places)) == 1
    assert max(map(len, lines)) < html_text.WIDTH + 10
    assert "".join(text.split()).replace("right", "").replace("a", "").replace("b", "").replace("c", "") == "word" * 100 + "y" * 450
    assert html_text.render(f"<table><tr><td>{long}</table>") == long  # nothing beside it


def test_wide_cells_do_not_multiply():
    rows = "".join(f"<tr><td>{'x' * 5000}<td>y" for _ in range(50))
    assert len(html_text.render(f"<table>{rows}</table>")) < 51 * 5100


class Plain(HTMLParser):
    """Another way to the text of simple pages: no tree, line breaks where a block starts or ends."""

    GAPS = {"p": 2, "h1": 2, "ul": 2, "div": 1, "nav": 1, "article": 1, "footer": 1, "li": 1, "body": 1, "br": 1}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.now, self.gap, self.off, self.inside = [], "", 0, None, False

    def block(self, gap, tag=""):
        if self.inside and tag != "br":  # a block that starts or ends closes a paragraph
            gap, self.inside = 2, False
        words = re.sub("[ \\t\\n\\r\\f]+", " ", self.now).strip(" ")
        if words and words != "-":
            self.lines += [""] * (self.gap > 1 and bool(self.lines)) + [words]
            self.gap = 0
        self.now, self.gap = "", max(self.gap, gap)

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style") and self.off is None:
            self.off = tag
        self.block(self.GAPS[tag], tag) if tag in self.GAPS else None
        self.inside = self.inside or tag == "p"
        self.now += "- " if tag == "li" else ""

    def handle_endtag(self, tag):
        self.off = None if tag == self.off else self.off
        self.block(self.GAPS[tag], tag) if tag in self.GAPS else None

    def handle_data(self, data):
        self.now += data if self.off is None else ""


def plain_text(page):
    reader = Plain()
    reader.feed(page or "")
    reader.close()
    reader.block(1)
    return "\n".join(reader.lines)


def test_operator_keeps_rows_and_columns(spark):
    rows = [(1, "<p>a", "old", 1), (1, "<p>a", "old", 1), (None, None, None, None), (2, "", "t", 2)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int")
    got = html_text.extract(pages)
    assert sorted(map(repr, ((r.page_id, r.text, r.n_chars) for r in got.collect()))) == sorted(
        map(repr, [(1, "a", 1), (1, "a", 1), (None, "", None), (2, "", 2)]))
    assert html_text.extract(pages.limit(0)).count() == 0


def test_query_covers_all_pages(spark, sf_dir):
    pages = {r.page_id: r.html for r in odd.plain(spark, sf_dir, "pages").collect()}
    got = html_text.op3_html(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain_text(pages[r.page_id])
        assert (r.n_chars, r.n_lines) == (len(r.text), r.text.count("\n") + 1)
        assert "track(" not in r.text and "margin:0" not in r.text
