"""Layout rendering: hand-made layouts, and visible words against another parser."""

import random
import time
from html.parser import HTMLParser

import pytest

from tessera.llm import layout_html as lay
from tessera.llm._common import read_table

LAYOUTS = [
    ("<p>a<p>b <b>c</b>d<br>e<div>f</div>g", "a\n\nb cd\ne\n\nf\ng"),
    ("<ul><li>x<li>y<ol start=3><li>p<li value=9>q</ol><li>z</ul>after", "- x\n- y\n  3. p\n  9. q\n- z\n\nafter"),
    ("<table><caption>cap</caption><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>total of all<tr><td rowspan=2>r<td>1<tr><td>2</table>end",
     "cap\nName       Qty\napple pie  3\ntotal of all\nr          1\n           2\n\nend"),
    ("<pre>a\n  b\n</pre>x", "a\n  b\n\nx"),
    ("<head><title>t</title><style>p{}</style></head><p hidden>no</p><p style='display: none'>no<b>no</b></p>"
     "<span style='visibility:hidden'>no<i style='visibility:visible'>yes</i></span><script>var t='</p>'</script> end &amp; &copy;", "yes end & ©"),
    ("<table><td>one<table><tr><td>in<td>ner</table><td>two</table>", "one      two\n\nin  ner"),
    ("a < b <c> d</c> <!-- x --> e <! f> g<!-- unclosed <p>x", "a < b d e g"),
    ("<dl><dt>t<dd>d<dt>u</dl><blockquote>q<p>r</blockquote>", "t\n  d\nu\n\n  q\n\n  r"),
    ("<td>x<tr>y</table>z", "xyz"), ("<ul><li></li><li>a</ul>", "-\n- a"), ("<div>" * 30000 + "deep", "deep"),
    ("日本<table><tr><td>日本語<td>x<tr><td>abcd<td>y</table>", "日本\n\n日本語  x\nabcd    y"),
    ("</p>a</br>b<h1>t<h2>u</h1>v", "a\nb\n\nt\n\nu\n\nv"), ("<b>a</b> <i>b</i>c\n d<select><option>o<option>p</select>", "a bc d\no\np"),
    (None, ""), ("", ""), ("<", "<"), ("<a href='x", "<a href='x"), ("<table><tr><td colspan=99999 rowspan=x>a<td>b</table>", "a  b"),
    ("<textarea>a &lt; <b></textarea><title>no</title>c", "a < <b>c"), ("<script>never ended", ""),
]


@pytest.mark.parametrize("page, text", LAYOUTS)
def test_layout(page, text):
    assert lay.render(page)[0] == text


OUTSIDE_CELLS = [
    ("<table>lost<tr><td>x</table>", "lost\n\nx"), ("<table><tr><div>lost</div><td>x</table>", "lost\n\nx"),
    ("a<table>b<tr> <td>x</td> c <td>y</table>d", "ab c\n\nx  y\n\nd"),
    ("<table><tr><td>o<table>in<tr><td>x</table><td>p</table>", "oin  p\n\nx"),
    ("<table><tbody><ul><li>i</ul><tr><td>x<tfoot>f<tr><td>y</table>", "- i\n\nf\n\nx\ny"),
    ("<table hidden>lost<tr><td>no</table>", "lost"), ("<table><tr style='visibility:hidden'>lost<td>no</table>", "lost"),
    ("<div hidden><table>no<tr><td>no</table></div>x", "x"), ("<table><div hidden>no<td>x</table>", "x"),
    ("<table><b>a</b> <i>b</i><i> c</i><tr><td>x</table>", "ab c\n\nx"), ("<table>a<table>b<tr><td>x</table>c", "a\n\nb\n\nx\n\nc"),
    ("<table><caption>a</caption><caption>b</caption><td>x</table>", "a\nb\nx"), ("<table><colgroup>a<col><div>b</div><td>x</table>", "a\nb\n\nx"),
    ("<table><script>no</script><style>no</style><td>x</table>", "x"),
    ("x <math><mi>a</mi><mo>+</mo><mn>1</mn><annotation>no</annotation></math> y", "x a+1 y"),
    ("<svg><title>no</title><style/><defs/><defs><text>no</text></defs><text>a</text><text>b<tspan>c</tspan></text></svg>d", "a bc d"),
    ("<svg><defs><path/><p>out", "out"), ("<svg/>a<svg><foreignObject><p>b</p></foreignObject></svg>", "a\n\nb"),
    ("<object data=x><param name=y>fall</object> <canvas>back</canvas><video>no</video>", "fall back"),
]


@pytest.mark.parametrize("page, text", OUTSIDE_CELLS)
def test_all_visible_text(page, text):
    assert lay.render(page)[0] == text


CLOSED = [
    ("a<details><summary>s</summary>no<p>no</details>b", "a\ns\nb"), ("<details open><summary>s</summary>yes</details>", "s\nyes"),
    ("<dialog>no</dialog><dialog open>yes</dialog>x", "yes\nx"), ("<details>no<summary>s</summary><summary>no</details>", "s"),
]


@pytest.mark.parametrize("page, text", CLOSED)
def test_closed_elements(page, text):
    assert lay.render(page)[0] == text


# One shape a megabyte long: never-ended tags, deep blocks, quotes, lists, and inline elements of one line.
HOSTILE = ["<a ", '<a "', "<a '\"", "<!", "<div>", "<blockquote>x", "<ul><li>x", "<dl><dd>x", "<svg>", "<body>", "<p>x<b>", "a <b>b</b> ",
           "<script </script ", "<pre>x", "<details>x"]


@pytest.mark.parametrize("unit", HOSTILE)
def test_time_and_output_grow_with_the_page(unit):
    """Four times the page takes about four times as long (sixteen times if it
    were quadratic), and lines are no longer than their indent and text."""
    def measured(size):
        page, begin = unit * (size // len(unit)), time.process_time()
        text = lay.render(page)[0]
        return time.process_time() - begin, len(text) / len(page)

    small, _ = min(measured(250_000) for _ in range(2))
    large, growth = measured(1_000_000)
    assert large < 10 * small + 0.5 and growth < lay.MAX_INDENT


def test_ends_of_tags():
    """Tag by tag against reading on from each place."""
    rnd = random.Random(5)
    for _ in range(3000):
        page = "".join(rnd.choice(["<a ", "'", '"', ">", "x", " "]) for _ in range(rnd.randint(1, 40)))
        ends = lay.TagEnds(page)
        for at in range(len(page) + 1):
            quote, expected = "", -1
            for k in range(at, len(page)):
                if quote:
                    quote = "" if page[k] == quote else quote
                elif page[k] in "\"'":
                    quote = page[k]
                elif page[k] == ">":
                    expected = k + 1
                    break
            assert ends.after(at) == expected


def test_deep_indents():
    lines = lay.render("<blockquote>x" * 100)[0].split("\n")
    assert [len(line) - 1 for line in lines if line] == [min(2 * k, lay.MAX_INDENT) for k in range(1, 101)]
    assert lay.render("<ul><li>" * 50 + "x")[0] == "- " * 50 + "x"  # markers are text


class Words(HTMLParser):
    """Visible words in order; for well-formed pages without tables or inline hiding."""

    def __init__(self):
        super().__init__()
        self.hidden, self.text = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in lay.HIDDEN
        if tag in lay.BLOCK or tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in lay.HIDDEN
        if tag in lay.BLOCK:
            self.text.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def test_words_of_all_pages(spark):
    pages = read_table(spark, "/root/testdata/sf0.001", "pages")
    out = {r["page_id"]: r for r in lay.rendered_pages(pages).collect()}
    for r in pages.collect():
        words = Words()
        words.feed(r["html"])
        words.close()
        got = [w for line in out[r["page_id"]]["text"].split("\n") for w in lay.WORD.findall(line.removeprefix("- ") if line != "-" else "")]
        assert got == lay.WORD.findall("".join(words.text))


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "<p>x"), (3, "<li>" * 5000 + "a")]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "html AS text", "page_id AS n_lines")
    out = sorted((tuple(r) for r in lay.rendered_pages(df).collect()), key=str)
    assert [r[:2] for r in out if r[0] != 3] == [(1, ""), (1, ""), (None, "x")] and len(out) == 4
    assert lay.rendered_pages(df.limit(0)).count() == 0
