import random
import time
from html.parser import HTMLParser

import pytest

from halocline.llm.html_text import WRAP, extract, op2_html_text, page_text, wrapped

SF = "/root/testdata/sf0.01"


class Visible(HTMLParser):
    """Words outside head, script and style, with no layout."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in ("script", "style", "title", "noscript", "template")

    def handle_endtag(self, tag):
        self.depth -= tag in ("script", "style", "title", "noscript", "template")

    def handle_data(self, data):
        if not self.depth:
            self.words.append(data)


def text(page):
    return page_text(page)[1]


@pytest.mark.parametrize(
    "page, expected",
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>one<p>two <b>bold<p>three</b> more", "one\n\ntwo bold\n\nthree more"),
        ("<div>a</div><div>b</div>c", "a\nb\nc"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<ul><li>x<li>y<ul><li>z</ul><li>w</ul>", "- x\n- y\n  - z\n- w"),
        ("<ol start=9><li>x</li><li>y<p>z</ol>", "9. x\n10. y\n\n    z"),
        ("<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td colspan=2>all</table>", "name      | n\nlong name | 1\nall"),
        ("<table><tr><td>a<br>b<td>c</table>d", "a | c\nb |\n\nd"),
        ("<pre>  x\n   y</pre>", "  x\n   y"),
        ("<p hidden>no<p style='color:red; display : NONE'>no<p>yes", "yes"),
        ("<script>if (a < b) '</p>'</script>x<style>p{}</style>y<!-- <p>no --> z", "xy z"),
        ("<head><title>T &amp; t</title></head><body>b &lt;i&gt; &eacute;", "b <i> é"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
        ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
        ("a < b <c d='>'>e</c> </p>f", "a < b e\n\nf"),
        ("<a href='x>y'>l</a><img alt=no><input type=hidden value=v><", "l<"),
        ("<table><td>a<table><tr><td>b<td>c</table><td>d</table>", "a     | d\n      |\nb | c |"),
        ("x<div><span>y</div>z", "x\ny\nz"),
        ("<select><option>a<option>b</select>", "a\nb"),
        ("<textarea> a <b> \n c</textarea>", " a <b>\n c"),
        ("<![CDATA[x]]>y<?php no ?>z", "xyz"),
    ],
)
def test_layout(page, expected):
    assert text(page) == expected


def test_title_and_depth():
    assert page_text("<title> a\n b </title>c") == ("a b", "c")
    deep = "<div>" * 50000 + "core" + "</div>" * 50000 + "end"
    assert text(deep).split() == ["core", "end"]
    assert len(text("<ul><li>" * 3000 + "x").split()) >= 1
    assert text("<" * 100000) == "<" * 100000
    assert text("<a " + "x='" * 50000).strip() in ("", "<a " + "x='" * 50000)


def test_long_cell_goes_on_in_its_own_column():
    """Columns stay aligned whatever a cell holds, and a cell takes no more than WRAP of each row."""
    page = "<table><tr><td>" + "x" * 5000 + "<td>b" + "<tr><td>short<td>c" * 2000 + "</table>"
    lines = text(page).split("\n")
    assert len(lines) == -(-5000 // WRAP) + 2000 and max(map(len, lines)) == WRAP + 4
    assert lines[0] == "x" * WRAP + " | b" and lines[1] == "x" * WRAP + " |" and lines[-1] == "short".ljust(WRAP) + " | c"
    words = text("<table><tr><td>" + "word " * 100 + "<td>b<tr><td>s<td>c</table>").split("\n")
    assert all(set(line.split(" | ")[0].split()) <= {"word", "|"} for line in words[:-1]) and sum(line.count("word") for line in words) == 100
    for n in (59, 150, 158):
        rows = text("<table><tr><td>" + "y" * n + "<td>b" + "<tr><td>s<td>c" * 200 + "</table>").split("\n")
        assert len(rows) == 201 and {r.index(c) for r, c in zip(rows, ["b"] + ["c"] * 200, strict=True)} == {n + 3}


def test_table_keeps_every_visible_word(spark):
    rows = op2_html_text(spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        plain = Visible()
        plain.feed(pages[r.page_id])
        plain.close()
        squeeze = lambda s: sorted("".join(s.split()).replace("|", "").replace("-", ""))
        assert squeeze("".join(plain.words)) == squeeze(r.text), r.page_id
        if "<table" not in pages[r.page_id] and "<ol" not in pages[r.page_id]:  # and in the same order
            assert "".join("".join(plain.words).split()).replace("-", "") == "".join(r.text.split()).replace("-", ""), r.page_id


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "<p>x", 5), (None, "<p>x", 5), (1, "<p>x", 5)], "page_id long, html string, text int")
    assert [(r.page_id, r.text) for r in extract(df).collect()] == [(1, ""), (1, "x"), (None, "x"), (1, "x")]
    assert extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, expected",
    [
        ("so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><mspace/></math>, yes", "so x= 1 2 , yes"),
        ("<math><semantics><msup><mi>a</mi><mn>2</mn></msup><annotation>a^2</annotation><annotation-xml><ci>a</ci></annotation-xml></semantics></math>b", "a2b"),
        ("<p>see<svg><title>t</title><desc>d</desc><defs><text>n</text></defs><metadata>m</metadata><style>s{}</style><path d='M0'/><text x=1>one</text><text>t<tspan>wo</tspan></text>stray</svg>end", "see one two end"),
        ("<svg><g><title/><rect/><text>in</text></g></svg><p>after", "in\n\nafter"),
        ("<svg><foreignObject><b>html</b></foreignObject><text display=none>no</text></svg>", "html"),
        ("a<svg/>b<math/>c", "abc"),
    ],
)
def test_formulas_and_labels(page, expected):
    assert text(page) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<table><tr><td rowspan=2>A<td>B<td>C<tr><td>D<td>E</table>", "A | B | C\n  | D | E"),
        ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tbody><tr><td>f<td>g</table>", "a | b | c\nd |   | e\nf | g"),
        ("<table><tr><td colspan=1000>wide<td>x<tr><td>a<td>b</table>", "wide  | x\na | b"),
        ("<table><tr><td colspan=2>over two columns<td>x<tr><td>a<td>b<td>c</table>", "over two columns | x\na | b            | c"),
        ("<div>" * 200 + "<div hidden>SECRET<p>MORE</p></div>seen" + "</div>" * 200, "seen"),
        ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b><p>no</div>after", "yes\n\nafter"),
        ("<ol><li>a<li style='visibility:hidden'>b<li hidden>c<li>d</ol>", "1. a\n3. d"),
        ("<details>no<summary>short</summary><p>no</details><details open>yes<summary>s</summary></details>", "short\nyes\ns"),
        ("<svg visibility=hidden><text>no</text><text visibility=visible>yes</text></svg>", "yes"),
        ("<p style='display:none'>no<b style='visibility:visible'>no</b></p>yes", "yes"),
        ("<svg><title>inner</title></svg><title>page</title>x", "x"),
    ],
)
def test_what_is_shown_where(page, expected):
    assert text(page) == expected


def test_many_open_elements_take_linear_time():
    n = 30_000
    for page in ("<b>" * n + "</i>" * n, "<p>" + "<b>" * n + "<p>x" * n, "<svg>" + "<g>" * n + "<path/>" * n, "<li>" + "<b>" * n + "<li>" * n):
        text(page)


def test_blocked_end_tags_take_linear_time():
    """A million bytes of end tags that an inner table or block holds back, or that close nothing."""
    n = 60_000
    for page in ("<div><table>" + "<span>" * n + "</div>" * n, "<b><div>" + "<i>" * n + "</b>" * n, "<ul><li>" + "<span>" * n + "<td>" * n, "<table><tr><td><div>" * 300 + "</span></p>" * n):
        began = time.perf_counter()
        text(page)
        assert time.perf_counter() - began < 2


def test_nesting_goes_as_deep_as_in_browsers():
    deep = text("<ul><li>" * 200 + "x")
    assert deep.endswith("- x") and deep.count("- ") == 200
    assert len(text("<ul><li>" * 100_000 + "x")) < 5000


@pytest.mark.parametrize("line, width, expected", [("abc", 5, ["abc"]), ("ab cd ef", 5, ["ab cd", "ef"]), ("abcdefgh", 3, ["abc", "def", "gh"]), ("  ab cd ef", 6, ["  ab", "  cd", "  ef"]), ("a bcdefgh", 4, ["a", "bcde", "fgh"])])
def test_wrapping(line, width, expected):
    assert wrapped(line, width) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<style>.x{display:none} #i { visibility : hidden }</style><p class='a x'>no<p id=i>no<b style='visibility:visible'>yes</b><p class=xx>seen", "yes\n\nseen"),
        ("<p class=x>no</p>yes<style>p.x, q{color:red;DISPLAY:NONE}</style><div class=x>seen</div>", "yes\nseen"),
        ("<style>.x{display:none} p{display:block}</style><p class=x>no<p>yes", "yes"),
        ("<style>p.x{display:none} .x{display:block}</style><p class=x>no", ""),
        ("<style>.x{display:none} .x{display:block}</style><p class=x>yes", "yes"),
        ("<style>.x{display:none}</style><p class=x style='display:block'>yes", "yes"),
        ("<style>.x{display:none !important}</style><p class=x style='display:block'>no", ""),
        ("<style>@media print{.x{display:none}} @media screen{.y{display:none}} @font-face{display:none}</style><p class=x>yes<p class=y>no", "yes"),
        ("<style media=print>.x{display:none}</style><style>/* .y{display:none} */ div .x{display:none} .y:hover{display:none}</style><p class='x y'>yes", "yes"),
        ("<!-- <style>.x{display:none}</style> --><p class=x>yes<style>}{{.x{", "yes"),
        ("<style>*{visibility:hidden} .s{visibility:visible}</style><div>no<p class=s>yes</div>", "yes"),
        ("<ol><li>a<li value=7>b<li>c</ol><ol reversed><li>x<li>y<li>z</ol><ol reversed start=9><li>p<li>q</ol>", "1. a\n7. b\n8. c\n\n3. x\n2. y\n1. z\n\n9. p\n8. q"),
        ("<form>name <input type=text value=no> <input type=submit value='Send it'><input type=BUTTON value=x></form>", "name Send itx"),
    ],
)
def test_style_sheets_and_labels(page, expected):
    assert text(page) == expected


def table_by_hand(rows):
    """Rows of (text, colspan, rowspan), each cell put into every place it covers; only the first place shows its text."""
    grid = {}
    for r, row in enumerate(rows):
        c = 0
        for cell, across, down in row:
            while (r, c) in grid:
                c += 1
            for i in range(down):
                for j in range(across):
                    grid.setdefault((r + i, c + j), (cell if i == j == 0 else "", j == 0, (r, c)))
            c += across
    return grid


def test_random_tables():
    rnd = random.Random(9)
    for _ in range(300):
        rows = [[(f"{r}x{c}" + "y" * rnd.choice((0, 0, 3, 130)), rnd.choice((1, 1, 1, 2, 3)), 1 if r == 4 else rnd.choice((1, 1, 2))) for c in range(rnd.randrange(1, 5))] for r in range(5)]
        page = "<table>" + "".join("<tr>" + "".join(f"<td colspan={a} rowspan={d}>{t}" for t, a, d in row) for row in rows) + "</table>"
        lines = text(page).split("\n")
        assert len(lines) == 5
        column = {}
        grid = table_by_hand(rows)
        for (r, c), (cell, first, owner) in sorted(grid.items()):
            if cell and first and owner == (r, c):
                column.setdefault(c, set()).add(lines[r].index(cell))
        assert all(len(places) == 1 for places in column.values()), page  # all cells of a column start in one place
        order = [next(iter(column[c])) for c in sorted(column)]
        assert order == sorted(set(order)), page
        for r, row in enumerate(rows):
            assert [x.strip() for x in lines[r].split("|") if x.strip()] == [t for t, _, _ in row]


def test_growth_of_a_table_is_bounded():
    page = "<table>" + "<tr><td>" + "x" * 3000 + "<td>b" + "<tr><td>s<td>c" * 3000 + "</table>"
    assert len(text(page)) < (WRAP + 5) * 3100 and text(page).endswith("s".ljust(WRAP) + " | c")
    assert len(text("<table>" + "<tr>" + "<td colspan=1000>a" * 300 + ("<tr><td colspan=300000>b<td>c" * 1000) + "</table>")) < 200_000
