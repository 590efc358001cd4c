"""Selectors against a walk of the document tree, tables against a filled grid, rules of lists on small pages."""

from __future__ import annotations

import datetime
import random
from html import escape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finloom.sources import page_lists
from finloom.sources.markup import END, START, TEXT, Extraction, Field, compiled, converted_cells, events, page_tables, select_rows, span, table_cells


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def text(self):
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def walk(self):
        yield self
        for c in self.children:
            if not isinstance(c, str):
                yield from c.walk()


def dom(html) -> Node:
    root = at = Node("", {}, None)
    for kind, value, attrs in events(html):
        if kind == TEXT:
            at.children.append(value)
        elif kind == START:
            node = Node(value, attrs, at)
            at.children.append(node)
            at = node
        else:
            assert kind == END and at.tag == value
            at = at.parent
    assert at is root
    return root


def fits(node: Node, compound, scope: Node | None) -> bool:
    siblings = [c for c in node.parent.children if not isinstance(c, str)]
    place = next(i for i, c in enumerate(siblings) if c is node)
    of_type = sum(c.tag == node.tag for c in siblings[: place + 1])
    return compound.fits(node.tag, node.attrs, of_type, place + 1, node is scope)


def matches(node: Node, path, scope: Node | None) -> bool:
    """From the right: the last compound fits, those before fit elements above, down to the scope."""
    (child, compound), rest = path[-1], path[:-1]
    if node.parent is None or not fits(node, compound, scope):
        return False
    if not rest:
        return True
    above = node.parent if node is not scope else None
    while above is not None and above.parent is not None:
        if matches(above, rest, scope):
            return True
        if child or above is scope:
            return False
        above = above.parent
    return False


def selected(top: Node, css: str, scope: Node | None) -> list[Node]:
    paths = compiled(css)
    return [n for n in top.walk() if n.parent is not None and any(matches(n, p, scope) for p in paths)]


HTML = st.lists(
    st.sampled_from(
        ["<div class='a'>", "<div class='b a'>", "<div>", "</div>", "<p>", "</p>", "<ul>", "<li>", "<li class=b>", "</ul>", "<a href='/x'>", "<a>", "</a>", "<b>", "</b>", "<br>", "t", "u &amp; v", "<table><tr><td>", "<td>", "</table>", "<!-- <a> -->", "<", "</i>"]
    ),
    max_size=40,
).map("".join)
SELECTORS = ["div", "div a", "div > a", ".a .b", "div.a.b > *", "li a[href]", "ul > li:nth-of-type(2)", "a, b", "td > a", "li:first-child b", "[class~='b']", "div div div", "* > b", "p:nth-child(2)"]


@settings(max_examples=400, deadline=None)
@given(HTML, st.sampled_from(SELECTORS), st.sampled_from([*SELECTORS, ":scope", "> a", ":scope > b", ":scope a"]), st.sampled_from(SELECTORS))
def test_against_the_tree(html, rows, inner, deeper):
    fields = {"all": Field(inner, every=True), "first": Field(inner), "nodes": Field(inner, "nodes", every=True), "attr": Field(inner, "@class", every=True), "deep": Field(deeper, within="first", every=True)}
    found = Extraction(rows, fields).read(html)
    expected = []
    for row in selected(dom(html), rows, None):
        inside = selected(row, inner, row)
        deep = selected(inside[0], deeper, inside[0]) if inside else []
        nodes = [(c, n) for n in inside for c in n.children if isinstance(c, str)]
        expected.append(([n.text() for n in inside], [n.text() for n in inside[:1]], sorted(c for c, _ in nodes), [n.attrs.get("class", "") for n in inside], [n.text() for n in deep]))
    assert [(r[0], r[1], sorted(r[2]), r[3], r[4]) for r in found] == expected


def test_texts_in_order():
    """Texts of nested matches come as the page has them."""
    found = Extraction("a", {"t": Field(":scope, p, p *", "nodes", every=True)}).read("<a>1<p>2<b>3</b>4</p>5<i>no</i>6</a>")
    assert found == [[["1", "2", "3", "4", "5", "6"]]]


def test_markup():
    assert [v for k, v, _ in events('<a title="x > y" b=1 B=2>t</a>') if k == START] == ["a"]
    assert next(a for k, _, a in events("<a b=1 B=2 c d='&lt;'>") if k == START) == {"b": "1", "c": "", "d": "<"}
    assert "".join(v for k, v, _ in events("<script>if (a < b) '</p>'</script>x") if k == TEXT) == "if (a < b) '</p>'x"
    assert [v for k, v, _ in events("<title>a <b> &amp; c</title>") if k == TEXT] == ["a <b> & c"]
    assert list(events("")) == [] and [v for _, v, _ in events("a < b <c")] == ["a < b <c"]
    for bad in ("", "a >", "a[", "a,,b", ":hover"):
        with pytest.raises(ValueError):
            compiled(bad)


@pytest.mark.parametrize("html", ["<b>" * 20_000 + "</i>" * 20_000, "<p" * 50_000, "<a x='" * 20_000, "<!--" * 50_000, "<li>" * 50_000, "<p" * 50_000 + ">", "<a x='" * 20_001 + ">", "</a" * 50_000 + ">", "<a " + "b " * 50_000 + ">"])
def test_broken_markup_takes_no_longer(html):
    Extraction("p", {"t": Field("b")}).read(html[:60_000])
    table_cells(html)


@st.composite
def grids(draw):
    rng = random.Random(draw(st.integers(0, 10**9)))
    return [[(rng.choice([1, 1, 1, 2, 3, 9, 0]), rng.choice([1, 1, 1, 2, 3]), f"v{rng.randrange(99)}") for _ in range(rng.randrange(5))] for _ in range(rng.randrange(1, 7))]


@settings(max_examples=300, deadline=None)
@given(grids())
def test_cells_against_a_filled_grid(rows):
    taken, expected = set(), []
    for r, row in enumerate(rows):
        c = 0
        for down, across, value in row:
            while (r, c) in taken:
                c += 1
            rowspan = min(down or 99, len(rows) - r)
            taken |= {(i, j) for i in range(r, r + rowspan) for j in range(c, c + across)}
            expected.append((0, r, c, value, rowspan, across, False, ""))
            c += across
    ends = ["</td>", ""]
    html = "<table>" + "".join("<tr>" + "".join(f"<td rowspan={d} colspan='{a}'> {v}{ends[i % 2]}" for i, (d, a, v) in enumerate(row)) for row in rows) + "</table>"
    assert table_cells(html) == expected


def test_tables():
    assert [c[:4] for c in table_cells("<table><tr><td>a<table><tr><td>b</table>c<td>d</table>")] == [(0, 0, 0, "abc"), (0, 0, 1, "d"), (1, 0, 0, "b")]
    labelled = table_cells("<table><tr><th rowspan=2>k<th colspan=2>g<tr><th>x<th>y<tr><th>r<td>1<td>2<tr><th>only</table>")
    assert [c[7] for c in labelled] == ["", "", "", "", "k", "g / x", "g / y", "k"]
    groups = table_cells("<table><thead><tr><td rowspan=9>h</thead><tbody><tr><td rowspan=0>a<td>b<tr><td>c</tbody><tfoot><tr><td>f</tfoot></table>")
    assert [(c[1], c[2], c[3], c[4]) for c in groups] == [(0, 0, "h", 1), (1, 0, "a", 2), (1, 1, "b", 1), (2, 1, "c", 1), (3, 0, "f", 1)]
    assert table_cells("<tr><td>no table</td></tr>") == [] and table_cells("<table></table>") == []
    assert [span(x, 1000) for x in (None, "", "x", "2", " 3px", "0", "-1", "99999")] == [1, 1, 1, 2, 3, 0, 1, 1000]


def test_rows_of_pages(spark):
    pages = spark.createDataFrame([(1, "<li><a>x</a><li>y", "k"), (2, None, "k"), (None, "<li>z", None)], "id long, html string, row string").withColumnRenamed("row", "kept")
    found = select_rows(pages, "id", "html", "li", {"a": Field("a")}, ("kept",)).collect()
    assert sorted((r.id or 0, r.kept, r.row, r.a) for r in found if r.id) == [(1, "k", 0, ["x"]), (1, "k", 1, [])]
    assert len(found) == 3 and page_tables(pages, "id", "html").count() == 0


def now():
    return F.lit("2024-01-01").cast("timestamp")


def _page(spark, html):
    return spark.createDataFrame([(1, html, "https://h.example/a/b?c")], "id long, html string, base string")


def test_article_rows(spark):
    html = """<div class=c><h2><a href="x">  T &amp; 1 </a></h2><i>May</i></div><div class=c><h2 href='//o.example/y'>T2<a href=z>no</a></h2></div>
      <div class=c><h2><a>no link</a></h2><a href=w>outside</a></div><div class=c><h2> </h2></div><div class=c><a href=v>no title</a></div>
      <div class=c><h2><a href="/a/x">again</a></h2><i> </i></div><div class=c><h2><a href="http://[bad">bad</a></h2></div><div class=c><h2>T3<a href='#f'>f</a></h2></div>"""
    rows = page_lists.article_rows(_page(spark, html), "id", "html", "base", "div.c", "h2", date="i").orderBy("row").collect()
    assert [(r.row, r.title, r.url, r.date) for r in rows] == [
        (0, "T & 1", "https://h.example/a/x", "May"), (1, "T2no", "https://o.example/y", None), (5, "again", "https://h.example/a/x", None), (7, "T3f", "https://h.example/a/b?c#f", None)
    ]
    few = page_lists.article_rows(_page(spark, html), "id", "html", "base", "div.c", "h2", most=2).orderBy("row").collect()
    assert [r.row for r in few] == [0, 1]


def test_news_table(spark):
    html = """<table class="s_news_list mgbt0"><tr><th>t<th>k<th>title</tr>
      <tr><td class="news_time"><time datetime="2026-03-18T10:00:00+09:00">10</time></td><td><div class="newslist_ctg newsctg2_b"> k </div></td><td><a href="/news/1"> One </a></td></tr>
      <tr><td class="news_time"><time datetime="bad"></time></td><td></td><td><a>Two</a></td></tr><tr><td>ad<td>x<td>no anchor</tr>
      <tr><td class="news_time x"><time datetime="2026-03-18T10:00:00"></time><td><td><a href="https://o.example/3">Three</a></table><table><tr><td>1<td>2<td><a href=/n>no</a></table>"""
    rows = page_lists.news_table_rows(_page(spark, html), "id", "html", "https://h.example", now()).orderBy("row").collect()
    late = datetime.datetime(2024, 1, 1)
    assert [(r.title, r.url, r.published, r.kind) for r in rows] == [
        ("One", "https://h.example/news/1", datetime.datetime(2026, 3, 18, 1), "k"), ("Two", "https://h.example", late, None), ("Three", "https://o.example/3", late, None)
    ]


def test_link_items(spark):
    html = """<ul><li><a href="/news/search">all</a></li><li><a href="/news/1"><h3>One</h3><time datetime="2026-03-18T10:00:00">x</time></a></li>
      <li><a href="/news/1"><h3>again</h3></a></li><li><a href="https://minkabu.jp/news/2?x"> two <span>badge</span><p>more <b>text</b></p></a></li>
      <li><a href="/news/3"><img></a></li><li><a href="https://o.example/news/4">other</a></li></ul><a href="/news/5">bare</a>"""
    rows = page_lists.link_items(_page(spark, html), "id", "html", "https://minkabu.jp", now(), 10).orderBy("row").collect()
    assert [(r.title, r.url) for r in rows] == [("One", "https://minkabu.jp/news/1"), ("two more text", "https://minkabu.jp/news/2?x")]
    assert rows[0].published == datetime.datetime(2026, 3, 18, 1)
    assert page_lists.link_items(_page(spark, html), "id", "html", "https://minkabu.jp", now(), 1).count() == 1
    bare = page_lists.link_items(_page(spark, '<p><a href="/news/5">bare</a><a href="/news/6"></a>'), "id", "html", "https://minkabu.jp", now(), 10).collect()
    assert [r.title for r in bare] == ["bare"]


def test_cards(spark):
    html = """<div data-testid="HeroCard"><div data-testid="Title"><a href="/m/1"><span data-testid="Heading">One</span></a></div><time dateTime="2026-03-18T01:00:00Z"></time></div>
      <li data-testid="BasicCard"><a data-testid="Heading">no link</a></li><a data-testid="BasicCard" href="/m/2"><b data-testid="Heading">Two</b></a>"""
    rows = page_lists.cards(_page(spark, html), "id", "html", "markets", "https://h.example", now()).orderBy("row").collect()
    assert [(r.title, r.url, r.category) for r in rows] == [("One", "https://h.example/m/1", "markets"), ("Two", "https://h.example/m/2", "markets")]
    html = """<div data-testid="MediaStoryCard"><h3 data-testid="Heading"><a href="/b/1">One</a></h3></div><div data-testid="MediaStoryCard"><a data-testid="Heading" href="https://h.example/b/2">Two</a><a href=/x>x</a></div>"""
    rows = page_lists.cards(_page(spark, html), "id", "html", "business", "https://h.example", now()).orderBy("row").collect()
    assert [(r.title, r.url) for r in rows] == [("One", "https://h.example/b/1"), ("Two", "https://h.example/b/2")]


def test_report_items_and_links(spark):
    html = "<a class=r href='1'>One <b>b</b><i href='x.html'></i><i href='/f.PDF?v'></i></a><a class=r href='2.pdf'>Two</a><a class=r>no</a><a class=r href=3></a><a class=r href=1>Dup</a>"
    rows = page_lists.report_items(_page(spark, html), "id", "html", "base", "a.r", ("t",), now(), pdf="i").orderBy("row").collect()
    assert [(r.title, r.url, r.pdf_url, r.tags) for r in rows] == [
        ("One", "https://h.example/a/1", "https://h.example/f.PDF?v", ["t"]), ("Two", "https://h.example/a/2.pdf", "https://h.example/a/2.pdf", ["t"]), ("Dup", "https://h.example/a/1", None, ["t"])
    ]
    found = page_lists.links(_page(spark, html), "id", "html", "base", "a.r").orderBy("row").collect()
    assert [r.url.rpartition("/")[2] for r in found] == ["1", "2.pdf", "3", "1"]


def test_converted_cells(spark):
    df = spark.sql("SELECT array(named_struct('row','1','col','2','text',null,'rowspan','0','colspan','x'), named_struct('row','a','col','2','text','t','rowspan','1','colspan','1')) AS c UNION ALL SELECT array()")
    found = [tuple(map(tuple, r[0])) for r in df.select(converted_cells("c")).collect()]
    assert found == [((1, 2, "", 1, 1),), ((0, 0, "", 1, 1),)]


@pytest.mark.parametrize("text", ["a < b & c", "<b>"])
def test_entities(text):
    assert table_cells(f"<table><tr><td>{escape(text)}</table>")[0][3] == text


def test_cells_left_open_and_tags_asked_for(spark):
    """A cell that a group keeps open ends with the next cell; tags not asked for are not told but still end others."""
    html = "<table><td>a<tfoot><tr><td>b<i>c</i><td>d &amp; e"
    assert [(c[1], c[2], c[3]) for c in table_cells(html)] == [(0, 0, "a"), (1, 0, "bc"), (1, 1, "d & e")]
    assert page_tables(spark.createDataFrame([(1, html)], "id int, html string"), "id", "html").count() == 3
    told = frozenset(("td", "p"))
    for page in (html, "<p>x<div>y<p title='a long attribute of over thirty-two characters'>z</div></p>", "<script><p></script><p>"):
        assert list(events(page, told)) == [e for e in events(page) if e[0] == TEXT or e[1] in told]
