"""The tree built from a page: quick reading against the general parser, and its rules."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeweave.operators.html_nodes import _Columns, _PageReader, _Wanted, html_nodes
from citeweave.operators.selectors import (
    classes,
    first_node,
    has_id,
    page_nodes,
    page_texts,
    raw_text,
    spaced_text,
    tight_text,
    word_text,
)
from citeweave.schemas import PAGES

# Markup pieces, regular and odd, that pages are put together from.
PIECES = [
    "<div>", "</div>", '<p class="a  b">', "<a href='x&amp;y'>", "</a>", "<br>", "<br/>", "<br />", "text", " ", "\n",
    " \n ", "&amp;", "&lt;", "&nbsp;", "&foo;", "&#65;", "&#x41;", "& ", "&", "&am", "AT&T", "<", "a < b", "<!-- c -->",
    "<!---->", "<!-->", "<!--a--b-->", "<!DOCTYPE html>", "<![CDATA[x]]>", "<?pi x>",
    '<script>var t="</p>"; a<b && c</script>', "<script>", "</script>", "<style>p{}</style>", "<title>T &amp; x</title>",
    "<title>plain</title>", "<title><b>x</b></title>", "<textarea> \n </textarea>", "<pre> \n </pre>", "<pre>", "</pre>",
    "<input disabled>", "<input disabled/>", "<a b=c>", "<a b=c/>", '<a b="1"c="2">', '<A HREF="u">', "</A >", "</ a>",
    "<a-b>", "</a-b>", "<template>t</template>", "<noscript><img src=x></noscript>", '<a b = "c">',
    '<a href="?a=1&b=2&copy=3">', '<a href="<>">', '<div id="q" class="">', "<li/>", "</br>", '<a b="x">', "&#0;",
    "&#150;", "&#xD800;", "&#x110000;", "<td class='z' x>", '<a "b">', "<!x>", "</>", '<a\nb="c"\n>',
    '<script src="x"/>', "<script><!-- </script> --></script>", "</script x>", '<b é="1">', "\xa0", "é",
]


def read(html, quick=True, within=None):
    columns = _Columns()
    reader = _PageReader(columns, _Wanted(within))
    if not quick:
        reader._read_plain = lambda text: 0
    try:
        reader.read(html)
    except AssertionError as rejected:
        return type(rejected)
    return columns.nodes, columns.texts


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_quick_reading_equals_the_general_parser(html):
    assert read(html) == read(html, quick=False)


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_within_keeps_whole_subtrees(html):
    """Left-out nodes take nothing away from the kept ones."""
    whole, part = read(html), read(html, within=("a", "#q", ".b"))
    if whole is AssertionError:
        assert part is AssertionError
        return
    nodes, texts = whole
    roots = [n for n in nodes if n[3] == "a" or n[4] == "q" or (n[5] and " b " in n[5])]
    ids = sorted({i for n in roots for i in range(n[0], n[1] + 1)})
    kept, kept_texts = part
    assert [nodes[i][3:8] for i in ids] == [n[3:8] for n in kept]
    assert [texts[nodes[i][8]:nodes[i][9]] for i in ids] == [kept_texts[n[8]:n[9]] for n in kept]


def tags(html):
    return [(n[3], n[0], n[1], n[2]) for n in read(html)[0]]


def test_tree_rules():
    # An end tag closes the nearest open match and everything inside it.
    assert tags("<p><b>x<p>y</p>z</p>w") == [("p", 0, 2, -1), ("b", 1, 2, 0), ("p", 2, 2, 1)]
    # Unmatched end tags are ignored; void and self-closed elements hold nothing.
    assert tags("</i><div>a<br>b<i/>c</div>") == [("div", 0, 2, -1), ("br", 1, 1, 0), ("i", 2, 2, 0)]


def test_own_string():
    def own(html):
        return read(html)[0][0][7]

    assert own("<a>x</a>") == "x"
    assert own("<a><b>x</b></a>") == "x"
    assert own("<a>x<br></a>") is None
    assert own("<a>x<!-- c --></a>") is None
    assert own("<a> x&amp;y </a>") == " x&y "
    assert own("<a></a>") is None


def test_silent_and_blank_text():
    assert read("<p>a<script>s</script><style>t</style> \n <b>c</b> </p>")[1] == ["a", "\n", "c", " "]
    assert read("<pre> \n </pre>")[1] == [" \n "]


def test_text_modes_and_failures(spark):
    pages = [(1, "u", "<i id=x>a<b> b </b>c</i>"), (2, "u", "<i id=x>\xa0a <b></b>\tb</i>"), (3, "u", None), (4, "u", "")]
    parsed = html_nodes(spark.createDataFrame(pages, PAGES))
    n = first_node(page_nodes(), has_id("x"))
    texts = page_texts()
    found = parsed.select(
        "page_id", "parse_ok", raw_text(texts, n), tight_text(texts, n), spaced_text(texts, n), word_text(texts, n),
        F.size("nodes"),
    ).orderBy("page_id").collect()
    assert [tuple(r) for r in found] == [
        (1, True, "a b c", "abc", "a  b  c", "a b c", 2),
        (2, True, "\xa0a \tb", "ab", "a  \tb", "a b", 2),
        (3, False, None, None, None, None, None),
        (4, True, None, None, None, None, 0),
    ]


def test_rejected_page_leaves_the_others_alone(spark):
    pages = spark.createDataFrame(
        [(i, "u", f'<p id="x" class=" k  l{i} ">{i}</p>' + "<![foo[" * (i % 3 == 0)) for i in range(30)], PAGES
    ).coalesce(1)
    parsed = html_nodes(pages).orderBy("page_id")
    n = first_node(page_nodes(), has_id("x"))
    found = parsed.select("page_id", "parse_ok", raw_text(page_texts(), n).alias("t"), classes(n).alias("c")).collect()
    for row in found:
        if row.parse_ok:
            assert (row.t, row.c) == (str(row.page_id), ["k", f"l{row.page_id}"])
        else:
            assert row.page_id % 3 == 0 and row.t is None
    assert any(not r.parse_ok for r in found)


@pytest.mark.parametrize("size", [1, 5000])
def test_pages_in_many_output_batches(spark, size, monkeypatch):
    """Batches are cut by size; every page comes out once, with its own nodes."""
    body = "<b>" + "x" * size + "</b>"
    pages = spark.range(600).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit(body), F.lit("<i>"), "id", F.lit("</i>")).alias("html")
    ).coalesce(1)
    found = html_nodes(pages).select("page_id", F.element_at("nodes.own_string", -1).alias("own")).collect()
    assert sorted((r.page_id, r.own) for r in found) == [(i, str(i)) for i in range(600)]


def test_pages_without_signs_are_not_parsed_but_lose_nothing(spark):
    """However a class or id is spelled, skipping pages by their source text changes no result."""
    bodies = [
        '<p class="want">1</p>', "<p class=want>2</p>", '<p CLASS = "a want b">3</p>', '<p class="wa&#110;t">4</p>',
        "<p class='x&#32;want'>5</p>", "<p class=&#119;ant>6</p>", '<p id="box">7</p>', '<p id="b&#111;x">8</p>',
        "<p class=other>9</p>", "", None, "<p>a<![foo[ b</p>", '<a href="?a&b">x</a>', '<p title="want">y</p>',
        '<p class=="wa&#110;t">z</p>', "<p class=w&#97;nt>", '<p x="1"class="w&#97;nt">q</p>', "<p/class=w&#97;nt>r</p>",
    ]
    pages = spark.createDataFrame([(i, "u", b) for i, b in enumerate(bodies)], PAGES)
    skipped, whole = (
        html_nodes(pages, within=(".want", "#box"), signs=signs).orderBy("page_id").collect() for signs in (None, ("",))
    )
    assert skipped == whole
    assert sum(bool(r.nodes) for r in whole) >= 11
