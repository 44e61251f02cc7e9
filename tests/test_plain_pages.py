"""Plain pages read many at a time, against the reader of single pages."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeweave.operators import html_nodes as module
from citeweave.operators.html_nodes import _Columns, _read_page, _read_pages, _Wanted
from citeweave.operators.plain_pages import read_plain

from .test_html_nodes import PIECES

# What nested pages are put together from; each leaves a page plain.
ATTRS = ["", ' id="q"', " class='b c'", ' class="b" href="x&amp;y"', ' HREF="u" href="v"', " x", " id=q", " data-x=\"'\"", ' a="1" b', ' b="&nbsp;"']
LEAVES = [
    "text", " ", " \n ", "&amp;", "&nbsp;", "&foo;", "&#1;", " & ", "a > b", "<br>", "<i/>", '<img src="a" />', "<!-- <b> & -->", "<!--x-->",
    "<!DOCTYPE html>", "<script>a<b>&&</script>", '<SCRIPT src="x">\n</SCRIPT>', "<style></style>", "<title>T</title>", "<script/>",
]
ELEMENT = st.tuples(st.sampled_from(["a", "b", "div", "P"]), st.sampled_from(ATTRS))
NESTED = st.recursive(
    st.sampled_from(LEAVES),
    lambda inner: st.tuples(ELEMENT, st.lists(inner, max_size=4)).map(lambda e: f"<{e[0][0]}{e[0][1]}>{''.join(e[1])}</{e[0][0].lower()}>"),
)
WANTED = st.sampled_from([(None, None), (("a", "#q", ".b"), ("href",)), ((".b",), ()), (("script", "br"), None)])


def one_by_one(bodies, wanted):
    columns = _Columns()
    for body in bodies:
        _read_page(columns, body, wanted)
    return [column.to_pylist() for column in columns.to_arrow()]


def together(bodies, wanted):
    columns = _read_pages(pa.array(bodies, pa.string()), wanted)
    for column in columns:
        column.validate(full=True)
    return [column.to_pylist() for column in columns]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(NESTED, max_size=4).map("".join), min_size=1, max_size=8), WANTED)
def test_nested_pages(bodies, wanted):
    assert read_plain(pa.array(bodies), _Wanted(*wanted))[2].all()
    assert together(bodies, _Wanted(*wanted)) == one_by_one(bodies, _Wanted(*wanted))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(PIECES + LEAVES), max_size=10).map("".join), min_size=1, max_size=8), WANTED)
def test_odd_pages_among_plain_ones(bodies, wanted):
    assert together(bodies, _Wanted(*wanted)) == one_by_one(bodies, _Wanted(*wanted))


@pytest.mark.parametrize("mark", ["\ue000", "\ue001", "\ue002"])
def test_pages_that_hold_the_marks_of_hidden_code(mark):
    bodies = [f"<p>{mark}<script>a<b</script></p>", "<p>x</p>"]
    assert together(bodies, _Wanted()) == one_by_one(bodies, _Wanted())


def test_plain_pages_take_no_step_of_their_own(monkeypatch):
    """The reader of single pages sees the odd page alone."""
    seen = []
    real = module._read_page
    monkeypatch.setattr(module, "_read_page", lambda columns, html, wanted: (seen.append(html), real(columns, html, wanted)))
    bodies = [f'<html><body><p class="b">{i} &amp; co</p><br></body></html>' for i in range(50)] + ["<p>never closed"]
    assert together(bodies, _Wanted((".b",), ()))[2] == [True] * 51
    assert seen == ["<p>never closed"]


def test_odd_batches_are_not_tried_each_time(monkeypatch):
    tried = []
    real = module.read_plain
    monkeypatch.setattr(module, "read_plain", lambda html, wanted: (tried.append(len(html)), real(html, wanted))[1])
    wanted = _Wanted()
    for _ in range(17):
        assert together(["<p>a", "<p>b"], wanted)[2] == [True, True]
    assert len(tried) == 2


def test_links_read_apart_from_their_tags():
    """The value of a link is put back where the page reader has it, whatever else the tag holds."""
    from citeweave.operators.plain_pages import _apart

    tags = [
        '<a href="/1">', '<a class="c" href="/2" rel="r">', '<A HREF="/3">', "<a href='/4'>", '<a href="/5" href="/6">', '<a href="/7" href=bare>',
        '<a title=" href=" class="x">', '<a title="see href=" href="/8">', '<a href="a&amp;b&lt;c">', '<a href="">', '<a href>', '<a data-href="/9">',
        '<a\nhref="/10"\t>', '<a href="/11"/>', '<link href="/12">', '<a title="it\'s" href="/13">', '<a href="é &x">', '<!-- <a href="/14"> -->',
    ]
    body = "".join(f"{t}x{'</a>' if t[1] in 'aA' and t[-2] != '/' else ''}" for t in tags)
    for within, attrs in ((None, None), (None, ("href",)), (("a",), ("class", "href")), ((".c",), ())):
        wanted = _Wanted(within, attrs)
        nodes, texts, plain = read_plain(pa.array([body, "", body]), wanted)
        assert plain.all()
        columns = _Columns()
        _read_page(columns, body, wanted)
        (expected,), (text,), _ = (c.to_pylist() for c in columns.to_arrow())
        found = [[e | {"attrs": dict(e["attrs"] or ())} for e in page] for page in nodes.to_pylist()]
        expected = [e | {"attrs": dict(e["attrs"] or ())} for e in expected]
        assert found == [expected, [], expected] and texts.to_pylist() == [text, [], text]
    assert len(_apart(pa.array([f'a href="/{i}"' for i in range(9)]))[0].unique()) == 1
