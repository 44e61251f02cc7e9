"""Pages of plain markup to nodes, many at a time: Arrow and numpy work on all tags of a batch at once.

Plain is a page whose tags are whole, known by the quick reader and closed in the order they were opened; every other
one is told apart and left to the reader of single pages in `html_nodes`. Both give the same nodes and texts.
"""

from __future__ import annotations

import re
import sys
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# The parsing code travels inside the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of tokens: tags, a comment or declaration, the start of a page, and whatever is not plain.
OPEN, EMPTY, CLOSE, OTHER, TOP, ODD = range(6)

# Content in which `<`, `>` and `&` are no markup: code and comments. They are exchanged for marks that no plain page holds.
_MARKS = "\ue000\ue001\ue002"
_HIDE, _SHOW = str.maketrans("<>&", _MARKS), str.maketrans(_MARKS, "<>&")
_HIDDEN = re.compile(
    r"<(?:((?i:(script|style))(?:[ \t\r\n\f][^<>]*)?(?<!/)>)([^<]*(?:<(?!(?i:/\2)|!--)[^<]*)*)"
    r"|(!--)([^-]*(?:-(?!->)[^-]*)*)(?=-->))"
)
_MAY_HIDE = r"(?i)<(?:script|style|!--)|[\x{E000}-\x{E002}]"


# A start tag, without single quotes, that may have a link in double ones; and what is before the value then.
_MAY_LINK = r"""^[a-zA-Z][^']*[ \t\r\n\f]href="[^']*$"""
_LINK_NAME = r"[ \t\r\n\f]href=$"


def _hide(html):
    """Hide the marks of code and comments; None if the page holds what stands for them."""
    if any(mark in html for mark in _MARKS):
        return None
    return _HIDDEN.sub(lambda m: f"<{m[1] or m[4]}{(m[3] or m[5] or '').translate(_HIDE)}", html)


def show(text):
    return text.translate(_SHOW)


def _replaced(strings, where, values):
    return pc.replace_with_mask(strings, pa.array(where), pa.array(values, pa.string()))


def _per_page(page, found, pages):
    odd = np.zeros(pages, bool)
    odd[page[found]] = True
    return odd


def _apart(sources):
    """`(sources, link, links)`: start tags without the value of their `href`, which of `links` it is (-1: kept), and the values.

    Links differ from tag to tag and little else does, so few different tags are left to be read.
    """
    link = np.full(len(sources), -1)
    at = np.flatnonzero(pc.match_substring_regex(sources, _MAY_LINK))
    # Of several the last one would count.
    at = at[np.asarray(pc.count_substring(sources.take(pa.array(at)), "href", ignore_case=True)) == 1]
    pieces = pc.split_pattern(sources.take(pa.array(at)), '"')
    first, pieces = np.asarray(pieces.offsets), pieces.values
    count = np.diff(first)
    row = np.repeat(np.arange(len(at)), count)
    nth = np.arange(len(pieces)) - first[row]
    # Every second piece is a quoted value; a name has one behind it.
    names = (nth % 2 == 0) & (nth < count[row] - 1) & np.asarray(pc.match_substring_regex(pieces, _LINK_NAME))
    whole = (np.bincount(row[names], minlength=len(at)) == 1) & (count % 2 == 1)
    values = np.r_[False, (names & whole[row])[:-1]] if len(pieces) else names
    links = pieces.filter(pa.array(values))
    left = pa.ListArray.from_arrays(pa.array(first, pa.int32()), _replaced(pieces, values, [""] * len(links)))
    at = at[whole]
    link[at] = np.arange(len(at))
    return _replaced(sources, link >= 0, pc.binary_join(left, '"').filter(pa.array(whole))), link, links


class _Tokens:
    """All tags of some pages, each with the text after it; a page begins with a token of its own."""

    def __init__(self, html, wanted):
        self.pages = pages = len(html)
        failed = np.zeros(pages, bool)
        hides = np.asarray(pc.match_substring_regex(html, _MAY_HIDE))
        if hides.any():
            bodies = [_hide(body) for body in html.filter(pa.array(hides)).to_pylist()]
            failed[np.flatnonzero(hides)] = [body is None for body in bodies]
            html = _replaced(html, hides, [body or "" for body in bodies])
        parts = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(">"), html, ""), "<")
        self.first = np.asarray(parts.offsets)
        halves = pc.split_pattern(parts.values, ">", max_splits=1)
        at = np.asarray(halves.offsets)
        whole = np.diff(at) == 2
        self.page = np.repeat(np.arange(pages), np.diff(self.first))
        sources, self.link, self.links = _apart(halves.values.take(pa.array(at[:-1])))
        sources = sources.dictionary_encode()
        self.texts = halves.values.take(pa.array(at[:-1] + whole))
        self.code = np.asarray(sources.indices)
        self.known = [wanted.token(source) for source in sources.dictionary.to_pylist()]
        self.kind = np.array([k[0] for k in self.known], np.int8)[self.code]
        self.kind[self.first[:-1]] = TOP
        names = {}
        self.tag = np.array([names.setdefault(k[1], len(names)) for k in self.known])[self.code]
        self.odd = failed | _per_page(self.page, ~whole | (self.kind == ODD), pages)
        self.has_text = np.asarray(pc.binary_length(self.texts)) > 0
        self._raw_content(hides.any())
        self._decode(wanted)
        self._nest()

    def _raw_content(self, hidden):
        """An element whose content is no ordinary markup must hold one text, which in code stands for itself."""
        raw = np.array([k[6] for k in self.known], np.int8)[self.code]
        raw[self.first[:-1]] = 0
        at = np.flatnonzero(raw)
        after = np.minimum(at + 1, len(raw) - 1)
        closed = (self.kind[after] == CLOSE) & (self.tag[after] == self.tag[at]) & (self.page[after] == self.page[at])
        self.odd |= _per_page(self.page, at[~closed], self.pages)
        self.silent = raw == 2
        refers = np.asarray(pc.match_substring(self.texts, "&"))
        self.odd |= _per_page(self.page, (raw == 1) & refers, self.pages)
        self.refers = refers & ~self.silent
        if hidden and self.silent.any():
            shown = [show(text) for text in self.texts.filter(pa.array(self.silent)).to_pylist()]
            self.texts = _replaced(self.texts, self.silent, shown)

    def _decode(self, wanted):
        """Character references, then blank texts as one character."""
        if self.refers.any():
            found = self.texts.filter(pa.array(self.refers)).dictionary_encode()
            decoded = [wanted.decode(text) for text in found.dictionary.to_pylist()]
            bad = np.array([text is None for text in decoded])[np.asarray(found.indices)]
            self.odd |= _per_page(self.page, np.flatnonzero(self.refers)[bad], self.pages)
            self.texts = _replaced(self.texts, self.refers, pa.array(decoded, pa.string()).take(found.indices).fill_null(""))
        left = np.asarray(pc.binary_length(pc.ascii_trim(self.texts, characters=" \n\t\f\r")))
        blank = self.has_text & (left == 0)
        if blank.any():
            lines = np.asarray(pc.match_substring(self.texts.filter(pa.array(blank)), "\n"))
            self.texts = _replaced(self.texts, blank, pa.array(["\n", " "]).take(pa.array(np.where(lines, 0, 1))))

    def _nest(self):
        """Which tag closes which; `depth` is the number of open elements after a token."""
        kind, page = self.kind, self.page
        depth = np.cumsum((kind == OPEN).astype(np.int64) - (kind == CLOSE))
        self.depth = depth = depth - depth[self.first[:-1]][page]
        self.odd |= _per_page(page, depth < 0, self.pages) | (depth[self.first[1:] - 1] != 0)
        pairs = np.flatnonzero(((kind == OPEN) | (kind == CLOSE)) & ~self.odd[page])
        levels = int(depth.max(initial=0)) + 2
        level = page[pairs] * levels + depth[pairs] + (kind[pairs] == CLOSE)
        pairs = pairs[np.argsort(level, kind="stable")]
        self.opens, self.closes, self.levels = pairs[0::2], pairs[1::2], levels
        unlike = self.tag[self.opens] != self.tag[self.closes]
        self.odd |= _per_page(page, self.opens[unlike], self.pages)


def read_plain(html, wanted):
    """`(nodes, texts, plain)`: list arrays of the plain ones of some pages, in their order, and which these are."""
    tokens = _Tokens(html, wanted)
    plain = ~tokens.odd
    if not plain.all():
        if not plain.any():
            return None, None, plain
        tokens = _Tokens(html.filter(pa.array(plain)), wanted)
    nodes, texts = _tree(tokens, wanted)
    return nodes, texts, plain


def _tree(t, wanted):
    kind, size = t.kind, len(t.kind)
    is_element = (kind == OPEN) | (kind == EMPTY)
    at = np.flatnonzero(is_element)
    elements_until = np.cumsum(is_element)
    close = np.arange(size)
    close[t.opens] = t.closes
    close = close[at]

    # The element that is open after a token: the last one opened at that depth.
    inner, below = np.full(size, -1), np.flatnonzero(t.depth)
    place = (t.page * t.levels + t.depth) * size + np.arange(size)
    inner[below] = elements_until[t.opens[np.searchsorted(place[t.opens], place[below], side="right") - 1]] - 1
    parent = inner[at - 1]

    # What is kept: wanted elements and all inside them.
    text_kept = t.has_text & ~t.silent
    if wanted.everything:
        kept = np.ones(len(at), bool)
    else:
        chosen = np.array([k[5] for k in t.known], bool)[t.code[at]]
        step = np.zeros(size, np.int64)
        np.add.at(step, at[chosen], 1)
        np.add.at(step, close[chosen], -1)
        covered = np.cumsum(step) > 0
        kept, text_kept = chosen | covered[at - 1], text_kept & covered
    nodes_until = np.zeros(size, np.int64)
    nodes_until[at] = kept
    nodes_until, texts_until = np.cumsum(nodes_until), np.cumsum(text_kept)

    top = t.first[:-1][t.page[at]]
    nodes_before, texts_before = nodes_until[top], texts_until[top] - text_kept[top]
    # Elements left out have negative numbers, which tell siblings among them.
    left_out = elements_until[at] - nodes_until[at] - elements_until[top] + nodes_before
    number = np.where(kept, nodes_until[at] - 1 - nodes_before, -1 - left_out)
    above = np.where(parent >= 0, number[parent], -1)
    numbers = (number, nodes_until[close] - 1 - nodes_before, above, texts_until[at - 1] - texts_before, texts_until[close - 1] - texts_before)
    numbers = [pa.array(x[kept].astype(np.int32)) for x in numbers]

    codes = pa.array(t.code[at][kept])
    tags, ids, classes = (pa.array([k[i] for k in t.known], pa.string()).take(codes) for i in (1, 3, 4))
    strings, own = _own_strings(t, inner, parent)
    own = strings.take(pa.array(own[kept], mask=own[kept] < 0))
    attrs = _linked(_attributes([k[2] for k in t.known]).take(codes), t, at[kept], wanted)
    node = pa.StructArray.from_arrays([*numbers[:3], tags, ids, classes, attrs, own, *numbers[3:]], names=wanted.fields)
    ends = t.first[1:] - 1
    return (
        pa.ListArray.from_arrays(pa.array(np.r_[0, nodes_until[ends]].astype(np.int32)), node),
        pa.ListArray.from_arrays(pa.array(np.r_[0, texts_until[ends]].astype(np.int32)), t.texts.filter(pa.array(text_kept))),
    )


def _own_strings(t, inner, parent):
    """Strings, and for each element which one is its only content, at whatever depth; -1 for none."""
    elements, strings = len(parent), t.texts
    other = np.flatnonzero((t.kind == OTHER) & (inner >= 0))
    in_text, in_element = inner[t.has_text], parent >= 0
    children = np.bincount(in_text[in_text >= 0], minlength=elements)
    children += np.bincount(parent[in_element], minlength=elements) + np.bincount(inner[other], minlength=elements)
    own, only = np.full(elements, -1), np.arange(elements)
    held = np.flatnonzero(t.has_text & (inner >= 0))
    own[inner[held]] = held
    if len(other):
        own[inner[other]] = len(strings) + np.arange(len(other))
        strings = pa.concat_arrays([strings, pa.array([t.known[c][7] for c in t.code[other]], pa.string())])
    own[children != 1] = -1
    lone = np.flatnonzero(in_element)
    lone = lone[children[parent[lone]] == 1]
    only[parent[lone]] = lone
    while not np.array_equal(further := only[only], only):
        only = further
    return strings, own[only]


def _linked(attrs, t, tokens, wanted):
    """Attributes of some tokens with the links that were kept apart put back."""
    place = np.array([list(k[2]).index("href") if "href" in k[2] else -1 for k in t.known])[t.code[tokens]]
    link = t.link[tokens]
    at = np.flatnonzero((place >= 0) & (link >= 0))
    links = t.links.take(pa.array(link[at]))
    refers = np.asarray(pc.match_substring(links, "&"))
    if refers.any():
        links = _replaced(links, refers, [wanted.unescaped(value) for value in links.filter(pa.array(refers)).to_pylist()])
    values = np.zeros(len(attrs.items), bool)
    values[np.asarray(attrs.offsets)[at] + place[at]] = True
    return pa.MapArray.from_arrays(attrs.offsets, attrs.keys, _replaced(attrs.items, values, links), mask=attrs.is_null())


def _attributes(kept):
    return pa.MapArray.from_arrays(
        pa.array([0, *accumulate(map(len, kept))], pa.int32()),
        pa.array([name for a in kept for name in a], pa.string()),
        pa.array([value for a in kept for value in a.values()], pa.string()),
        mask=pa.array([not a for a in kept], pa.bool_()),
    )
