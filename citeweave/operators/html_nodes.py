"""Stored HTML to one array of nodes per page: the only Python step of the engine.

`html_nodes` is a narrow `mapInArrow`: no shuffle, one row out per row in. Each
page becomes

* `nodes`: its elements in document order, each with the index of its last
  descendant (`end`), so "inside n" is a slice of the array; `parent` is the
  parent's index, or a negative number shared by siblings only if `within` left
  the parent out;
* `texts`: its text runs in document order; an element owns the slice
  `text_from .. text_to`, so no text is repeated per ancestor;
* `parse_ok`: false when the page is missing or cannot be parsed.

Catalyst neither filters nor prunes through a Python step, so callers drop
rows and columns *before* it, and name what they need: `within` keeps only the
subtrees rooted at those tags, `#ids` or `.classes`; `attrs` keeps only those attributes.
"""

from __future__ import annotations

import html as entities
import re
import sys
from functools import reduce
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NODE
from .plain_pages import CLOSE, EMPTY, ODD, OPEN, OTHER, read_plain, show

# The parsing code travels inside the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never have content.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex"
    " keygen link menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose text is not part of the page's text.
SILENT_TAGS = frozenset("rp rt script style template".split())
# Elements whose blank text runs are kept as they are.
VERBATIM_TAGS = frozenset("pre textarea".split())
_TEXT_TAGS = SILENT_TAGS | VERBATIM_TAGS
ASCII_BLANK = " \n\t\f\r"

OUTPUT_BYTES = 1 << 20  # HTML bytes per Arrow batch handed back to the JVM

# Plain markup, read token by token without the general parser.
_SPACE = r"[ \t\r\n\f]"
_NAME = r"[a-zA-Z][a-zA-Z0-9_:-]*"
_WORD = r"[a-zA-Z_][a-zA-Z0-9_:.-]*"
_BARE = r"""[^ \t\r\n\f"'=<>`/]+(?=[ \t\r\n\f>]|\Z)"""
_ATTR = rf"""{_WORD}(?:=(?:"[^"]*"|'[^']*'|{_BARE}))?"""
_ATTRS = re.compile(rf"""({_WORD})(?:=(?:"([^"]*)"|'([^']*)'|({_BARE})))?""")
_TEXT_AND_TAG = re.compile(
    rf"([^<&]*)<(?:/({_NAME}){_SPACE}*|({_NAME})((?:{_SPACE}+{_ATTR})*){_SPACE}*(/?))>"
)
# Text and a tag's source text, of tags that were read before; others take the expression above.
_TEXT_AND_SOURCE = re.compile(r"([^<&]*)<([^<>]*)>")
# The same tags, comments and declarations by themselves, without what is around them.
_TAG = re.compile(rf"/({_NAME}){_SPACE}*|({_NAME})((?:{_SPACE}+{_ATTR})*){_SPACE}*(/?)")
_NO_TAG = re.compile(r"!--((?![>-])[^-]*(?:-[^-]+)*)--|!([dD][oO][cC][tT][yY][pP][eE][^<>\[\]]*)")
_REFERENCE = re.compile(r"&(?:([a-zA-Z][a-zA-Z0-9]*);|#([0-9]+|[xX][0-9a-fA-F]+);|(?=[ \t\r\n\f])|())")
_OTHER = re.compile(
    r"(?P<text>[^<&]+)"
    r"|&(?P<named>[a-zA-Z][a-zA-Z0-9]*);|&#(?P<number>[0-9]+|[xX][0-9a-fA-F]+);|(?P<amp>&)(?=[ \t\r\n\f])"
    r"|<!--(?![>-])(?P<comment>[^-]*(?:-[^-]+)*)-->"
    r"|<!(?P<doctype>[dD][oO][cC][tT][yY][pP][eE][^<>\[\]]*)>"
)
# Elements whose content is not ordinary markup for some parser version.
RAW_TAGS = frozenset(
    "iframe noembed noframes noscript plaintext script style textarea title xmp".split()
)
_CODE_END = {tag: re.compile(f"</{tag}|<!--", re.IGNORECASE) for tag in ("script", "style")}
_END_TAG = re.compile(rf"</({_NAME}){_SPACE}*>")


def _raw_content(tag, html, at):
    """`(content, end)` of an element of RAW_TAGS whose content is plain text or code, else None."""
    if tag in _CODE_END:
        found = _CODE_END[tag].search(html, at)
        close = found.start() if found else -1
    else:
        close = html.find("<", at)
    end = _END_TAG.match(html, close) if close >= 0 else None
    if end is None or end[1].lower() != tag:
        return None
    content = html[at:close]
    return None if "&" in content and tag not in _CODE_END else (content, end.end())


def _unescaped(value):
    """An attribute's value with its references read; most hold no other than `&amp;`."""
    marks = value.count("&")
    if not marks:
        return value
    return value.replace("&amp;", "&") if marks == value.count("&amp;") else entities.unescape(value)


def _decoded(found):
    if found[3] is not None:
        raise ValueError(found.string)
    return html5.get(found[1] + ";", "&" + found[1]) if found[1] else entities.unescape(found[0])


class _Wanted:
    """Which subtrees and attributes of a page are kept; `None` is all of them."""

    NOTHING = ({}, None, None, False)
    NOT_PLAIN = (ODD, None, {}, None, None, False, 0, None)
    fields = NODE.fieldNames()

    def __init__(self, within=None, attrs=None):
        self.everything = within is None
        within = within or ()
        self.tags = frozenset(w for w in within if w[0] not in "#.")
        self.ids = frozenset(w[1:] for w in within if w[0] == "#")
        self.classes = frozenset(w[1:] for w in within if w[0] == ".")
        self.attrs = None if attrs is None else tuple(attrs)
        self.known, self.tokens, self.plain, self.shapes = {}, {}, {}, {}
        self.skip = 0  # batches to read page by page

    def describe(self, attrs):
        """`(kept attributes, id, padded class attribute, whether the element is wanted)`."""
        elem_id, tokens = attrs.get("id"), attrs.get("class", "").split()
        wanted = elem_id in self.ids or not self.classes.isdisjoint(tokens)
        kept = attrs if self.attrs is None else {name: attrs[name] for name in self.attrs if name in attrs}
        return kept, elem_id, f" {' '.join(tokens)} " if tokens else None, wanted

    def describe_text(self, text):
        """The same for a tag's source text; tags repeat, so short texts are remembered."""
        found = self.known.get(text)
        if found is None:
            values = {name.lower(): a or b or c for name, a, b, c in _ATTRS.findall(text)}
            if "&" in text:
                values = {name: _unescaped(value) for name, value in values.items()}
            found = self.describe(values)
            if len(text) < 100:
                if len(self.known) >= 10_000:
                    self.known.clear()
                self.known[text] = found
        return found

    def remember(self, source, token):
        """Keep what a tag's source text says: `(tag, found, empty)`, `found` being None for an end tag."""
        if len(source) < 100:
            if len(self.tokens) >= 10_000:
                self.tokens.clear()
            self.tokens[source] = token

    # -- for `plain_pages` -------------------------------------------------------
    def token(self, source):
        """What stands between `<` and `>`: `(kind, tag, attributes, id, class, wanted, content, string)`.

        `content` is 1 for an element whose content is no ordinary markup, 2 for code; `string` is that of a comment.
        """
        found = self.plain.get(source)
        if found is None:
            found = self._read_token(source)
            if len(source) < 100:
                if len(self.plain) >= 10_000:
                    self.plain.clear()
                self.plain[source] = found
        return found

    def _read_token(self, source):
        # Many tags differ in quoted values only, which may hold anything.
        pieces = source.split('"')
        shape = "" if "'" in source else '""'.join(pieces[::2])
        if len(self.shapes) >= 10_000:
            self.shapes.clear()
        if shape not in self.shapes:
            self.shapes[shape] = self._read_shape(shape)
        known = self.shapes[shape]
        if known is None or len(pieces) % 2 == 0:
            return self._read_whole(source)
        kind, tag, names, content = known
        values = dict(zip(names, pieces[1::2]))
        if "&" in source:
            values = {name: _unescaped(value) for name, value in values.items()}
        kept, elem_id, class_raw, chosen = self.describe(values)
        return kind, tag, kept, elem_id, class_raw, chosen or tag in self.tags, content, None

    def _read_shape(self, shape):
        """`(kind, tag, names, content)` of a start tag all of whose attributes have values in double quotes, else None."""
        found = _TAG.fullmatch(shape)
        if found is None or not found[3]:
            return None
        kind, tag, *_, content, _ = self._read_whole(shape)
        names = [name.lower() for name, *_ in _ATTRS.findall(found[3])]
        return None if kind == ODD or len(names) != shape.count('""') else (kind, tag, names, content)

    def _read_whole(self, source):
        found = _TAG.fullmatch(source)
        if found is None:
            found = _NO_TAG.fullmatch(show(source))
            if found is None:
                return self.NOT_PLAIN
            return (OTHER, *self.NOT_PLAIN[1:7], found[1] if found[2] is None else found[2])
        end, tag, attrs, empty = found.groups()
        if end is not None:
            return (CLOSE, end.lower(), *self.NOT_PLAIN[2:])
        tag = tag.lower()
        if tag in _TEXT_TAGS and tag not in _CODE_END:
            return self.NOT_PLAIN
        kept, elem_id, class_raw, chosen = self.describe_text(attrs) if attrs else self.NOTHING
        content = (2 if tag in _CODE_END else 1) if tag in RAW_TAGS and not empty else 0
        kind = EMPTY if empty or tag in VOID_TAGS else OPEN
        return kind, tag, kept, elem_id, class_raw, chosen or tag in self.tags, content, None

    unescaped = staticmethod(_unescaped)

    @staticmethod
    def decode(text):
        """A text with its character references read; None if one is not plain."""
        try:
            return _REFERENCE.sub(_decoded, text)
        except ValueError:
            return None


class _Columns:
    """Nodes and texts of the pages of one output batch."""

    def __init__(self):
        self.nodes, self.texts, self.ok = [], [], []
        self.node_offsets, self.text_offsets = [0], [0]

    def cut_back(self):
        """Forget the nodes of a page that failed half way."""
        del self.nodes[self.node_offsets[-1]:]
        del self.texts[self.text_offsets[-1]:]

    def close_page(self, ok):
        self.node_offsets.append(len(self.nodes))
        self.text_offsets.append(len(self.texts))
        self.ok.append(ok)

    def to_arrow(self):
        columns = list(zip(*self.nodes)) or [()] * len(NODE)
        attrs = columns[6]
        columns[6] = pa.MapArray.from_arrays(
            pa.array([0, *accumulate(map(len, attrs))], pa.int32()),
            pa.array([name for a in attrs for name in a], pa.string()),
            pa.array([value for a in attrs for value in a.values()], pa.string()),
            mask=pa.array([not a for a in attrs], pa.bool_()),
        )
        kinds = [pa.int32()] * 3 + [pa.string()] * 3 + [None, pa.string()] + [pa.int32()] * 2
        node = pa.StructArray.from_arrays(
            [c if kind is None else pa.array(c, kind) for c, kind in zip(columns, kinds)],
            names=NODE.fieldNames(),
        )
        failed = pa.array([not ok for ok in self.ok], pa.bool_())
        return [
            pa.ListArray.from_arrays(pa.array(self.node_offsets, pa.int32()), node, mask=failed),
            pa.ListArray.from_arrays(
                pa.array(self.text_offsets, pa.int32()), pa.array(self.texts, pa.string()), mask=failed
            ),
            pa.array(self.ok, pa.bool_()),
        ]


class _PageReader(HTMLParser):
    """Feeds one page's tags and text runs into the column buffers.

    Plain markup takes the quick way of `read`; from the first construct it
    does not know on, the general parser reads the rest. Both call the same handlers.
    """

    def __init__(self, columns, wanted):
        super().__init__(convert_charrefs=False)
        self.nodes, self.texts, self.wanted = columns.nodes, columns.texts, wanted
        self.first_node, self.first_text = len(self.nodes), len(self.texts)
        # Open elements: tag, row (None if not kept), number, children so far, sole string.
        self.stack = [[None, None, -1, 0, None]]
        self.open_tags = {}
        self.silent = self.verbatim = 0  # open SILENT_TAGS and VERBATIM_TAGS
        self.dropped = -1
        self.run = []

    def read(self, html):
        at = self._read_plain(html)
        if at < len(html):
            self.feed(html[at:])
            self.close()
        self._end_run()
        while len(self.stack) > 1:
            self._close()

    def _read_plain(self, html):
        """Read markup while it is plain; return where the rest starts.

        Tags repeat, within a page and among pages: one whose source text was read before is known by it. What
        holds neither `<` nor `>` and was a whole tag once is the same tag wherever it stands.
        """
        run, at, stack, texts = self.run, 0, self.stack, self.texts
        next_known, next_tag = _TEXT_AND_SOURCE.match, _TEXT_AND_TAG.match
        start, end_tag, close, wanted = self._start, self.handle_endtag, self._close, self.wanted
        describe, nothing, tokens, everything = wanted.describe_text, wanted.NOTHING, wanted.tokens, wanted.everything
        while True:
            token = next_known(html, at)
            if token is not None:
                text, source = token.groups()
                known = tokens.get(source)
                if known is not None:
                    if text:
                        if run or self.verbatim or self.silent or not text.strip(ASCII_BLANK):
                            run.append(text)
                        else:  # a run of its own
                            above = stack[-1]
                            above[3] += 1
                            above[4] = text
                            if everything or above[1] is not None:
                                texts.append(text)
                    tag, found, empty = known
                    if found is not None:
                        start(tag, found, empty)
                    elif run or stack[-1][0] != tag:
                        end_tag(tag)
                    else:
                        close()
                    at = token.end()
                    continue
            token = next_tag(html, at)
            if token is None:
                token = _OTHER.match(html, at)
                if token is None:
                    return at
                self._read_other(token.lastgroup, token[token.lastgroup])
                at = token.end()
                continue
            text, end, tag, attrs, empty = token.groups()
            after, content = token.end(), None
            if end is None:
                tag = tag.lower()
                if tag in RAW_TAGS and not empty:
                    content = _raw_content(tag, html, after)
                    if content is None:
                        return at
            if text:
                run.append(text)
            if end is not None:
                end = end.lower()
                end_tag(end)
                known = end, None, False
            else:
                known = tag, describe(attrs) if attrs else nothing, empty or tag in VOID_TAGS
                start(*known)
                if content is not None:
                    if content[0]:
                        run.append(content[0])
                    end_tag(tag)
                    after = content[1]
            if content is None:
                source = html[token.end(1) + 1 : after - 1]
                if "<" not in source and ">" not in source:
                    wanted.remember(source, known)
            at = after

    def _read_other(self, kind, value):
        if kind == "named":
            self.handle_entityref(value)
        elif kind == "number":
            self.handle_charref(value)
        elif kind == "comment" or kind == "doctype":
            self.handle_comment(value)
        else:
            self.run.append(value)

    # -- events of the general parser --------------------------------------------
    def handle_starttag(self, tag, attrs):
        found = self.wanted.describe({name: value or "" for name, value in attrs})
        self._start(tag, found, tag in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, self.wanted.describe({name: value or "" for name, value in attrs}), True)

    def handle_endtag(self, tag):
        if self.run:
            self._end_run()
        if self.stack[-1][0] == tag:
            self._close()
        elif self.open_tags.get(tag):  # an end tag nothing is open for is ignored
            while self._close() != tag:
                pass

    def handle_data(self, data):
        self.run.append(data)

    def handle_charref(self, name):
        self.run.append(entities.unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.run.append(html5.get(name + ";", "&" + name))

    def handle_comment(self, data):
        self._end_run()
        self._add_child(data)

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_run()
        if data.upper().startswith("CDATA["):
            self._add_text(data[6:])
        else:
            self._add_child(data)

    # -- tree -----------------------------------------------------------------------
    def _start(self, tag, found, empty):
        if self.run:
            self._end_run()
        above = self.stack[-1]
        above[3] += 1
        above[4] = None
        wanted = self.wanted
        attrs, elem_id, class_raw, chosen = found
        if chosen or above[1] is not None or wanted.everything or tag in wanted.tags:
            nodes = self.nodes
            number = len(nodes) - self.first_node
            start = len(self.texts) - self.first_text
            node = [number, number, above[2], tag, elem_id, class_raw, attrs, None, start, start]
            nodes.append(node)
        else:
            node = None
            number = self.dropped = self.dropped - 1
        if empty:
            return
        self.stack.append([tag, node, number, 0, None])
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        if tag in _TEXT_TAGS:
            self._count_text_tag(tag, 1)

    def _close(self):
        tag, node, _, children, sole = self.stack.pop()
        self.open_tags[tag] -= 1
        if tag in _TEXT_TAGS:
            self._count_text_tag(tag, -1)
        if node is not None:
            node[1] = len(self.nodes) - self.first_node - 1
            node[9] = len(self.texts) - self.first_text
        if children == 1:
            above = self.stack[-1]
            if above[3] == 1:
                above[4] = sole
            if node is not None:
                node[7] = sole
        return tag

    def _count_text_tag(self, tag, by):
        if tag in SILENT_TAGS:
            self.silent += by
        else:
            self.verbatim += by

    def _add_child(self, string):
        above = self.stack[-1]
        above[3] += 1
        above[4] = string

    def _end_run(self):
        if not self.run:
            return
        data = "".join(self.run)
        self.run.clear()
        if not self.verbatim and not data.strip(ASCII_BLANK):
            data = "\n" if "\n" in data else " "
        self._add_text(data)

    def _add_text(self, data):
        self._add_child(data)
        if (self.wanted.everything or self.stack[-1][1] is not None) and not self.silent:
            self.texts.append(data)


def _read_page(columns, html, wanted):
    ok = html is not None
    if html:  # an empty page has no nodes
        try:
            reader = _PageReader(columns, wanted)
            reader.read(html)
        except Exception:  # markup the parser rejects: the page fails, the job goes on
            columns.cut_back()
            ok = False
    columns.close_page(ok)


def _read_pages(bodies, wanted):
    """`nodes`, `texts` and `parse_ok` of some pages: plain ones all at once, others one by one.

    Where most pages are not plain, the next ones are read one by one without trying.
    """
    missing = np.asarray(bodies.is_null())
    if wanted.skip:
        wanted.skip -= 1
        nodes, plain = None, np.zeros(len(bodies), bool)
    else:
        nodes, texts, plain = read_plain(bodies.fill_null(""), wanted)
        wanted.skip = 0 if 2 * plain.sum() >= len(plain) else 15
    if plain.all() and not missing.any():
        return [nodes, texts, pa.array(plain)]
    columns, others = _Columns(), np.flatnonzero(~plain | missing)
    for body in bodies.take(pa.array(others)).to_pylist():
        _read_page(columns, body, wanted)
    rest = columns.to_arrow()
    if nodes is None:
        return rest
    # Missing pages are read as empty ones too, which are not taken.
    order = np.empty(len(bodies), np.int64)
    order[plain] = np.arange(plain.sum())
    order[others] = plain.sum() + np.arange(len(others))
    read = [nodes, texts, pa.array(np.ones(plain.sum(), bool))]
    return [pa.concat_arrays([a, b.cast(a.type)]).take(pa.array(order)) for a, b in zip(read, rest)]


# Where a class or id may be spelled with character references, or the parser may reject the page. Told by the character before
# the `=`, which is quickly ruled out; that other names end like these only sends more pages to the parser.
_UNSURE = r"""=(?<=[sSdD\s]=)=*\s*(?:"[^"]*&|'[^']*&|[^"'\s>][^\s>]*&|&)"""
_REJECTED = "<!["


def may_hold(html, signs):
    """Whether a page's source holds one of `signs`, or cannot be judged by it; other pages read like an empty one."""
    found = reduce(lambda a, b: a | b, [F.contains(html, F.lit(sign)) for sign in signs])
    if len(signs) > 1:  # what all of them begin with rules most pages of other kinds out at once
        found = F.contains(html, F.lit(commonprefix(signs))) & found
    # Without a `&` there is no reference: most pages are spared the expression.
    return html.isNull() | found | F.contains(html, F.lit(_REJECTED)) | (F.contains(html, F.lit("&")) & html.rlike(_UNSURE))


def _signed(html, signs):
    return F.when(may_hold(html, signs), html).otherwise(F.lit(""))


def html_nodes(pages: DataFrame, within=None, attrs=None, signs=None) -> DataFrame:
    """Replace `html` by `nodes`, `texts` and `parse_ok`; all other columns pass through.

    Pages that cannot have a wanted element are not sent to the parser: those whose source
    holds none of `signs`, by default the ids and classes of `within` if it names nothing else.
    """
    kept = [c for c in pages.columns if c != "html"]
    if signs is None and within is not None and all(w[0] in "#." for w in within):
        signs = [w[1:] for w in within]
    html = _signed(F.col("html"), signs) if signs else F.col("html")
    schema = T.StructType(
        [pages.schema[c] for c in kept]
        + [
            T.StructField("nodes", T.ArrayType(NODE, False), True),
            T.StructField("texts", T.ArrayType(T.StringType(), False), True),
            T.StructField("parse_ok", T.BooleanType(), False),
        ]
    )
    within = None if within is None else tuple(within)
    attrs = None if attrs is None else tuple(attrs)

    def parse(batches):
        wanted = _Wanted(within, attrs)
        for batch in batches:
            bodies = batch.column("html").cast(pa.string())
            sizes = np.cumsum(np.asarray(pc.binary_length(bodies).fill_null(0)), dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                before = sizes[start - 1] if start else 0
                end = min(int(np.searchsorted(sizes, before + OUTPUT_BYTES)) + 1, batch.num_rows)
                part = batch.slice(start, end - start)
                read = _read_pages(bodies.slice(start, end - start), wanted)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + read, names=schema.fieldNames())
                start = end

    return pages.select(*kept, html.alias("html")).mapInArrow(parse, schema)
