"""A page as text blocks, each with the style path of the elements around it: one pass over the tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from hashlib import blake2b

# Elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
NEVER_TEXT = frozenset(
    "aside audio button canvas datalist dialog embed footer head iframe map menu nav noembed noframes noscript object"
    " script select style svg template textarea title video xmp".split()
)
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main"
    " menu nav ol p pre section table ul".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Words in classes, ids and roles of what surrounds an article. They drop no element that is or holds an article
# or a main, whatever its name, and none that holds most of the page's words if nothing else tells the story (`_spare`); a form is
# treated like an element of such a name.
SURROUNDINGS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies copyright dialog disclaimer disqus feedback foot footer form gdpr header legal login masthead menu"
    " modal nav navbar navigation newsletter notice notification outbrain overlay pager pagination paywall popup promo promotion"
    " recommended related replies reply respond search share sharebar sharing sidebar signup skip social sponsor sponsored"
    " subscribe subscription taboola toolbar topbar widget widgets".split()
)

# Names among them that are no article's body for being long, and words around a name that only speak of such a part.
NEVER_BODY = frozenset(
    "ad ads advert adverts advertisement advertising comment comments complementary disqus outbrain replies reply respond sidebar"
    " sponsor sponsored taboola".split()
)
SPEAKS_BEFORE, SPEAKS_AFTER = frozenset("has hide no show with without".split()), frozenset("closed open".split())

# Possessive: a tag is read once, whether it is closed (group 4) or not.
_TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>)?|[!?])")
_START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)|[!?])")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

DROPPED, ARTICLE, HEADER, IN_ARTICLE, NAMED = 1, 2, 4, 8, 16
NUMBER = 8  # the bits above tell the page's outermost articles and mains apart
LEAST_BODY = 50  # words that an element named as surroundings has at least to count as the body beside an article
MAX_NAMED = 16  # elements named as surroundings within each other that are told apart; further ones go with the last of them
MAX_DEPTH = 128  # elements further down have the style path of a child at this depth; their text and flags are their own
_names: dict[tuple[int, str], int] = {}


def _named(parent: int, key: str) -> int:
    """A path's 64-bit name, the same in every process."""
    found = _names.get((parent, key))
    if found is None:
        if len(_names) > 100_000:
            _names.clear()
        digest = blake2b(f"{parent}/{key}".encode("utf-8", "replace"), digest_size=8).digest()
        found = _names[parent, key] = int.from_bytes(digest, "little", signed=True)
    return found


def text_name(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@dataclass(slots=True)
class Element:
    tag: str
    path: int
    flags: int
    above: tuple[int, ...] = ()
    inner: tuple[int, ...] = ()  # the paths down to this element
    named: tuple[int, ...] = ()
    children: list[str] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    """blocks: (paths from the root inwards, flags, text); styles: (path, paths above it, its children's tags)."""

    blocks: list[tuple[tuple[int, ...], int, str]] = field(default_factory=list)
    styles: list[tuple[int, tuple[int, ...], str]] = field(default_factory=list)


def words_in(text: str) -> int:
    """Of a block's text, whose white space is single spaces."""
    return text.count(" ") + 1


def _looks(attributes: str) -> tuple[str, bool, list[str]]:
    """What a style path names an element by, whether it is hidden, and the words of its names."""
    key, hidden, named = "", False, []
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            words = _WORD.findall(_CAMEL.sub(r"\1 \2", value.strip("\"'")).lower())
            key += f" {name}={' '.join(words)}"
            named += words
        elif name in ("hidden", "aria-hidden", "style"):
            value = value.strip("\"'")
            hidden = hidden or name == "hidden" or (name == "style" and bool(_HIDDEN.search(value)))
            hidden = hidden or (name == "aria-hidden" and value.lower() == "true")
    return key, hidden, named


def _surrounds(words: list[str]) -> tuple[bool, bool]:
    """Whether names are of surroundings, and of such as are never a body. "has-sidebar" or "comments-open" only speaks of one."""
    found = [i for i, word in enumerate(words) if word in SURROUNDINGS]
    never = any(
        words[i] in NEVER_BODY
        and not (i and words[i - 1] in SPEAKS_BEFORE)
        and not (i + 1 < len(words) and words[i + 1] in SPEAKS_AFTER)
        for i in found
    )
    return bool(found), never


@dataclass(slots=True)
class Named:
    """Elements named as surroundings: of them, which are or hold an article or main, stand in one, hold an h1, are forms, are never a body."""

    n: int = 0
    holds: set[int] = field(default_factory=set)
    inside: set[int] = field(default_factory=set)
    titled: set[int] = field(default_factory=set)
    forms: set[int] = field(default_factory=set)
    never: set[int] = field(default_factory=set)


def _spare(page: Page, chains: list[tuple[int, ...]], told: list[bool], named: Named) -> None:
    """Leaves out blocks in elements named as surroundings, and marks those of elements whose name is not enough.

    chains: the named elements each block is in; told: whether a block is more than a heading or a byline. An element that holds
    most of the page's words stays only if no article or main tells anything without it. A form needs an h1 for that, if
    anything else is told; comments, adverts and sidebars stay only where the page would be empty.
    """
    words, marked, total, all_marked, left, left_told, left_marked = {}, {}, 0, 0, 0, 0, 0
    for (_, flags, text), chain, tells in zip(page.blocks, chains, told):
        n = words_in(text)
        total += n
        all_marked += bool(flags & ARTICLE)
        for e in chain:
            words[e] = words.get(e, 0) + n
            marked[e] = marked.get(e, 0) + bool(flags & ARTICLE)
        if named.holds.issuperset(chain):
            left += 1
            left_told += tells
            left_marked += tells and bool(flags & ARTICLE)

    def stays(e, n):
        if e in named.holds:
            return True
        if 2 * n <= total or left_marked:
            return False
        if e in named.never:
            return not left
        if e in named.forms and left_told and e not in named.titled:
            return False
        return e in named.inside or n >= LEAST_BODY or marked[e] == all_marked

    spared = {e for e, n in words.items() if stays(e, n)}
    page.blocks = [
        (paths, flags | NAMED if chain else flags, text) for (paths, flags, text), chain in zip(page.blocks, chains) if spared.issuperset(chain)
    ]


class Source:
    """Tags of a page in order. What is searched for ahead is remembered, so that all searches together read the page a few times."""

    def __init__(self, text: str):
        self.text, self.end = text, len(text)
        self.last = text.rfind(">")
        self.broken = 0  # a tag with an unclosed quote was read up to here: tags before it end at their first ">"
        self._closings: dict[str, tuple[int, int, int]] = {}
        self._block = (0, -1)

    def tag(self, at: int):
        """(start, end, whether it closes, name, attributes) of the next tag from `at` on; name None for comments; None if no tag is left."""
        text = self.text
        while True:
            plain = at < self.broken
            match = (_START if plain else _TAG).search(text, at)
            if match is None or match.start() > self.last and not match[1]:
                return None
            start, name = match.start(), match[3]
            if match[1]:
                over = text.find("-->", match.end())
                return start, over + 3 if over >= 0 else self.end, "", None, ""
            if name is None:
                over = text.find(">", match.end())
                return start, over + 1, "", None, ""
            if not plain:
                if match[5]:
                    return start, match.end(), match[2], name, match[4]
                self.broken = max(match.end(), start + 1)
                at = start
                continue
            over = text.find(">", match.end())
            return start, over + 1, match[2], name, text[match.end() : over]

    def closing(self, tag: str, at: int) -> tuple[int, int]:
        """Where the next end tag of that name begins and ends; both the page's end if there is none."""
        asked, start, over = self._closings.get(tag, (0, -1, -1))
        if not asked <= at <= start:
            match = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(self.text, at)
            start = match.start() if match else self.end
            over = self.text.find(">", start) + 1 if match else self.end
            if not over:
                start = over = self.end
            self._closings[tag] = at, start, over
        return start, over

    def block(self, at: int) -> int:
        """Where the next tag that is not inline begins."""
        asked, start = self._block
        if not asked <= at <= start:
            start = at
            while (found := self.tag(start)) and (found[3] is None or found[3].lower() in INLINE):
                start = found[1]
            start = found[0] if found else self.end
            self._block = at, start
        return start

    def words(self, at: int, end: int) -> int:
        """Words between inline tags."""
        parts = []
        while at < end and (found := self.tag(at)) and found[0] < end:
            parts.append(self.text[at : found[0]])
            at = found[1]
        parts.append(self.text[at:end])
        return len(html.unescape("".join(parts)).split())


def read_page(source: str, inline_names: bool = True) -> Page:
    """Blocks in page order; text of dropped elements is left out, their place in the style tree is kept."""
    page, parts, tags = Page(), [], Source(source)
    chains, told, around, n_articles, skipped = [], [], Named(), 0, 0
    root = Element("", 0, 0)
    stack, opened = [root], Counter()

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            top = stack[-1]
            if text and not top.flags & DROPPED:
                page.blocks.append((top.inner, top.flags, text))
                chains.append(top.named)
                told.append(top.tag not in HEADINGS and not top.flags & HEADER)

    def close(depth):
        while len(stack) > depth:
            element = stack.pop()
            opened[element.tag] -= 1
            page.styles.append((element.path, element.above, " ".join(element.children)))

    def open_(tag, attributes):
        nonlocal n_articles
        parent = stack[-1]
        key, hidden, words = _looks(attributes) if attributes else ("", False, ())
        flags, named = parent.flags, parent.named
        if tag in NEVER_TEXT or (hidden and tag not in ("html", "body", "main")):
            flags |= DROPPED
        surrounds, never = _surrounds(words) if words and tag not in ("html", "body", "main") else (False, False)
        if (tag == "form" or surrounds) and len(named) < MAX_NAMED:
            around.n += 1
            named += (around.n,)
            if flags & ARTICLE:
                around.inside.add(around.n)
            if never:
                around.never.add(around.n)
            elif tag == "form":
                around.forms.add(around.n)
        if tag == "article" or tag == "main":
            # An article within another one is a comment on it.
            if not flags & DROPPED and (tag == "main" or not flags & IN_ARTICLE):
                around.holds.update(named)
            if not flags & ARTICLE:
                n_articles += 1
                flags |= ARTICLE | n_articles << NUMBER
            if tag == "article":
                flags |= IN_ARTICLE
        if tag == "header":
            flags |= HEADER if flags & ARTICLE else DROPPED
        elif tag in HEADINGS:
            flags &= ~HEADER  # a heading may stand in the article's own header; its byline is no text of it
            if tag == "h1" and named:
                around.titled.update(named)
        parent.children.append(tag)
        above = parent.inner if len(parent.inner) < MAX_DEPTH else parent.above
        path = _named(above[-1] if above else 0, tag + key)
        opened[tag] += 1
        stack.append(Element(tag, path, flags, above, (*above, path), named))

    at, end = 0, len(source)
    while at < end:
        found = tags.tag(at)
        if found is None:
            parts.append(source[at:])
            break
        start, over, closes, tag, attributes = found
        if start > at:
            parts.append(source[at:start])
        at = over
        if tag is None:
            continue
        tag = tag.lower()
        if closes:
            if tag in INLINE:
                continue
            depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag) if opened[tag] else 0
            flush()
            if depth:
                close(depth)
            continue
        if tag in RAW:
            at = tags.closing(tag, at)[1]
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif attributes and not attributes.isspace() and tag != "a":
                _, hidden, words = _looks(attributes)
                named = inline_names and bool(words) and SURROUNDINGS.issuperset(words)
                if hidden or named:
                    # Inline surroundings, such as a hidden label: skip to its end. No other word may be in the name.
                    ends, over = tags.closing(tag, at)
                    if ends < end:
                        if not hidden:
                            if tags.block(at) < ends:
                                continue
                            if not stack[-1].flags & DROPPED:
                                skipped = max(skipped, tags.words(at, ends))
                        at = over
            continue
        flush()
        if tag in VOID:
            continue
        ends = CLOSES.get(tag, ())
        if tag in ENDS_PARAGRAPH and stack[-1].tag == "p":
            close(len(stack) - 1)
        elif ends:
            depth = next((i for i in range(len(stack) - 1, max(0, len(stack) - 4), -1) if stack[i].tag in ends), 0)
            if depth:
                close(depth)
        open_(tag, attributes)
        if attributes.endswith("/") and tag in ("svg", "path"):
            close(len(stack) - 1)
    flush()
    close(1)
    if skipped > sum(words_in(text) for _, _, text in page.blocks):
        return read_page(source, False)
    if around.n:
        _spare(page, chains, told, around)
    return page
