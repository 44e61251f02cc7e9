"""String rules as built-in expressions: trimming, title normalising, links and numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import PEOPLE_SEARCH, PY_SPACE, SITE, TITLE_SEARCH
from .maps import let


def _class(chars) -> str:
    """Characters as a class that tells a Latin letter in two steps: rare ones stand behind the range they lie in."""
    latin, rare = ("".join(f"\\x{{{ord(c):x}}}" for c in chars if (c < "\u0100") is low) for low in (True, False))
    return f"[{latin}[\\x{{100}}-\\x{{ffff}}&&[{rare}]]]"


_SPACE = _class(PY_SPACE)
# Runs of white space that are not one blank already, which nearly all are.
_SPACE_RUN = rf"{_SPACE}(?:(?<! )|(?={_SPACE})){_SPACE}*"


def _stripped(text: Column) -> Column:
    # Text that begins and ends with a visible ASCII character, as most does, has nothing to trim.
    ends = (text, F.right(text, F.lit(1)))
    plain = reduce(lambda a, b: a & b, [(end >= F.lit("!")) & (end < F.lit("\x7f")) for end in ends])
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(PY_SPACE)))


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return let(text, _stripped)


def strip_each(texts: Column) -> Column:
    return F.transform(texts, _stripped)


def collapse(text: Column) -> Column:
    """Trim, and replace each run of white space by one blank."""
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def _unless_ascii(text: Column, change) -> Column:
    """`change(text)`, spared for ASCII text, told by a byte per character, which it would leave as it is."""
    return let(text, lambda t: F.when(F.octet_length(t) == F.length(t), t).otherwise(change(t)))


def nfkd(text: Column) -> Column:
    """Unicode compatibility decomposition, done in the JVM by the ICU library Spark ships."""
    return _unless_ascii(
        text, lambda t: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), t, F.lit(True))
    )


def plain_marks(text: Column) -> Column:
    """Curly quotes and en dashes as ASCII ones, white space collapsed."""
    return collapse(_unless_ascii(text, lambda t: F.translate(t, "’“”–", "'\"\"-")))


def unquote(text: Column) -> Column:
    """Drop one enclosing pair of double quotes, or else of single quotes."""

    def enclosed(t, mark):
        return F.startswith(t, F.lit(mark)) & F.endswith(t, F.lit(mark))

    def inner(t):
        # A lone quote mark is its own pair and leaves nothing.
        return F.substring(t, F.lit(2), F.greatest(F.length(t) - 2, F.lit(0)))

    return let(text, lambda t: F.when(enclosed(t, '"') | enclosed(t, "'"), inner(t)).otherwise(t))


def normalize_text(text: Column) -> Column:
    # The ICU call takes no NULL: it is kept apart. Every step works its argument out once.
    return let(
        text, lambda t: F.when(t.isNotNull(), unquote(plain_marks(nfkd(F.coalesce(t, F.lit(""))))))
    )


def candidate_title(heading: Column) -> Column:
    """A search result's heading as the title to compare: two quote pairs and all `[...]` go."""
    text = normalize_text(normalize_text(heading))
    return collapse(F.regexp_replace(text, r"\[.*?\]", ""))


def match_key(title: Column) -> Column:
    """Titles are the same when their keys are; expects a collapsed title."""
    return normalize_text(F.lower(title))


def people_search_url(name: Column) -> Column:
    """Only blanks and commas are escaped."""
    return F.concat(F.lit(PEOPLE_SEARCH), F.replace(F.replace(name, F.lit(" "), F.lit("+")), F.lit(","), F.lit("%2C")))


def title_search_url(title: Column) -> Column:
    """The address a search form produces for this title."""
    return F.concat(F.lit(TITLE_SEARCH), F.url_encode(title))


def absolute_url(href: Column) -> Column:
    """Site base in front of a relative link; NULL stays NULL."""
    return F.concat(F.lit(SITE), href)


def browser_url(href: Column) -> Column:
    """The address a browser reports for a link of a loaded search page; NULL stays NULL."""
    return let(
        href,
        lambda h: F.when(F.startswith(h, F.lit("//")), F.concat(F.lit("https:"), h))
        .when(F.startswith(h, F.lit("/")), absolute_url(h))
        .when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .otherwise(F.concat(F.lit(SITE + "/"), h)),
    )


def whole_number(text: Column) -> Column:
    """BIGINT of a text that is a whole number and nothing else, else NULL."""
    digits = let(
        text, lambda t: F.when(t.rlike("^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(t, F.lit("_"), F.lit("")))
    )
    return digits.try_cast("bigint")


def contains_any(text: Column, words) -> Column:
    """Whether the lower-cased text contains one of the words as a substring."""
    return let(F.lower(text), lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in words]))
