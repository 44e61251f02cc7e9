"""Article addresses to article details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    AUTHOR_LABELS,
    BOOK_LABELS,
    DATE_LABELS,
    DESCRIPTION_LABELS,
    PAGES_LABELS,
    TOTAL_LABELS,
    TOTAL_PREFIXES,
)
from ..functions.maps import last_wins, zip_short
from ..functions.text import whole_number
from ..operators.html_nodes import html_nodes
from ..operators.lookup import page_lookup
from ..operators.pending import pending_once
from ..operators.selectors import (
    all_nodes,
    first_node,
    has_class,
    has_id,
    inside,
    labelled_section,
    labelled_value,
    next_anchor,
    page_nodes,
    page_texts,
    sole_string,
    tag,
    tight_text,
)
from ..schemas import ARTICLE_DETAILS
from ..session import per_session

ARTICLE_ROOTS = (
    ".gs_scl",
    ".gsc_oci_field",
    ".gsc_oci_value",
    "#gsc_oci_descr",
    ".gsc_oci_g_t",
    ".gsc_oci_g_a",
    "a",
)
# Without one of these on the page an `a` or a section is of no use; sections alone are on result pages too.
ARTICLE_SIGNS = tuple(root[1:] for root in ARTICLE_ROOTS if root[0] in "#." and root != ".gs_scl")

_FIELD = (tag("div"), has_class("gsc_oci_field"))
_VALUE = (tag("div"), has_class("gsc_oci_value"))
_SECTION = (tag("div"), has_class("gs_scl"))


def _beside(labels):
    """Value next to an exactly written label."""
    return labelled_value(page_nodes(), page_texts(), (*_FIELD, sole_string(*labels)), _VALUE)


def _in_section(labels, value_tests):
    return labelled_section(page_nodes(), page_texts(), _SECTION, _FIELD, value_tests, labels)


def _total_citations():
    label = first_node(page_nodes(), *_FIELD, sole_string(*TOTAL_LABELS))
    text = tight_text(page_texts(), next_anchor(page_nodes(), label))
    for prefix in TOTAL_PREFIXES:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


@per_session
def _found_on_page():
    """One column per field of an article page; the node arrays end here."""
    return [
        _beside(AUTHOR_LABELS).alias("authors"),
        _in_section(DATE_LABELS, _VALUE).alias("publication_date"),
        _beside(BOOK_LABELS).alias("book"),
        _beside(PAGES_LABELS).alias("pages"),
        _in_section(DESCRIPTION_LABELS, (tag("div"), has_id("gsc_oci_descr"))).alias("description"),
        _total_citations().alias("total_citations"),
        F.transform(
            all_nodes(page_nodes(), tag("span"), has_class("gsc_oci_g_t")), lambda n: tight_text(page_texts(), n)
        ).alias("years"),
        F.transform(
            all_nodes(page_nodes(), tag("a"), has_class("gsc_oci_g_a")),
            lambda a: whole_number(
                tight_text(page_texts(), first_node(inside(page_nodes(), a), tag("span"), has_class("gsc_oci_g_al")))
            ),
        ).alias("counts"),
    ]


@per_session
def _detail_record():
    ok = F.col("parse_ok") & ~F.exists("counts", lambda c: c.isNull())
    for field in ("authors", "book", "pages"):
        ok = ok & ~(F.col(f"{field}.labelled") & F.col(f"{field}.value").isNull())
    record = F.struct(
        F.coalesce(ok, F.lit(False)).alias("ok"),
        F.col("authors.value").alias("authors"),
        "publication_date",
        F.col("book.value").alias("book"),
        F.col("pages.value").alias("pages"),
        "description",
        "total_citations",
        F.when(F.col("parse_ok"), last_wins(zip_short(F.col("years"), F.col("counts")))).alias("annual_citations"),
    )
    return [record.alias("record")]


def detail_records(pages: DataFrame) -> DataFrame:
    """`record`: the fields of an article page, and `ok`: false where the page fails as a whole."""
    parsed = html_nodes(
        pages.select("url", "page_id", "html"), within=ARTICLE_ROOTS, attrs=(), signs=ARTICLE_SIGNS
    )
    found = parsed.select("url", "page_id", "parse_ok", *_found_on_page(parsed))
    return found.select("url", "page_id", *_detail_record(found))


def detail_join(articles: DataFrame, pages: DataFrame, **options) -> DataFrame:
    """Details per input row, repeated titles included; rows without a readable page vanish."""
    asked = articles.select("title", F.col("url").alias("paper_url"))
    rows = page_lookup(pages, detail_records, "article_pages", **options).join(asked, "paper_url", "inner")
    rows = rows.filter("record.ok").select("title", "paper_url", "record.*")
    return rows.to(ARTICLE_DETAILS)


def article_details(articles: DataFrame, pages: DataFrame, done: DataFrame | None = None, **options) -> DataFrame:
    """Details of the articles whose title `done` does not hold yet."""
    todo = pending_once(articles.select("title", "url"), "title", done, "title", **options)
    return detail_join(todo, pages, **options)
