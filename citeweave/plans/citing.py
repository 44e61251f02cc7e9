"""Cited-by links to citation edges (citing article -> original paper)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maps import worked_out
from ..functions.text import absolute_url
from ..operators.hot_keys import HOT_ROWS, hot_join
from ..operators.html_nodes import html_nodes
from ..operators.lookup import page_lookup
from ..operators.pending import pending_once
from ..operators.selectors import (
    all_nodes,
    attr,
    first_node,
    has_class,
    has_id,
    inside,
    let,
    page_nodes,
    page_texts,
    tag,
    word_text,
)
from ..schemas import CITING_EDGES
from ..session import materialise, per_session
from .matching import cited_by_anchor, heading_of, result_blocks


# What the fields of a listing page are read from; a page without any of these is not sent to the parser.
LISTING_ROOTS = {"results": ".gs_r", "links": "#gs_nml"}


def _without_href(anchor):
    return anchor.isNotNull() & attr(anchor, "href").isNull()


def _citing(below):
    """One citing article, and whether one of its links lacks an address."""
    parts = let(
        heading_of(below),
        lambda heading: F.struct(
            heading.alias("heading"),
            first_node(inside(page_nodes(), heading), tag("a")).alias("anchor"),
            cited_by_anchor(below).alias("cited_by"),
        ),
    )
    return let(
        parts,
        lambda r: F.struct(
            word_text(page_texts(), r["heading"]).alias("title"),
            attr(r["anchor"], "href").alias("url"),
            absolute_url(attr(r["cited_by"], "href")).alias("next_url"),
            (_without_href(r["anchor"]) | _without_href(r["cited_by"])).alias("broken"),
        ),
    )


@per_session
def _found_on_page():
    navigation = first_node(page_nodes(), tag("div"), has_id("gs_nml"))
    links = F.transform(
        all_nodes(inside(page_nodes(), navigation), tag("a"), has_class("gs_nma")),
        lambda a: absolute_url(attr(a, "href")),
    )
    results = F.filter(result_blocks(page_nodes(), _citing), lambda r: ~r["broken"])
    return [F.coalesce(links, F.array().cast("array<string>")).alias("links"), results.alias("results")]


@per_session
def _listing_record():
    return [
        F.col("parse_ok").alias("ok"),
        (~F.exists("links", lambda u: u.isNull())).alias("links_ok"),
        F.col("links"),
        F.transform("results", lambda r: r.dropFields("broken")).alias("results"),
    ]


def listing_records(pages: DataFrame, field: str | None = None) -> DataFrame:
    """`record`: `results` and `links` (to sibling pages) of a listing page, `ok` and `links_ok`.

    With `field`, one of `results` and `links`, the record holds `ok` and that field alone: the parser returns nothing else, and the
    field is worked out once for all that is done with it.
    """
    within = tuple(root for name, root in LISTING_ROOTS.items() if field in (None, name))
    signs = [root[1:] for root in LISTING_ROOTS.values()]
    parsed = html_nodes(pages.select("url", "page_id", "html"), within=within, attrs=("href",), signs=signs)
    found = parsed.select("url", "page_id", "parse_ok", *_found_on_page(parsed))
    ok, links_ok, links, results = _listing_record(found)
    if field is None:
        return found.select("url", "page_id", F.struct(ok, links_ok, links, results).alias("record"))
    found = found.select("url", "page_id", ok, worked_out(links if field == "links" else results))
    return found.select("url", "page_id", F.struct("ok", field).alias("record"))


def page_set(first_url, links):
    """The first page and the ones it links to, each address once, first occurrence kept."""
    return F.array_distinct(F.concat(F.array(first_url), links))


def first_pages(papers: DataFrame, lookup) -> DataFrame:
    """Readable first pages of the papers' listings, one row per address."""
    asked = papers.select(F.col("cited_articles_url").alias("first_url")).distinct()
    rows = lookup.join(asked, "first_url", "inner").filter("record.ok AND record.links_ok")
    return rows.select("first_url", "record.links", "record.results")


def sibling_pages(firsts: DataFrame, lookup) -> DataFrame:
    """The other pages of each listing; `loaded` is false where a page is missing or unreadable."""
    others = F.slice(page_set(F.col("first_url"), F.col("links")), 2, F.size("links") + 1)
    asked = firsts.select("first_url", F.explode(others).alias("page_url"))
    return lookup.join(asked, "page_url", "left").select(
        "first_url",
        "page_url",
        F.coalesce("record.ok", F.lit(False)).alias("loaded"),
        F.col("record.results").alias("results"),
    )


def complete_listings(firsts: DataFrame, siblings: DataFrame) -> DataFrame:
    """`(first_url, results)` per page of the listings none of whose pages failed."""
    failed = siblings.filter(~F.col("loaded")).select(F.col("first_url").alias("_failed")).distinct()
    rows = firsts.select("first_url", "results").unionByName(
        siblings.filter("loaded").select("first_url", "results")
    )
    return rows.join(failed, F.col("first_url") == F.col("_failed"), "left_anti")


def citing_join(papers: DataFrame, listings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One edge per paper and result; nothing is deduplicated."""
    rows = hot_join(papers, "cited_articles_url", listings, "first_url", "inner", hot_rows=hot_rows)
    rows = rows.select("original_title", "url", "cited_articles_url", F.explode("results").alias("r"))
    return rows.select(
        F.col("original_title").alias("original_paper_title"),
        F.col("url").alias("original_paper_url"),
        F.col("cited_articles_url").alias("original_cited_page_url"),
        F.col("r.title").alias("cited_article_title"),
        F.col("r.url").alias("cited_article_url"),
        F.col("r.next_url").alias("next_cited_articles_url"),
    ).to(CITING_EDGES)


def with_citation_link(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("cited_articles_url").isNotNull())


def citing_edges(
    matches: DataFrame, pages: DataFrame, done: DataFrame | None = None, hot_rows: int = HOT_ROWS, plan: str = "auto"
) -> DataFrame:
    """Edges of the papers that `done` does not hold yet and that have a cited-by link; `plan` as in `PageLookup`."""
    papers = with_citation_link(matches.select("original_title", "url", "cited_articles_url"))
    papers = pending_once(papers, "original_title", done, "original_paper_title", hot_rows)
    lookup = page_lookup(pages, listing_records, "listing_pages", hot_rows=hot_rows, reuse=True, plan=plan)
    firsts = materialise(first_pages(papers, lookup), "first_pages")
    siblings = materialise(sibling_pages(firsts, lookup), "sibling_pages")
    return citing_join(papers, complete_listings(firsts, siblings), hot_rows)
