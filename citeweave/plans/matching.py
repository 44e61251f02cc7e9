"""Article titles to the search result with the same title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CITED_BY_STARTS, RESULT_CLASSES
from ..functions.maps import last_wins
from ..functions.text import absolute_url, candidate_title, collapse, match_key, strip, title_search_url
from ..operators.html_nodes import html_nodes
from ..operators.lookup import page_lookup
from ..operators.pending import pending_once
from ..operators.selectors import (
    all_nodes,
    attr,
    class_is,
    each_inside,
    first_node,
    has_class,
    inside,
    let,
    page_nodes,
    page_texts,
    raw_text,
    sole_string_starts,
    spaced_text,
    tag,
    tight_text,
)
from ..schemas import MATCHES
from ..session import per_session


def result_blocks(nodes, fields):
    """`fields(below)` of a page's search results in document order, from the nodes below each."""
    return each_inside(nodes, all_nodes(nodes, tag("div"), class_is(*RESULT_CLASSES)), lambda _, below: fields(below))


def heading_of(below):
    return first_node(below, tag("h3"), has_class("gs_rt"))


def cited_by_anchor(below):
    return first_node(below, tag("a"), sole_string_starts(*CITED_BY_STARTS))


def _authors(below):
    """Linked authors, name to address; an author without a link has no address."""
    box = first_node(below, tag("div"), has_class("gs_a", "gs_fmaa"))
    anchors = all_nodes(inside(page_nodes(), box), tag("a"))
    pairs = F.transform(
        anchors,
        lambda a: F.struct(
            tight_text(page_texts(), a).alias("k"), absolute_url(attr(a, "href")).alias("v")
        ),
    )
    return last_wins(pairs)


def _snippet_texts(snippet):
    """Texts of all divs of the snippet; nested divs repeat their text."""
    divs = all_nodes(inside(page_nodes(), snippet), tag("div"))
    texts = F.transform(divs, lambda d: strip(raw_text(page_texts(), d)))
    return F.array_join(F.filter(texts, lambda t: t != ""), " ")


def _result(below):
    """Fields of one result. Its two abstracts are for an exact match and for a lone result."""
    parts = F.struct(
        heading_of(below).alias("heading"),
        F.coalesce(
            strip(raw_text(page_texts(), first_node(below, tag("div"), has_class("gsh_csp")))),
            spaced_text(page_texts(), first_node(below, tag("div"), has_class("gs_rs"))),
        ).alias("plain"),
        first_node(below, tag("div"), has_class("gs_fma_snp")).alias("snippet"),
    )
    return let(
        parts,
        lambda p: F.struct(
            candidate_title(raw_text(page_texts(), p["heading"])).alias("candidate"),
            tight_text(page_texts(), p["heading"]).alias("heading"),
            attr(first_node(inside(page_nodes(), p["heading"]), tag("a")), "href").alias("url"),
            F.coalesce(p["plain"], F.when(p["snippet"].isNotNull(), F.lit(""))).alias("exact_abstract"),
            F.coalesce(p["plain"], _snippet_texts(p["snippet"])).alias("lone_abstract"),
            absolute_url(attr(cited_by_anchor(below), "href")).alias("cited_articles_url"),
            _authors(below).alias("authors_with_urls"),
        ),
    )


@per_session
def _results():
    return [result_blocks(page_nodes(), _result).alias("results")]


@per_session
def _keyed_results():
    keyed = F.transform(
        "results", lambda r: F.struct(match_key(r["candidate"]).alias("key"), r.alias("result"))
    )
    return [F.struct(keyed.alias("results")).alias("record")]


def result_records(pages: DataFrame) -> DataFrame:
    """`record.results`: the search results of a page in document order, each with its match key."""
    parsed = html_nodes(pages.select("url", "page_id", "html"), within=(".gs_r",), attrs=("href",))
    found = parsed.select("url", "page_id", *_results(parsed))
    return found.select("url", "page_id", *_keyed_results(found))


def choose_result(rows: DataFrame) -> DataFrame:
    """Rows with `original_title`, `original_url` and a `record` to matches; every row survives.

    The first result with the title's key wins; without one, a lone result is
    taken. All of it happens inside the row: results are neither exploded nor grouped.
    """
    key = match_key(collapse(F.col("original_title")))
    rows = rows.select("original_title", "original_url", "record", key.alias("key"))
    results = F.col("record.results")
    exact = let(F.col("key"), lambda k: F.get(F.filter(results, lambda r: r["key"] == k), F.lit(0))["result"])
    lone = F.when(F.size(results) == 1, F.get(results, F.lit(0))["result"])
    # An empty title is no match, so a lone result still counts then.
    rows = rows.select(
        "original_title", "original_url", exact.alias("exact"), lone.alias("lone")
    )
    by_title = F.col("exact").isNotNull() & ((F.col("exact.candidate") != "") | F.col("lone").isNull())
    taken = rows.select(
        "original_title",
        "original_url",
        by_title.alias("by_title"),
        F.when(by_title, F.col("exact")).otherwise(F.col("lone")).alias("r"),
    )
    title = F.when(F.col("by_title"), F.col("r.candidate")).otherwise(F.col("r.heading"))
    abstract = F.when(F.col("by_title"), F.col("r.exact_abstract")).otherwise(F.col("r.lone_abstract"))
    no_authors = F.create_map().cast("map<string,string>")
    return taken.select(
        title.alias("matched_title"),
        F.col("r.url").alias("url"),
        F.when(title != "", abstract).alias("abstract"),
        F.col("r.cited_articles_url").alias("cited_articles_url"),
        F.coalesce(F.col("r.authors_with_urls"), no_authors).alias("authors_with_urls"),
        "original_title",
        "original_url",
    ).to(MATCHES)


def search_join(titles: DataFrame, pages: DataFrame, query_url=title_search_url, **options) -> DataFrame:
    """Result pages beside `(title, paper_url)`; a title without a page has a NULL `record`."""
    asked = titles.select(
        F.col("title").alias("original_title"),
        F.col("paper_url").alias("original_url"),
        query_url(F.col("title")).alias("query_url"),
    )
    return page_lookup(pages, result_records, "result_pages", **options).join(asked, "query_url", "left")


def match_titles(
    details: DataFrame,
    pages: DataFrame,
    done: DataFrame | None = None,
    done_key: str = "original_title",
    query_url=title_search_url,
    **options,
) -> DataFrame:
    """Matches of the titles that `done` does not hold yet.

    `done_key="matched_title"` compares with the titles found instead of the ones asked for:
    unmatched titles are then asked again on every run.
    """
    todo = pending_once(details.select("title", "paper_url"), "title", done, done_key, **options)
    return choose_result(search_join(todo, pages, query_url, **options))
