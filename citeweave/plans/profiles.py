"""Researcher names to profiles and their article lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import INSTITUTION_WORDS, POSITION_WORDS
from ..functions.maps import last_wins, worked_out, zip_short
from ..functions.text import absolute_url, browser_url, collapse, contains_any, people_search_url, strip_each, whole_number
from ..operators.html_nodes import html_nodes
from ..operators.lookup import page_lookup
from ..operators.pending import pending_once
from ..operators.selectors import (
    all_nodes,
    attr,
    each_inside,
    first_node,
    has_class,
    has_id,
    has_token,
    inside,
    let,
    page_nodes,
    page_texts,
    raw_text,
    tag,
    tight_text,
)
from ..schemas import PROFILE_ARTICLES, PROFILES
from ..session import materialise, per_session


# -- search pages --------------------------------------------------------------
@per_session
def _first_person():
    def links(_, below):
        headings = all_nodes(below, tag("h3"), has_class("gs_ai_name"))
        return F.flatten(each_inside(page_nodes(), headings, lambda _, under: all_nodes(under, tag("a"))))

    anchors = F.flatten(each_inside(page_nodes(), all_nodes(page_nodes(), has_class("gs_ai_t")), links))
    # A browser reports links of a loaded page in absolute form.
    link = browser_url(attr(F.get(anchors, F.lit(0)), "href"))
    return [F.struct(link.alias("researcher_url")).alias("record")]


def search_records(pages: DataFrame) -> DataFrame:
    """`record.researcher_url`: link of the first person found on a people-search page."""
    parsed = html_nodes(pages.select("url", "page_id", "html"), within=(".gs_ai_t",), attrs=("href",))
    return parsed.select("url", "page_id", *_first_person(parsed))


def resolve_profiles(seeds: DataFrame, pages: DataFrame, **options) -> DataFrame:
    """`(name, researcher_url)` for every seed; NULL where the search finds nobody."""
    asked = seeds.select("name", people_search_url(F.col("name")).alias("search_url"))
    found = page_lookup(pages, search_records, "people_search", **options).join(asked, "search_url", "left")
    return found.select("name", F.col("record.researcher_url").alias("researcher_url"))


# -- profile pages -------------------------------------------------------------
# What decides whether a page fails, also holding most fields, and what the other fields are read from.
DECIDING_ROOTS = (".gsc_prf_il", "#gsc_prf_ivh", "#gsc_rsb_st", ".gsc_rsb_m")
FIELD_ROOTS = {"research_areas": "#gsc_prf_int", "annual_citations": ".gsc_md_hist_b", "articles": ".gsc_a_tr"}
PROFILE_ROOTS = (*DECIDING_ROOTS, *FIELD_ROOTS.values())


def _texts_of(found: Column) -> Column:
    """Texts of the found nodes, stripped run by run; no array for no search area."""
    return F.transform(found, lambda n: tight_text(page_texts(), n))


def _metrics(table: Column) -> Column:
    """`(label, value)` per row of the table's body; the value column is the first one, all time."""
    body = first_node(inside(page_nodes(), table), tag("tbody"))
    return each_inside(
        page_nodes(),
        all_nodes(inside(page_nodes(), body), tag("tr")),
        lambda _, below: F.struct(
            tight_text(page_texts(), first_node(below, tag("td"), has_class("gsc_rsb_sc1"))).alias("label"),
            tight_text(page_texts(), first_node(below, tag("td"), has_class("gsc_rsb_std"))).alias("value"),
        ),
    )


def _access_part(box: Column, part_class: str, inner_tag: str) -> Column:
    """First word of one access count: `(present, word)`."""
    part = first_node(inside(page_nodes(), box), tag("div"), has_class(part_class))
    return let(
        part,
        lambda p: F.struct(
            p.isNotNull().alias("present"),
            F.get(
                F.split(collapse(raw_text(page_texts(), first_node(inside(page_nodes(), p), tag(inner_tag)))), " "), F.lit(0)
            ).alias("word"),
        ),
    )


def _articles() -> Column:
    """Article rows; one without title anchor or year cell is left out, the page stays."""
    rows = each_inside(
        page_nodes(),
        all_nodes(page_nodes(), tag("tr"), has_class("gsc_a_tr")),
        lambda _, below: F.struct(
            first_node(below, tag("a"), has_class("gsc_a_at")).alias("anchor"),
            first_node(
                inside(page_nodes(), first_node(below, tag("td"), has_class("gsc_a_y"))),
                tag("span"),
                has_class("gsc_a_h"),
            ).alias("year"),
        ),
    )
    whole = F.filter(rows, lambda r: r["anchor"].isNotNull() & r["year"].isNotNull())
    return F.transform(
        whole,
        lambda r: F.struct(
            raw_text(page_texts(), r["anchor"]).alias("title"),
            tight_text(page_texts(), r["year"]).alias("year"),
            absolute_url(attr(r["anchor"], "href")).alias("url"),
        ),
    )


def _headline():
    return first_node(page_nodes(), tag("div"), has_class("gsc_prf_il"))


@per_session
def _deciding_areas():
    """Areas that decide whether a page fails, as rows of a generator.

    A filter by `ok` is not pushed below a generator: it would search each area again as often as the condition names it.
    """
    headline = _headline()
    site_box = first_node(page_nodes(), tag("div"), has_id("gsc_prf_ivh"))
    table = first_node(page_nodes(), tag("table"), has_id("gsc_rsb_st"))
    access = first_node(page_nodes(), tag("div"), has_class("gsc_rsb_m"))
    areas = [
        let(
            first_node(inside(page_nodes(), headline), tag("a"), has_class("gsc_prf_ila")),
            lambda a: F.struct(
                a.isNotNull().alias("present"), attr(a, "href").alias("href"), tight_text(page_texts(), a).alias("text")
            ),
        ).alias("institution_link"),
        let(
            first_node(inside(page_nodes(), site_box), tag("a"), has_token("rel", "nofollow")),
            lambda a: F.struct(a.isNotNull().alias("present"), attr(a, "href").alias("href")),
        ).alias("site_link"),
        let(
            table,
            lambda t: F.struct(t.isNotNull().alias("present"), _metrics(t).alias("rows")),
        ).alias("metrics"),
        let(
            access,
            lambda box: F.struct(
                box.isNotNull().alias("present"),
                _access_part(box, "gsc_rsb_m_a", "span").alias("open"),
                _access_part(box, "gsc_rsb_m_na", "div").alias("closed"),
            ),
        ).alias("access"),
    ]
    return [worked_out(*areas)]


@per_session
def _found_on_page():
    """One column per area of a profile page; the node arrays end here."""
    area_box = first_node(page_nodes(), tag("div"), has_id("gsc_prf_int"))
    chart = inside(page_nodes(), first_node(page_nodes(), tag("div"), has_class("gsc_md_hist_b")))
    return [
        tight_text(page_texts(), _headline()).alias("headline"),
        "institution_link",
        "site_link",
        _texts_of(all_nodes(inside(page_nodes(), area_box), tag("a"), has_class("gsc_prf_inta"))).alias("areas"),
        "metrics",
        _texts_of(all_nodes(chart, tag("span"), has_class("gsc_g_t"))).alias("years"),
        _texts_of(all_nodes(chart, tag("a"), has_class("gsc_g_a"))).alias("counts"),
        "access",
        _articles().alias("articles"),
    ]


def _is_position(part):
    return contains_any(part, POSITION_WORDS)


def _is_institution(part):
    return ~_is_position(part) & contains_any(part, INSTITUTION_WORDS)


def _last(found):
    return F.try_element_at(found, F.lit(-1))


def _metric(label):
    return _last(F.filter(F.col("metrics.rows"), lambda r: r["label"] == label))["value"]


def _access_count(part: str) -> Column:
    """A missing part counts 0; a present one that is no number is NULL, and fails the page."""
    return F.when(F.col(f"access.{part}.present"), whole_number(F.col(f"access.{part}.word"))).otherwise(F.lit(0))


def _no_list():
    return F.array().cast("array<string>")


@per_session
def _profile_record():
    parts = strip_each(F.split("headline", ","))
    total = F.when(F.col("access.present"), _access_count("open") + _access_count("closed"))
    bad_metrics = F.col("metrics.present") & (
        F.col("metrics.rows").isNull()
        | F.exists(F.col("metrics.rows"), lambda r: r["label"].isNull() | r["value"].isNull())
    )
    ok = (
        F.col("parse_ok")
        & ~(F.col("institution_link.present") & F.col("institution_link.href").isNull())
        & ~(F.col("site_link.present") & F.col("site_link.href").isNull())
        & ~F.coalesce(bad_metrics, F.lit(False))
        & ~(F.col("access.present") & total.isNull())
    )
    years, counts = (F.coalesce(F.col(c), _no_list()) for c in ("years", "counts"))
    return [
        ok.alias("ok"),
        _last(F.filter(parts, _is_position)).alias("position"),
        absolute_url(F.col("institution_link.href")).alias("institution_href"),
        F.coalesce(_last(F.filter(parts, _is_institution)), F.col("institution_link.text")).alias("institution"),
        F.col("site_link.href").alias("personal_website"),
        F.array_join(F.coalesce(F.col("areas"), _no_list()), ", ").alias("research_areas"),
        _metric("Citations").alias("total_citations"),
        _metric("h-index").alias("h_index"),
        _metric("i10-index").alias("i10_index"),
        last_wins(zip_short(years, counts)).alias("annual_citations"),
        total.alias("total_access_articles"),
        F.col("articles"),
    ]


RECORD = (
    "ok", "position", "institution_href", "institution", "personal_website", "research_areas", "total_citations",
    "h_index", "i10_index", "annual_citations", "total_access_articles", "articles",
)


def profile_records(pages: DataFrame, fields: tuple[str, ...] | None = None) -> DataFrame:
    """`record`: the profile fields of a page, and `ok`: false where the page fails as a whole.

    With `fields`, the record holds `ok` and those alone: the parser returns what they and `ok` are read from, and each is worked out
    once for all that is done with it.
    """
    within = PROFILE_ROOTS if fields is None else (*DECIDING_ROOTS, *(FIELD_ROOTS[f] for f in fields if f in FIELD_ROOTS))
    signs = [root[1:] for root in PROFILE_ROOTS]
    parsed = html_nodes(pages.select("url", "page_id", "html"), within=within, attrs=("href", "rel"), signs=signs)
    decided = parsed.select("*", *_deciding_areas(parsed))
    found = decided.select("url", "page_id", "parse_ok", *_found_on_page(decided))
    record = dict(zip(RECORD, _profile_record(found), strict=True))
    if not fields:
        held = RECORD if fields is None else ("ok",)
        return found.select("url", "page_id", F.struct(*(record[f] for f in held)).alias("record"))
    found = found.select("url", "page_id", record["ok"], worked_out(*(record[f] for f in fields)))
    return found.select("url", "page_id", F.struct("ok", *fields).alias("record"))


def profile_join(resolved: DataFrame, pages: DataFrame, **options) -> DataFrame:
    """Profiles of the resolved names; names without an address or a readable page vanish."""
    rows = page_lookup(pages, profile_records, "profiles", **options).join(resolved, "researcher_url", "inner")
    rows = rows.filter("record.ok").select("name", "researcher_url", "record.*")
    return rows.to(PROFILES)


def profiles(seeds: DataFrame, pages: DataFrame, done: DataFrame | None = None, **options) -> DataFrame:
    """Profiles of the seeds that `done` does not hold yet."""
    todo = pending_once(seeds.select("name"), "name", done, "name", **options)
    resolved = materialise(resolve_profiles(todo, pages, **options), "resolved")
    return profile_join(resolved, pages, **options)


def explode_articles(found: DataFrame) -> DataFrame:
    """One row per article; a profile without articles keeps one row of NULLs."""
    rows = found.select("*", F.inline_outer("articles")).drop("articles")
    return rows.to(PROFILE_ARTICLES)
