"""Profiles: pages rendered from customers."""

from pyspark.sql import functions as F

from ..constants import SITE
from ..plans.profiles import (
    explode_articles,
    profile_join,
    profile_records,
    profiles,
    resolve_profiles,
)
from ..rendering import people, people_search_pages, profile_pages, table
from .tables import NAME


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer")


def _records(spark, sf_dir, *fields):
    """The named fields of the profile pages, and whether a page is readable."""
    return profile_records(profile_pages(_customers(spark, sf_dir)), fields).select("url", "record.*")


def _field(*names):
    def query(spark, sf_dir):
        return _records(spark, sf_dir, *names).filter("ok").select("url", *names)

    return query


def _pages(spark, sf_dir):
    customers = _customers(spark, sf_dir)
    return people_search_pages(customers).unionByName(profile_pages(customers))


def _seeds(spark, sf_dir):
    return people(_customers(spark, sf_dir)).select("name")


def resolved(spark, sf_dir):
    return resolve_profiles(_seeds(spark, sf_dir), people_search_pages(_customers(spark, sf_dir)))


def joined(spark, sf_dir):
    """Names with an address, against pages; every fifth kind of customer has no address."""
    rows = people(_customers(spark, sf_dir)).select(
        "name", F.expr("CASE WHEN c_mktsegment <> 'BUILDING' THEN researcher_url END").alias("researcher_url")
    )
    return profile_join(rows, profile_pages(_customers(spark, sf_dir))).select("name", "researcher_url", "h_index")


def without_page_id(spark, sf_dir):
    """Pages without an id, and pages stored three times: the copies that are older or have no id say nothing."""
    pages = profile_pages(_customers(spark, sf_dir))
    bare = F.col("page_id") % 5 == 0
    old = pages.filter(~bare).withColumn("html", F.lit("<p>an older page"))
    new = pages.withColumn("page_id", F.when(~bare, F.col("page_id") + 1_000_000))
    older = old.unionByName(old.withColumn("page_id", F.lit(None).cast("bigint")))
    rows = people(_customers(spark, sf_dir)).select("name", "researcher_url")
    found = profile_join(rows, new.unionByName(older))
    return found.select("name", "researcher_url", "h_index")


def annual(spark, sf_dir):
    rows = _records(spark, sf_dir, "annual_citations").filter("ok")
    return rows.select("url", F.explode("annual_citations").alias("year", "citations"))


def articles_of_pages(spark, sf_dir):
    return _records(spark, sf_dir, "articles").filter("ok").select("url", F.inline("articles")).toDF("page_url", "title", "year", "url")


def exploded(spark, sf_dir):
    rows = profile_join(
        people(_customers(spark, sf_dir)).select("name", "researcher_url"), profile_pages(_customers(spark, sf_dir))
    )
    return explode_articles(rows).select("name", "position", "title", "year", "url")


def bad_pages(spark, sf_dir):
    return _records(spark, sf_dir).select("url", "ok")


def profile_job(spark, sf_dir, **options):
    found = profiles(_seeds(spark, sf_dir), _pages(spark, sf_dir), **options)
    return found.select(
        "name",
        "researcher_url",
        "position",
        "institution_href",
        "institution",
        "personal_website",
        "research_areas",
        "total_citations",
        "h_index",
        "i10_index",
        "total_access_articles",
        F.size("annual_citations").cast("bigint").alias("years"),
        F.size("articles").cast("bigint").alias("articles"),
    )


def profile_articles_job(spark, sf_dir):
    found = explode_articles(profiles(_seeds(spark, sf_dir), _pages(spark, sf_dir)))
    return found.select("name", "researcher_url", "total_citations", "title", "year", "url")


QUERIES = {
    "resolve_profile": resolved,
    "profile_join": joined,
    "lookup_without_page_id": without_page_id,
    "position": _field("position"),
    "institution": _field("institution"),
    "institution_href": _field("institution_href"),
    "personal_website": _field("personal_website"),
    "research_areas": _field("research_areas"),
    "profile_metrics": _field("total_citations", "h_index", "i10_index"),
    "profile_annual_citations": annual,
    "access_articles": _field("total_access_articles"),
    "page_articles": articles_of_pages,
    "explode_articles": exploded,
    "bad_page": bad_pages,
    "profiles_job": profile_job,
    "profiles_job_scan": lambda spark, sf_dir: profile_job(spark, sf_dir, plan="scan"),
    "profile_articles_job": profile_articles_job,
}

_URL = f"'{SITE}/citations?hl=en&user=' || c_custkey"
_OK = "c_nationkey NOT IN (7, 13, 19)"
_POSITION = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Professor of BUILDING'
    WHEN 'AUTOMOBILE' THEN 'College director ' || c_nationkey
    WHEN 'HOUSEHOLD' THEN 'Prof. emeritus atAcme & Sons ' || c_nationkey END"""
_INSTITUTION = """CASE c_mktsegment WHEN 'BUILDING' THEN 'University of Nation ' || c_nationkey
    WHEN 'MACHINERY' THEN 'Campus' || chr(160) || c_nationkey
    WHEN 'HOUSEHOLD' THEN 'Acme & Sons ' || c_nationkey END"""
_HREF = f"CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN '{SITE}/org?id=' || c_nationkey END"
_WEBSITE = "CASE WHEN c_acctbal > 5000 THEN 'https://site.example/' || c_custkey || '?a=1&b=2' END"
_AREAS = "CASE WHEN c_acctbal > 5000 THEN lower(c_mktsegment) || ', nation' || c_nationkey ELSE '' END"
_H_INDEX = "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'last' ELSE c_nationkey::VARCHAR END"
_ACCESS = """CASE c_mktsegment WHEN 'BUILDING' THEN c_nationkey + c_custkey WHEN 'AUTOMOBILE' THEN c_nationkey
    WHEN 'MACHINERY' THEN c_custkey WHEN 'HOUSEHOLD' THEN 0 END::BIGINT"""
_ARTICLES = f"""SELECT *, 'Paper ' || k || ' of ' || c_name || ' & co' AS title, (1990 + k)::VARCHAR AS year,
    CASE WHEN k <> 6 THEN '{SITE}/citations?view_op=view_citation&id=' || c_custkey || ':' || k END AS url
    FROM (SELECT *, unnest(range(1, c_nationkey + 1)) AS k FROM customer) WHERE k <> 5"""
_FOUND = f"{_OK} AND c_mktsegment <> 'BUILDING'"
# Customers' articles, and one row of NULLs for a customer without any.
_EXPLODED = f"""SELECT c.*, a.title, a.year, a.url FROM customer c LEFT JOIN ({_ARTICLES}) a ON a.c_custkey = c.c_custkey"""


def _select(column):
    return f"SELECT {_URL} AS url, {column} FROM customer WHERE {_OK}"


ORACLES = {
    "resolve_profile": f"""SELECT {NAME} AS name,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN {_URL} END AS researcher_url FROM customer""",
    "profile_join": f"SELECT {NAME} AS name, {_URL} AS researcher_url, {_H_INDEX} AS h_index FROM customer WHERE {_FOUND}",
    "lookup_without_page_id": f"SELECT {NAME} AS name, {_URL} AS researcher_url, {_H_INDEX} AS h_index FROM customer WHERE {_OK}",
    "position": _select(f"{_POSITION} AS position"),
    "institution": _select(f"{_INSTITUTION} AS institution"),
    "institution_href": _select(f"{_HREF} AS institution_href"),
    "personal_website": _select(f"{_WEBSITE} AS personal_website"),
    "research_areas": _select(f"{_AREAS} AS research_areas"),
    "profile_metrics": _select(
        f"(c_custkey * 7)::VARCHAR AS total_citations, {_H_INDEX} AS h_index, (c_nationkey + 1)::VARCHAR AS i10_index"
    ),
    "profile_annual_citations": f"""SELECT {_URL} AS url, (1999 + i)::VARCHAR AS year, (c_custkey + i)::VARCHAR AS citations
        FROM (SELECT *, unnest(range(1, least(c_nationkey, 20) + 1)) AS i FROM customer WHERE {_OK})""",
    "access_articles": _select(f"{_ACCESS} AS total_access_articles"),
    "page_articles": f"SELECT {_URL} AS page_url, title, year, url FROM ({_ARTICLES}) WHERE {_OK}",
    "explode_articles": f"""SELECT {NAME} AS name, {_POSITION} AS position, title, year, url FROM ({_EXPLODED}) WHERE {_OK}""",
    "bad_page": f"SELECT {_URL} AS url, {_OK} AS ok FROM customer",
    "profiles_job": f"""SELECT {NAME} AS name, {_URL} AS researcher_url, {_POSITION} AS position,
            {_HREF} AS institution_href, {_INSTITUTION} AS institution, {_WEBSITE} AS personal_website,
            {_AREAS} AS research_areas, (c_custkey * 7)::VARCHAR AS total_citations, {_H_INDEX} AS h_index,
            (c_nationkey + 1)::VARCHAR AS i10_index, {_ACCESS} AS total_access_articles,
            least(c_nationkey, 20)::BIGINT AS years,
            (c_nationkey - CASE WHEN c_nationkey >= 5 THEN 1 ELSE 0 END)::BIGINT AS articles
        FROM customer WHERE {_FOUND}""",
    "profile_articles_job": f"""SELECT {NAME} AS name, {_URL} AS researcher_url,
            (c_custkey * 7)::VARCHAR AS total_citations, title, year, url FROM ({_EXPLODED}) WHERE {_FOUND}""",
}

# The plan that large inputs take gives the same rows.
ORACLES["profiles_job_scan"] = ORACLES["profiles_job"]
