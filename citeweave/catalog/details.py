"""Article details: pages rendered from documents."""

from pyspark.sql import functions as F

from ..constants import SITE
from ..plans.details import article_details, detail_join, detail_records
from ..rendering import article_pages, articles, table


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _records(spark, sf_dir):
    return detail_records(article_pages(_documents(spark, sf_dir))).select(F.col("url").alias("paper_url"), "record.*")


def _field(column, name=None):
    def query(spark, sf_dir):
        return _records(spark, sf_dir).filter("ok").select("paper_url", F.expr(column).alias(name or column))

    return query


def _inputs(spark, sf_dir):
    return articles(_documents(spark, sf_dir)).select("title", F.col("paper_url").alias("url"))


def annual(spark, sf_dir):
    return _records(spark, sf_dir).filter("ok").select("paper_url", F.explode("annual_citations").alias("year", "citations"))


def joined_twice(spark, sf_dir):
    """Articles listed by two people are looked up twice; a missing address or page drops the row."""
    rows = _inputs(spark, sf_dir)
    lost = rows.select("title", F.expr("CASE WHEN title LIKE '%(en)' THEN concat(url, '-gone') END").alias("url"))
    rows = rows.unionByName(rows).unionByName(lost)
    return detail_join(rows, article_pages(_documents(spark, sf_dir))).select("title", "paper_url", "authors")


def failed(spark, sf_dir):
    return _records(spark, sf_dir).select("paper_url", "ok")


def job(spark, sf_dir):
    """German articles are done already."""
    rows = _inputs(spark, sf_dir)
    done = rows.filter("title LIKE '%(de)'")
    return article_details(rows, article_pages(_documents(spark, sf_dir)), done).select(
        "title",
        "paper_url",
        "authors",
        "publication_date",
        "book",
        "pages",
        F.md5("description").alias("description_md5"),
        "total_citations",
        F.size("annual_citations").cast("bigint").alias("years"),
    )


QUERIES = {
    "detail_join": joined_twice,
    "article_authors": _field("authors"),
    "article_date": _field("publication_date"),
    "article_book": _field("book"),
    "article_page_range": _field("pages"),
    "article_description": _field("md5(description)", "description_md5"),
    "article_total_citations": _field("total_citations"),
    "article_annual_citations": annual,
    "bad_article": failed,
    "article_details_job": job,
}

KIND = "CAST(substr(source, 4) AS INT)"
TITLE = "'Study ' || doc_id || ' of ' || source || ' (' || lang || ')'"
URL = f"'{SITE}/citations?view_op=view_citation&doc=' || doc_id"
STRIPPED = "trim(text, chr(32) || chr(9) || chr(10) || chr(13))"
_OK = f"{KIND} NOT IN (2, 4)"
_AUTHORS = "'Author ' || doc_id || ',Team' || lang"
_DATE = f"(2000 + {KIND}) || '/1/2'"
_BOOK = f"CASE WHEN {KIND} <> 1 THEN 'Annals of ' || source END"
_RANGE = f"CASE WHEN {KIND} <> 6 THEN '1-' || n_chars END"
_TOTAL = f"CASE WHEN {KIND} <> 7 THEN n_chars::VARCHAR END"


def _select(column):
    return f"SELECT {URL} AS paper_url, {column} FROM documents WHERE {_OK}"


ORACLES = {
    "detail_join": f"""WITH found AS (SELECT {TITLE} AS title, {URL} AS paper_url, {_AUTHORS} AS authors
        FROM documents WHERE {_OK}) SELECT * FROM found UNION ALL SELECT * FROM found""",
    "article_authors": _select(f"{_AUTHORS} AS authors"),
    "article_date": _select(f"{_DATE} AS publication_date"),
    "article_book": _select(f"{_BOOK} AS book"),
    "article_page_range": _select(f"{_RANGE} AS pages"),
    "article_description": _select(f"md5({STRIPPED}) AS description_md5"),
    "article_total_citations": _select(f"{_TOTAL} AS total_citations"),
    "article_annual_citations": f"""SELECT {URL} AS paper_url, unnest(['2019', '2020']) AS year,
        unnest([doc_id, n_chars]) AS citations FROM documents WHERE {_OK} AND {KIND} <> 8""",
    "bad_article": f"SELECT {URL} AS paper_url, {_OK} AS ok FROM documents",
    "article_details_job": f"""SELECT {TITLE} AS title, {URL} AS paper_url, {_AUTHORS} AS authors,
            {_DATE} AS publication_date, {_BOOK} AS book, {_RANGE} AS pages, md5({STRIPPED}) AS description_md5,
            {_TOTAL} AS total_citations, CASE WHEN {KIND} = 8 THEN 0 ELSE 2 END::BIGINT AS years
        FROM documents WHERE {_OK} AND lang <> 'de'""",
}
