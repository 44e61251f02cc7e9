"""Title matching: result pages rendered from documents."""

from pyspark.sql import functions as F

from ..constants import SITE
from ..functions.text import candidate_title, collapse, match_key, normalize_text
from ..plans.matching import choose_result, match_titles, result_records, search_join
from ..rendering import articles, result_pages, table
from .details import KIND, STRIPPED, TITLE, URL


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _titles(spark, sf_dir):
    return articles(_documents(spark, sf_dir)).select("title", "paper_url")


def _joined(spark, sf_dir):
    return search_join(_titles(spark, sf_dir), result_pages(_documents(spark, sf_dir)))


def _matches(spark, sf_dir):
    return choose_result(_joined(spark, sf_dir))


def _unmarked(text):
    """Without combining marks, for comparison with SQL that cannot decompose letters."""
    return F.md5(F.regexp_replace(text, r"\p{Mn}+", ""))


def normalized(spark, sf_dir):
    """Whole texts in curly quotes."""
    quoted = F.concat(F.lit(" “"), F.col("text"), F.lit("” "))
    return _documents(spark, sf_dir).select("doc_id", _unmarked(normalize_text(quoted)).alias("text_md5"))


def candidates(spark, sf_dir):
    """Whole texts after a prefix in brackets."""
    heading = F.concat(F.lit("[CITATION] [C]\t"), F.col("text"), F.lit(" [18F]end"))
    return _documents(spark, sf_dir).select("doc_id", _unmarked(candidate_title(heading)).alias("title_md5"))


def keys(spark, sf_dir):
    title = F.concat(F.lit("'"), F.col("text"), F.lit("'"))
    return _documents(spark, sf_dir).select("doc_id", _unmarked(match_key(collapse(title))).alias("key_md5"))


def searched(spark, sf_dir):
    """Every title once, with the number of results its page holds."""
    return _joined(spark, sf_dir).select(
        "original_title", "original_url", F.size("record.results").cast("bigint").alias("results")
    )


def first_exact(spark, sf_dir):
    rows = _matches(spark, sf_dir).filter(F.lower("matched_title") == F.lower("original_title"))
    return rows.select("original_title", "url")


def lone(spark, sf_dir):
    rows = _matches(spark, sf_dir).filter("matched_title LIKE '[PDF]%'")
    return rows.select("original_title", "matched_title", "url")


def abstracts(spark, sf_dir):
    return _matches(spark, sf_dir).select("original_title", "matched_title", F.md5("abstract").alias("abstract_md5"))


def cited_by(spark, sf_dir):
    results = result_records(result_pages(_documents(spark, sf_dir))).select("url", F.inline("record.results"))
    return results.select("url", "result.cited_articles_url")


def authors(spark, sf_dir):
    rows = _matches(spark, sf_dir)
    return rows.select("original_title", F.explode("authors_with_urls").alias("author", "author_url"))


def unmatched(spark, sf_dir):
    rows = _matches(spark, sf_dir).filter("matched_title IS NULL")
    return rows.select("original_title", "url", "abstract", F.size("authors_with_urls").cast("bigint").alias("authors"))


def originals(spark, sf_dir):
    return _matches(spark, sf_dir).select("original_title", "original_url")


def job(spark, sf_dir, **options):
    """Spanish titles are done already."""
    done = _titles(spark, sf_dir).filter("title LIKE '%(es)'").withColumnRenamed("title", "original_title")
    found = match_titles(_titles(spark, sf_dir), result_pages(_documents(spark, sf_dir)), done, **options)
    return found.select(
        "matched_title",
        "url",
        F.md5("abstract").alias("abstract_md5"),
        "cited_articles_url",
        F.size("authors_with_urls").cast("bigint").alias("authors"),
        "original_title",
        "original_url",
    )


QUERIES = {
    "normalize_text": normalized,
    "candidate_title": candidates,
    "match_key": keys,
    "search_join": searched,
    "first_exact_match": first_exact,
    "lone_result": lone,
    "match_abstract": abstracts,
    "cited_by_link": cited_by,
    "match_authors": authors,
    "unmatched_titles": unmatched,
    "attach_originals": originals,
    "match_titles_job": job,
    "match_titles_job_scan": lambda spark, sf_dir: job(spark, sf_dir, plan="scan"),
}

_CASE = f"({KIND} % 10)"
_LINK = "'https://paper.example/' || doc_id"
_MATCHED = f"""CASE {_CASE} WHEN 0 THEN {TITLE} WHEN 1 THEN upper({TITLE}) WHEN 2 THEN {TITLE}
    WHEN 3 THEN {TITLE} WHEN 4 THEN {TITLE} WHEN 5 THEN '[PDF] Otherstudy' || doc_id END"""
_HREF = f"CASE WHEN {_CASE} IN (0, 1, 3, 4, 5) THEN {_LINK} END"
_RS = "trim(text || ' end', chr(32) || chr(9) || chr(10) || chr(13))"
_ABSTRACT = f"""CASE {_CASE} WHEN 0 THEN {STRIPPED} WHEN 1 THEN {_RS} WHEN 2 THEN '' WHEN 4 THEN {_RS}
    WHEN 5 THEN trim(text || 'inner', chr(32) || chr(9) || chr(10) || chr(13)) || ' inner' END"""
_CITED = f"'{SITE}/scholar?cites=' || doc_id"
_HAS_TAIL = f"{_CASE} IN (0, 2, 3, 5, 9)"
_CITED_BY = f"CASE WHEN {_HAS_TAIL} THEN {_CITED} END"
_COUNT = f"CASE {_CASE} WHEN 0 THEN 1 WHEN 5 THEN 1 WHEN 7 THEN 0 WHEN 8 THEN NULL WHEN 9 THEN 1 ELSE 2 END::BIGINT"
_AUTHORS = f"CASE WHEN {_HAS_TAIL} THEN 2 WHEN {_CASE} IN (1, 4) THEN 1 ELSE 0 END::BIGINT"
_COLLAPSED = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_QUERY_URL = f"""'{SITE}/scholar?q=' || replace(replace(replace({TITLE}, ' ', '+'), '(', '%28'), ')', '%29')"""

ORACLES = {
    "normalize_text": """SELECT doc_id, md5(strip_accents(regexp_replace(text, '\\s+', ' ', 'g'))) AS text_md5 FROM documents""",
    "candidate_title": f"""SELECT doc_id, md5(strip_accents({_COLLAPSED.format(
        "regexp_replace(regexp_replace(text || ' [18F]end', '\\s+', ' ', 'g'), '[[].*?[]]', '', 'g')"
    )})) AS title_md5 FROM documents""",
    "match_key": """SELECT doc_id, md5(strip_accents(lower(regexp_replace(text, '\\s+', ' ', 'g')))) AS key_md5 FROM documents""",
    "search_join": f"SELECT {TITLE} AS original_title, {URL} AS original_url, {_COUNT} AS results FROM documents",
    "first_exact_match": f"SELECT {TITLE} AS original_title, {_HREF} AS url FROM documents WHERE {_CASE} < 5",
    "lone_result": f"""SELECT {TITLE} AS original_title, '[PDF] Otherstudy' || doc_id AS matched_title, {_LINK} AS url
        FROM documents WHERE {_CASE} = 5""",
    "match_abstract": f"""SELECT {TITLE} AS original_title, {_MATCHED} AS matched_title, md5({_ABSTRACT}) AS abstract_md5
        FROM documents""",
    "cited_by_link": f"""SELECT {_QUERY_URL} AS url, {_CITED_BY} AS cited_articles_url FROM documents
            WHERE {_CASE} IN (0, 1, 2, 3, 4, 5, 9)
        UNION ALL SELECT {_QUERY_URL}, NULL FROM documents WHERE {_CASE} IN (1, 2, 3)
        UNION ALL SELECT {_QUERY_URL}, {_CITED} FROM documents WHERE {_CASE} = 4
        UNION ALL SELECT {_QUERY_URL}, NULL FROM (SELECT *, unnest([1, 2]) FROM documents) WHERE {_CASE} = 6""",
    "match_authors": f"""SELECT {TITLE} AS original_title, 'A. Author' AS author,
            CASE WHEN {_HAS_TAIL} THEN '{SITE}/citations?user=' || doc_id ELSE '{SITE}/citations?user=one' END AS author_url
            FROM documents WHERE {_HAS_TAIL} OR {_CASE} IN (1, 4)
        UNION ALL SELECT {TITLE}, 'B. Nolink', NULL FROM documents WHERE {_HAS_TAIL}""",
    "unmatched_titles": f"""SELECT {TITLE} AS original_title, NULL::VARCHAR AS url, NULL::VARCHAR AS abstract,
            {_AUTHORS} AS authors FROM documents WHERE {_CASE} > 5""",
    "attach_originals": f"SELECT {TITLE} AS original_title, {URL} AS original_url FROM documents",
    "match_titles_job": f"""SELECT {_MATCHED} AS matched_title, {_HREF} AS url, md5({_ABSTRACT}) AS abstract_md5,
            {_CITED_BY} AS cited_articles_url, {_AUTHORS} AS authors, {TITLE} AS original_title, {URL} AS original_url
        FROM documents WHERE lang <> 'es'""",
}

# The plan that large inputs take gives the same rows.
ORACLES["match_titles_job_scan"] = ORACLES["match_titles_job"]
