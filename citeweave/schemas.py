"""Explicit schemas of every table. All fields are nullable; nothing is inferred."""

from pyspark.sql import types as T


def _table(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S = T.StringType()
_ARTICLE = _table(("title", _S), ("year", _S), ("url", _S))

PAGES = _table(("page_id", T.LongType()), ("url", _S), ("html", _S))

SEEDS = _table(("name", _S))

RESOLVED = _table(("name", _S), ("researcher_url", _S))

_PROFILE_FIELDS = (
    ("name", _S),
    ("researcher_url", _S),
    ("position", _S),
    ("institution_href", _S),
    ("institution", _S),
    ("personal_website", _S),
    ("research_areas", _S),
    ("total_citations", _S),
    ("h_index", _S),
    ("i10_index", _S),
    ("annual_citations", T.MapType(_S, _S)),
    ("total_access_articles", T.LongType()),
)

PROFILES = _table(*_PROFILE_FIELDS, ("articles", T.ArrayType(_ARTICLE)))

PROFILE_ARTICLES = _table(*_PROFILE_FIELDS, ("title", _S), ("year", _S), ("url", _S))

ARTICLE_DETAILS = _table(
    ("title", _S),
    ("paper_url", _S),
    ("authors", _S),
    ("publication_date", _S),
    ("book", _S),
    ("pages", _S),
    ("description", _S),
    ("total_citations", _S),
    ("annual_citations", T.MapType(_S, T.LongType())),
)

MATCHES = _table(
    ("matched_title", _S),
    ("url", _S),
    ("abstract", _S),
    ("cited_articles_url", _S),
    ("authors_with_urls", T.MapType(_S, _S)),
    ("original_title", _S),
    ("original_url", _S),
)

CITING_EDGES = _table(
    ("original_paper_title", _S),
    ("original_paper_url", _S),
    ("original_cited_page_url", _S),
    ("cited_article_title", _S),
    ("cited_article_url", _S),
    ("next_cited_articles_url", _S),
)

# One element of a parsed page; `id` is its index in the page's array, so the
# elements inside it are exactly the indexes id+1 .. end. `class_raw` is the class
# attribute with one blank before, between and after its tokens, so that a class
# test is one substring search instead of an array per element.
NODE = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("parent", T.IntegerType(), False),
        T.StructField("tag", _S, False),
        T.StructField("elem_id", _S, True),
        T.StructField("class_raw", _S, True),
        T.StructField("attrs", T.MapType(_S, _S, False), True),
        T.StructField("own_string", _S, True),
        T.StructField("text_from", T.IntegerType(), False),
        T.StructField("text_to", T.IntegerType(), False),
    ]
)
