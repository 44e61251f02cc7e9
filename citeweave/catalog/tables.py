"""Scans, sinks, pending rows and projections."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import PEOPLE_SEARCH, SITE
from ..functions.text import absolute_url, people_search_url
from ..operators.html_nodes import html_nodes
from ..operators.pending import done_keys, pending
from ..operators.selectors import first_node, page_nodes, page_texts, tag, tight_text
from ..plans.citing import with_citation_link
from ..rendering import papers, people, table
from ..schemas import PAGES, SEEDS
from ..session import new_path
from ..sources.sinks import append_sink, csv_sink, replace_sink
from ..sources.tables import page_source, seed_scan, stage_scan, table_or_empty
from ..streaming.ingest import ingest

_TEXTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("words", T.ArrayType(T.StringType())),
    ]
)


def page_scan(spark, sf_dir):
    return page_source(spark, f"{sf_dir}/pages.parquet").select("page_id", "url", F.md5("html").alias("html_md5"))


def seeds(spark, sf_dir):
    """Customers' names written as a seed file with another column, and read back."""
    path = new_path(spark, "seeds")
    rows = people(table(spark, sf_dir, "customer")).select("c_custkey", "name")
    csv_sink(rows, path)
    return seed_scan(spark, path, "csv")


def csv_interchange(spark, sf_dir):
    """Whole texts (quotes, line breaks) and a nested column through a CSV table."""
    path = new_path(spark, "texts")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.array("lang", "source").alias("words"))
    csv_sink(rows, path)
    back = stage_scan(spark, path, _TEXTS, "csv")
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.explode("words").alias("word"))


def append_twice(spark, sf_dir):
    path = new_path(spark, "orders")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.array("o_orderstatus").alias("tags"))
    open_orders = F.col("tags")[0] == "O"
    append_sink(rows.filter(open_orders), path)
    append_sink(rows.filter(~open_orders), path)
    return stage_scan(spark, path, rows.schema).select("o_orderkey", "o_custkey", F.col("tags")[0].alias("status"))


def replace_keeps_old(spark, sf_dir):
    """A rewritten table still has the rows of earlier runs."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    first, second = new_path(spark, "first"), new_path(spark, "second")
    replace_sink(rows.filter("o_orderstatus = 'O'"), first + "-missing", first)
    replace_sink(rows.filter("o_orderstatus <> 'O'"), first, second)
    return stage_scan(spark, second, rows.schema)


def first_run(spark, sf_dir):
    """Without a table yet, everything is pending."""
    names = people(table(spark, sf_dir, "customer")).select("name")
    return pending(names, "name", table_or_empty(spark, new_path(spark, "missing"), SEEDS), "name")


def _null_row(df):
    return df.unionByName(df.sparkSession.createDataFrame([(None,) * len(df.columns)], df.schema))


def _names(spark, sf_dir):
    return people(table(spark, sf_dir, "customer")).select("name", "c_acctbal")


def pending_names(spark, sf_dir):
    """Customers in debt are done already; so is the NULL name."""
    done = _null_row(_names(spark, sf_dir).filter("c_acctbal < 0").select("name"))
    return pending(_null_row(_names(spark, sf_dir).select("name")), "name", done, "name")


def pending_articles(spark, sf_dir, **options):
    """A shared title (part name) is done or pending for all its rows; no NULL is done, so NULL stays."""
    parts = table(spark, sf_dir, "part")
    rows = _null_row(parts.select(F.col("p_name").alias("title"), F.col("p_partkey").alias("id")))
    return pending(rows, "title", parts.filter("p_size > 48").select(F.col("p_name").alias("title")), "title", **options)


def _matches(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size > 25").select(
        F.concat_ws(" ", "p_name", "p_partkey").alias("original_title"),
        F.expr("CASE WHEN p_type <> 'LARGE' THEN concat_ws(' ', p_name, p_partkey) END").alias("matched_title"),
    )


def _titles(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("title"))


def pending_titles(spark, sf_dir):
    return pending(_titles(spark, sf_dir), "title", _matches(spark, sf_dir), "original_title")


def pending_titles_by_match(spark, sf_dir):
    """Compared with the titles found, unmatched titles are pending again."""
    return pending(_titles(spark, sf_dir), "title", _matches(spark, sf_dir), "matched_title")


def pending_papers(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    edges = parts.filter("p_size > 25").select(F.concat_ws(" ", "p_name", "p_partkey").alias("original_paper_title"))
    return pending(papers(parts), "original_title", edges, "original_paper_title")


def done(spark, sf_dir):
    return done_keys(table(spark, sf_dir, "part"), "p_name").withColumnRenamed("_done", "done_key")


def search_urls(spark, sf_dir):
    names = people(table(spark, sf_dir, "customer")).select("name")
    return names.select("name", people_search_url(F.col("name")).alias("search_url"))


def absolute_urls(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    href = F.expr("CASE WHEN p_type <> 'SMALL' THEN concat('/part/', p_partkey) END")
    return parts.select("p_partkey", absolute_url(href).alias("url"))


def citation_links(spark, sf_dir):
    return with_citation_link(papers(table(spark, sf_dir, "part")))


def _headlines(pages):
    parsed = html_nodes(pages.select("page_id", "url", "html"), within=("h1",), attrs=())
    return parsed.select(
        "page_id", "url", tight_text(page_texts(), first_node(page_nodes(), tag("h1"))).alias("headline")
    )


def ingest_stream(spark, sf_dir):
    """The page table as a stream, ingested twice: the second run finds nothing new."""
    out, checkpoint = new_path(spark, "headlines"), new_path(spark, "log")
    # A stream takes no path of a single file. This pattern names the table alone, be it a file or a folder of files.
    for _ in range(2):
        ingest(spark, f"{sf_dir}/pages.parque[t]", _headlines, out, checkpoint, pattern="*")
    return spark.read.parquet(out)


def ingest_then_append(spark, sf_dir):
    """What is appended to a table that a stream has written stays visible, and so does what comes later."""
    pages = stage_scan(spark, f"{sf_dir}/pages.parquet", PAGES)
    folder, out, checkpoint = (new_path(spark, n) for n in ("pages", "headlines", "log"))
    for rest in range(3):
        part = pages.filter(F.col("page_id") % 3 == rest)
        if rest == 1:
            append_sink(_headlines(part), out)
        else:
            append_sink(part, folder)
            ingest(spark, folder, _headlines, out, checkpoint)
    return stage_scan(spark, out, _headlines(pages).schema)


def ingest_in_batches(spark, sf_dir):
    """Ten files of pages, three at a time: four batches, each saved when it is done."""
    folder, out, checkpoint = (new_path(spark, n) for n in ("pages", "headlines", "log"))
    page_source(spark, f"{sf_dir}/pages.parquet").repartition(10, "page_id").write.parquet(folder)
    ingest(spark, folder, _headlines, out, checkpoint, max_files=3)
    rows = spark.read.parquet(out).select("*", F.regexp_extract(F.input_file_name(), r"batch-(\d+)-", 1).cast("long").alias("batch"))
    last = rows.agg(F.max("batch")).first()[0]
    return rows.select("page_id", "headline", F.lit(last).cast("bigint").alias("last_batch"))


QUERIES = {
    "page_source": page_scan,
    "seed_scan": seeds,
    "stage_scan": csv_interchange,
    "append_sink": append_twice,
    "replace_sink": replace_keeps_old,
    "first_run_table": first_run,
    "ingest_stream": ingest_stream,
    "ingest_then_append": ingest_then_append,
    "ingest_in_batches": ingest_in_batches,
    "pending_names": pending_names,
    "pending_articles": pending_articles,
    "pending_hot_key": lambda spark, sf_dir: pending_articles(spark, sf_dir, hot_rows=2),
    "pending_titles": pending_titles,
    "pending_titles_by_match": pending_titles_by_match,
    "pending_papers": pending_papers,
    "done_keys": done,
    "search_url": search_urls,
    "absolute_url": absolute_urls,
    "citation_link_filter": citation_links,
}

NAME = "c_name || ', ' || c_mktsegment || ' team'"
PAPER = "p_name || ' ' || p_partkey"
_CITES = f"CASE WHEN p_type <> 'SMALL' THEN '{SITE}/scholar?cites=' || p_partkey END"
_PAPERS = f"""SELECT {PAPER} AS original_title, 'https://paper.example/' || p_partkey AS url,
    {_CITES} AS cited_articles_url FROM part"""
# Text of a heading on the given pages: one escaped run.
UNESCAPED_H1 = r"""replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')"""

ORACLES = {
    "page_source": "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
    "seed_scan": f"SELECT {NAME} AS name FROM customer",
    "stage_scan": "SELECT doc_id, md5(text) AS text_md5, unnest([lang, source]) AS word FROM documents",
    "append_sink": "SELECT o_orderkey, o_custkey, o_orderstatus AS status FROM orders",
    "replace_sink": "SELECT o_orderkey, o_orderstatus FROM orders",
    "first_run_table": f"SELECT {NAME} AS name FROM customer",
    "ingest_stream": f"SELECT page_id, url, trim({UNESCAPED_H1}) AS headline FROM pages",
    "ingest_then_append": f"SELECT page_id, url, trim({UNESCAPED_H1}) AS headline FROM pages",
    "ingest_in_batches": f"SELECT page_id, trim({UNESCAPED_H1}) AS headline, 3::BIGINT AS last_batch FROM pages",
    "pending_names": f"""WITH names AS (SELECT {NAME} AS name FROM customer UNION ALL SELECT NULL),
        done AS (SELECT {NAME} AS done FROM customer WHERE c_acctbal < 0 UNION ALL SELECT NULL)
        SELECT name FROM names WHERE NOT EXISTS (SELECT 1 FROM done WHERE done IS NOT DISTINCT FROM name)""",
    "pending_articles": """WITH rows AS (SELECT p_name AS title, p_partkey AS id FROM part UNION ALL SELECT NULL, NULL)
        SELECT title, id FROM rows WHERE NOT EXISTS
            (SELECT 1 FROM part WHERE p_size > 48 AND p_name IS NOT DISTINCT FROM title)""",
    "pending_titles": f"SELECT {PAPER} AS title FROM part WHERE NOT p_size > 25",
    "pending_titles_by_match": f"SELECT {PAPER} AS title FROM part WHERE NOT (p_size > 25 AND p_type <> 'LARGE')",
    "pending_papers": f"{_PAPERS} WHERE NOT p_size > 25",
    "done_keys": "SELECT DISTINCT p_name AS done_key FROM part",
    "search_url": f"""SELECT {NAME} AS name,
        '{PEOPLE_SEARCH}' || replace(replace({NAME}, ' ', '+'), ',', '%2C') AS search_url FROM customer""",
    "absolute_url": f"""SELECT p_partkey,
        CASE WHEN p_type <> 'SMALL' THEN '{SITE}/part/' || p_partkey END AS url FROM part""",
    "citation_link_filter": f"SELECT * FROM ({_PAPERS}) WHERE cited_articles_url IS NOT NULL",
}

# Titles of more than two rows are dealt out as hot ones: the same rows are pending.
ORACLES["pending_hot_key"] = ORACLES["pending_articles"]
