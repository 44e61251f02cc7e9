"""Stored web pages to bibliographic tables, as Spark jobs."""

from .plans.chain import run_chain
from .plans.citing import citing_edges
from .plans.details import article_details
from .plans.matching import match_titles
from .plans.profiles import explode_articles, profiles
from .plans.records import RecordStore
from .plans.steps import run_in_steps
from .sources.commits import CommitTable
from .sources.sinks import append_sink, csv_sink, replace_sink
from .sources.tables import page_source, seed_scan, stage_scan, table_or_empty
from .streaming.ingest import ingest, ingest_records

__all__ = [
    "CommitTable",
    "RecordStore",
    "append_sink",
    "article_details",
    "citing_edges",
    "csv_sink",
    "explode_articles",
    "ingest",
    "ingest_records",
    "match_titles",
    "page_source",
    "profiles",
    "replace_sink",
    "run_chain",
    "run_in_steps",
    "seed_scan",
    "stage_scan",
    "table_or_empty",
]
