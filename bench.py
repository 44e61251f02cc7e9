"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Sample pages are rendered and stored once, before any timing, so a job's time is that of its
own work: pending rows, lookups, parsing, extraction. Each query runs once to warm up and
then $BENCH_RUNS times (default 3); its median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from citeweave.plans.citing import citing_edges, listing_records
from citeweave.plans.details import article_details
from citeweave.plans.matching import match_titles
from citeweave.plans.profiles import explode_articles, profile_records, profiles
from citeweave.operators.html_nodes import html_nodes
from citeweave.rendering import (
    article_pages,
    articles,
    listing_pages,
    papers,
    people,
    people_search_pages,
    profile_pages,
    result_pages,
    table,
)
from citeweave.session import build_session, materialise, spread
from citeweave.sources.tables import page_source

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main():
    spark = build_session(
        "citeweave-bench",
        f"local[{CPUS}]",
        **{
            "spark__sql__shuffle__partitions": str(CPUS),
            "spark__ui__enabled": "false",
            "spark__ui__showConsoleProgress": "false",
            "spark__driver__memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    customer, documents, part = (table(spark, SF_DIR, n) for n in ("customer", "documents", "part"))

    def stored(pages, name):
        return materialise(pages.repartition(4 * CPUS), name)

    profile = stored(profile_pages(customer), "profile")
    people_pages = stored(people_search_pages(customer).unionByName(profile_pages(customer)), "people")
    article = stored(article_pages(documents), "article")
    results = stored(result_pages(documents), "result")
    listing = stored(listing_pages(part), "listing")
    seeds = materialise(people(customer).select("name"), "seeds")
    titles = materialise(articles(documents).select("title", "paper_url"), "titles")
    paper = materialise(papers(part), "papers")

    queries = {
        "html_nodes": lambda: html_nodes(spread(page_source(spark, f"{SF_DIR}/pages.parquet"))).select(
            "page_id", F.size("nodes").alias("n")
        ),
        "profile_records": lambda: profile_records(profile),
        "listing_records": lambda: listing_records(listing),
        "profiles_job": lambda: profiles(seeds, people_pages),
        "profile_articles_job": lambda: explode_articles(profiles(seeds, people_pages)),
        "article_details_job": lambda: article_details(
            titles.withColumnRenamed("paper_url", "url"), article, None
        ),
        "match_titles_job": lambda: match_titles(titles, results),
        "citing_edges_job": lambda: citing_edges(paper, listing),
    }
    pages_read = {
        "html_nodes": page_source(spark, f"{SF_DIR}/pages.parquet").count(),
        "profile_records": profile.count(),
        "listing_records": listing.count(),
        "profiles_job": people_pages.count(),
        "profile_articles_job": people_pages.count(),
        "article_details_job": article.count(),
        "match_titles_job": results.count(),
        "citing_edges_job": listing.count(),
    }
    seconds, rows = {}, {}
    for name, query in queries.items():
        rows[name] = query().count()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
                "rows": rows,
                "pages_per_second": {n: round(pages_read[n] / seconds[n]) for n in seconds},
                "rows_per_second": {n: round(rows[n] / seconds[n]) for n in seconds},
            }
        )
    )


if __name__ == "__main__":
    main()
