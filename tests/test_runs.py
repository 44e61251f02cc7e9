"""Repeated runs: streaming ingest and the chain of jobs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from citeweave import ingest, run_chain
from citeweave.operators import hot_keys
from citeweave.plans.profiles import profile_records
from citeweave.rendering import chain_pages, people, profile_pages, table

SF = "/root/testdata/sf0.001"


def test_ingest_processes_each_file_once(spark, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("pages", "out", "log"))
    pages = profile_pages(table(spark, SF, "customer"))
    half = F.col("page_id") < 75

    def extract(df):
        return profile_records(df).select("url", "record.*")

    def run():
        ingest(spark, folder, extract, out, log, max_files=2)
        return spark.read.parquet(out)

    pages.filter(half).repartition(3).write.parquet(folder)
    assert run().count() == pages.filter(half).count()
    assert run().count() == pages.filter(half).count()
    pages.filter(~half).write.mode("append").parquet(folder)
    found = run()
    expected = extract(pages)
    assert found.count() == expected.count() == found.select("url").distinct().count()
    columns = ["url", "position", "total_citations", "total_access_articles"]
    assert Counter(found.select(columns).collect()) == Counter(expected.select(columns).collect())


@pytest.mark.parametrize("narrow", [True, False])
def test_chain_resumes(spark, tmp_path, monkeypatch, narrow):
    """Half of the people first, then all: the tables end as after one run, and a further run adds nothing."""
    if not narrow:
        monkeypatch.setattr(hot_keys, "MAX_BROADCAST_KEYS", 0)
    customer = table(spark, SF, "customer").filter("c_nationkey BETWEEN 5 AND 9")
    seeds, pages = people(customer), chain_pages(customer)
    first, second = seeds.filter("c_acctbal < 3000").select("name"), seeds.select("name")

    def counts(tables):
        return {name: df.count() for name, df in tables.items()}

    folder = str(tmp_path / "tables")
    some = counts(run_chain(first, pages, folder))
    whole = run_chain(second, pages, folder)
    assert 0 < some["profiles"] < whole["profiles"].count()
    found = counts(whole)
    again = run_chain(second, pages, folder)
    assert counts(again) == found
    edges = [tuple(r) for r in again["citing_edges"].collect()]
    assert len(edges) == len(set(edges)) > 0
    once = run_chain(second, pages, str(tmp_path / "once"))
    assert counts(once) == found


def test_plain_session_without_a_set_folder(spark, monkeypatch):
    """A session whose settings name no shared folder can still run the jobs."""
    from citeweave import profiles, session

    class NoFolder:
        """The session's settings, but for the one key."""

        def get(self, key, *default):
            return default[0] if key == "spark.checkpoint.dir" else spark.conf.get(key, *default)

    class Plain:
        conf, sparkContext = NoFolder(), spark.sparkContext

    monkeypatch.setattr(session, "_FALLBACK", {})
    folder = session.shared_folder(Plain())
    assert folder == session.shared_folder(Plain()) and folder
    monkeypatch.setattr(session, "shared_folder", lambda _: folder)
    customer = table(spark, SF, "customer").limit(5)
    assert profiles(people(customer).select("name"), chain_pages(customer)).count() >= 0


def test_tied_pages_are_settled_by_their_hash(spark):
    from citeweave.plans.profiles import profile_join

    customer = table(spark, SF, "customer").filter("c_nationkey = 5")
    pages = profile_pages(customer).withColumn("page_id", F.lit(None).cast("bigint"))
    rows = people(customer).select("name", "researcher_url")
    twice = pages.unionByName(pages).unionByName(pages.withColumn("html", F.lit("<p>tied")))
    first = {tuple(r) for r in profile_join(rows, twice.repartition(3)).select("name", "h_index").collect()}
    again = {tuple(r) for r in profile_join(rows, twice.repartition(7)).select("name", "h_index").collect()}
    assert first == again and len(first) == rows.count()


def test_interrupted_batch_is_replaced(spark, tmp_path):
    """A batch that was moved but not logged is written again in place of its own rows."""
    from citeweave.streaming.ingest import _place_batch

    table_path, staged = str(tmp_path / "table"), str(tmp_path / "staged")
    for rows in (5, 3):
        spark.range(rows).write.mode("overwrite").parquet(staged)
        _place_batch(spark, staged, table_path, 4)
        assert spark.read.parquet(table_path).count() == rows
    spark.range(10).write.mode("append").parquet(table_path)
    assert spark.read.parquet(table_path).count() == 13


@pytest.mark.parametrize("n", [300])
def test_unclosed_results_stay_small(spark, n):
    from citeweave.plans.matching import result_records

    blocks = "".join(f'<div class="gs_r gs_or gs_scl"><h3 class="gs_rt"><a href="/p{i}">Title {i}</a></h3>' for i in range(n))
    pages = spark.createDataFrame([("u", 1, blocks)], "url string, page_id long, html string")
    (row,) = result_records(pages).collect()
    assert [r.result.url for r in row.record.results] == [f"/p{i}" for i in range(n)]


def test_links_as_a_browser_reports_them(spark):
    from citeweave.functions.text import browser_url

    links = [("/a?b", "https://scholar.google.com/a?b"), ("//h/x", "https://h/x"), ("c?user=x", "https://scholar.google.com/c?user=x")]
    links += [("http://o/x", "http://o/x"), ("mailto:a@b", "mailto:a@b"), (None, None)]
    got = spark.createDataFrame(links, "link string, want string").select(browser_url(F.col("link")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)
