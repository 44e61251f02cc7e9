"""Stored records in place of pages, batch by batch and step by step."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from citeweave import explode_articles, ingest_records, run_chain
from citeweave.plans import records as R
from citeweave.plans import steps as S
from citeweave.plans.citing import citing_edges
from citeweave.plans.details import article_details, detail_join
from citeweave.plans.matching import match_titles
from citeweave.plans.profiles import profile_join, profiles, resolve_profiles
from citeweave.plans.records import KINDS, RecordStore
from citeweave.rendering import chain_pages, people, profile_pages, table
from citeweave.session import materialise
from citeweave.sources.commits import CommitTable

SF = "/root/testdata/sf0.001"
NATIONS = "c_nationkey IN (4, 6)"


def same(a, b):
    return Counter(map(repr, a.collect())) == Counter(map(repr, b.collect()))


@pytest.fixture(scope="module")
def chain(spark):
    customer = table(spark, SF, "customer").filter(NATIONS)
    return people(customer).select("name"), materialise(chain_pages(customer), "pages")


@pytest.fixture(scope="module")
def whole(spark, chain, tmp_path_factory):
    return run_chain(*chain, str(tmp_path_factory.mktemp("whole")))


def test_newest_copies_like_pages(spark, tmp_path):
    """Copies with higher, equal, lower and no ids, bare and missing pages, NULL addresses: as a lookup in the pages."""
    rng = random.Random(7)
    customer = table(spark, SF, "customer").filter(NATIONS)
    base = [tuple(r) for r in profile_pages(customer).select("page_id", "url", "html").collect()]
    pages = []
    for id, url, html in base:
        pages.append((id, url, html))
        for _ in range(rng.randint(0, 3)):
            other = rng.choice([html, "", None, "<p>nothing", rng.choice(base)[2]])
            pages.append((rng.choice([id, id + 1, id - 1, None]), url, other))
    pages += [(1, None, base[0][2]), *pages[:5]]
    frame = materialise(spark.createDataFrame(pages, "page_id long, url string, html string"), "pages")
    store = RecordStore(spark, str(tmp_path / "store"), 4)
    parts = [frame.filter(F.expr(f"pmod(xxhash64(url, page_id, html), 2) = {k}")) for k in range(2)]
    for k, part in enumerate(parts):
        assert store.add(part, f"part {k}")
    rows = people(customer).select("name", "researcher_url")
    rows = rows.unionByName(rows).unionByName(spark.createDataFrame([("x", None), ("y", "unknown")], rows.schema))
    expected = materialise(profile_join(rows, frame), "expected")
    assert expected.count() > 0
    assert same(profile_join(rows, frame, plan="scan"), expected)
    for plan, hot_rows in (("broadcast", 1), ("scan", 10**6)):
        assert same(profile_join(rows, store, plan=plan, hot_rows=hot_rows), expected)
    assert store.compact("once", least=2) == [*KINDS, "index"] and store.compact("again", least=2) == []
    assert len(store.table("profiles").live()[0]) == 1
    assert same(profile_join(rows, store), expected)
    # A page added again changes nothing.
    assert store.add(parts[0], "once more") and same(profile_join(rows, store), expected)


def test_jobs_read_their_partitions_and_parse_nothing(spark, chain, whole, tmp_path):
    seeds, pages = chain
    store = RecordStore(spark, str(tmp_path / "store"), 64)
    store.add(pages, "all")
    details = article_details(explode_articles(whole["profiles"]), store)
    jobs = [profiles(seeds, store), details, match_titles(whole["article_details"], store), citing_edges(whole["matches"], store)]
    for job, name in zip(jobs, ("profiles", "article_details", "matches", "citing_edges")):
        plan = job._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "html" not in plan
        assert same(job, whole[name])
    few = explode_articles(whole["profiles"]).filter("url IS NOT NULL").limit(1)
    plan = detail_join(few, store)._jdf.queryExecution().toString()
    (bucket,) = few.select(store.bucket(F.col("url"))).first()
    assert re.search(rf"PartitionFilters: \[[^\]]*\(url_bucket#\d+ = {bucket}\)", plan)


def test_lookup_reads_without_the_choice_touching_html(spark, chain):
    """The choice of the newest copy scans addresses and ids; HTML is read by one scan; no record is sorted."""
    seeds, pages = chain
    found = resolve_profiles(materialise(seeds, "seeds"), pages)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("html#") and plan.count("MapInArrow") <= 2 and "SortAggregate" not in plan and "xxhash64(html" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "html" in line.split("Batched")[0]]
    assert len(scans) <= 2  # the initial and the adaptive form of one scan


def test_interrupted_add_goes_on(spark, chain, whole, tmp_path, monkeypatch):
    seeds, pages = chain
    store = RecordStore(spark, str(tmp_path / "store"), 8)
    asked, real = [], dict(KINDS)

    def counting(kind, fail=False):
        def extract(df):
            asked.append(kind)
            if fail:
                raise RuntimeError("stopped")
            return real[kind][0](df)

        return extract

    for kind in KINDS:
        store.table(kind)
    with monkeypatch.context() as m:
        for kind in KINDS:
            m.setitem(R.KINDS, kind, (counting(kind, kind == "result_pages"), real[kind][1]))
        with pytest.raises(RuntimeError):
            store.add(pages, "all")
    assert store.pages().count() == 0 and profiles(seeds, store).count() == 0
    # What is not settled is not compacted away.
    assert store.compact("early", least=1) == []
    asked.clear()
    with monkeypatch.context() as m:
        for kind in KINDS:
            m.setitem(R.KINDS, kind, (counting(kind), real[kind][1]))
        assert store.add(pages, "all")
    assert asked == ["result_pages", "listing_pages"]
    assert same(profiles(seeds, store), whole["profiles"])


@pytest.mark.parametrize("stored, steps, stop", [(False, 1, 2), (True, 2, 3)])
def test_run_goes_on_where_it_was_stopped(spark, chain, whole, tmp_path, monkeypatch, stored, steps, stop):
    seeds, pages = chain
    if stored:
        store = RecordStore(spark, str(tmp_path / "store"), 8)
        store.add(pages, "all")
        pages = store
    folder, calls = str(tmp_path / "tables"), []

    def stages(stop_at=None):
        def counted(stage):
            def job(rows, *rest):
                if len(calls) == stop_at:
                    raise RuntimeError("stopped")
                calls.append((stage.name, sorted(map(repr, rows.collect()))))
                return stage.job(rows, *rest)

            return S.Stage(stage.name, job, stage.source, stage.asked, stage.rows)

        return tuple(map(counted, real))

    real = S.STAGES
    monkeypatch.setattr(S, "STAGES", stages(stop_at=stop))
    with pytest.raises(RuntimeError):
        S.run_in_steps(seeds, pages, folder, "monday", steps=steps)
    monkeypatch.setattr(S, "STAGES", stages())
    done = S.run_in_steps(seeds, pages, folder, "monday", steps=steps)
    # Every step of every stage was worked on once, on rows of its own.
    assert Counter(name for name, _ in calls) == {s.name: steps for s in real}
    for stage in real:
        own = [row for name, rows in calls if name == stage.name for row in rows]
        source = seeds if stage.source is None else done[stage.source]
        assert Counter(own) == Counter(map(repr, stage.rows(source).collect()))
    assert all(same(done[name], whole[name]) for name in whole)
    # The run is over; a new one finds what is left, which is nothing for names that have profiles.
    calls.clear()
    S.run_in_steps(seeds, pages, folder, "monday", steps=steps)
    assert calls == []
    if stored:
        again = S.run_in_steps(seeds, pages, folder, "tuesday", steps=1)
        assert all(same(again[name], whole[name]) for name in whole)


def test_stream_of_versions(spark, tmp_path):
    """A newer copy in a later file counts, also after a batch is tried again and tables were compacted."""
    customer = table(spark, SF, "customer").filter(NATIONS)
    rows, pages = people(customer).select("name", "researcher_url"), profile_pages(customer)
    newer = pages.select((F.col("page_id") + 1).alias("page_id"), "url", F.replace("html", F.lit("Nation"), F.lit("Region")).alias("html"))
    folder, log = str(tmp_path / "pages"), str(tmp_path / "log")
    store = RecordStore(spark, str(tmp_path / "store"), 4)
    for part in (newer.filter("page_id % 2 = 0"), pages, newer):
        part.coalesce(1).write.mode("append").parquet(folder)
        ingest_records(spark, folder, store, log, compact_after=2)
    assert same(profile_join(rows, store), profile_join(rows, newer))
    assert not store.add(pages, f"{log}/000000001")
    assert store.pages().count() == pages.count()


def test_one_number_of_buckets(spark, tmp_path):
    RecordStore(spark, str(tmp_path), 4)
    with pytest.raises(ValueError):
        RecordStore(spark, str(tmp_path), 8)
    assert isinstance(RecordStore(spark, str(tmp_path), 4).index, CommitTable)


def test_run_names(spark, chain, tmp_path):
    with pytest.raises(ValueError):
        S.run_in_steps(*chain, str(tmp_path), "a/b")
