"""What queries do with tables in many files and with many rows, on rows made here."""

import pytest
from pyspark.sql import functions as F

from citeweave.catalog import QUERIES
from citeweave.rendering import table


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    n = F.col("id")
    customer = spark.range(300).select(
        n.alias("c_custkey"), F.format_string("Customer#%09d", n).alias("c_name"), (n % 25).cast("int").alias("c_nationkey"),
        (n * 31 % 9000).cast("double").alias("c_acctbal"),
        F.element_at(F.split(F.lit("BUILDING AUTOMOBILE MACHINERY HOUSEHOLD FURNITURE"), " "), (n % 5 + 1).cast("int")).alias("c_mktsegment"),
    )
    customer.write.parquet(f"{folder}/customer.parquet")
    part = spark.range(200).select(
        n.alias("p_partkey"), F.format_string("part %d", n).alias("p_name"), F.format_string("Brand#%d", n % 20).alias("p_brand"),
        F.when(n % 3 == 0, "SMALL").otherwise("LARGE").alias("p_type"), (n % 40 + 1).cast("int").alias("p_size"),
    )
    part.write.parquet(f"{folder}/part.parquet")
    pages = spark.range(60).select(
        n.alias("page_id"), F.format_string("https://p.example/%d", n).alias("url"), F.format_string("<h1> Head %d </h1>", n).alias("html")
    )
    pages.repartition(3).write.parquet(f"{folder}/pages.parquet")
    return folder


def test_page_table_of_several_files_as_a_stream(spark, sf_dir):
    rows = QUERIES["ingest_stream"](spark, sf_dir).collect()
    assert sorted((r.page_id, r.headline) for r in rows) == [(i, f"Head {i}") for i in range(60)]


@pytest.mark.parametrize("name", ["explode_articles", "failed_listing", "profile_join"])
def test_joined_pages_do_not_pass_through_the_driver(spark, sf_dir, name):
    """No lookup is broadcast on the strength of a guess from small files; the newest pages of few addresses are, counted before."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "[_url#" in line]


def test_listings_one_of_whose_pages_is_missing(spark, sf_dir, monkeypatch):
    """Listing pages are parsed once for both lookups, and the first pages are not looked up again."""
    from citeweave.catalog import citing

    real = citing.PageLookup
    monkeypatch.setattr(citing, "PageLookup", lambda *args, **options: real(*args, **(options | {"plan": "scan"})))
    rows = QUERIES["failed_listing"](spark, sf_dir)
    assert "MapInArrow" not in rows._jdf.queryExecution().sparkPlan().toString()
    found = {r.first_url.rsplit("=")[-1]: r.complete for r in rows.collect()}
    sizes = {str(i): i % 40 + 1 for i in range(200) if i % 3}
    assert found == {i: not (int(i) % 20 == 13 and size > 20) for i, size in sizes.items() if size > 10}


def test_tables_that_pages_are_made_of_get_tasks_by_their_rows(spark, tmp_path):
    spark.range(200_000).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = table(spark, str(tmp_path), "customer")
    assert rows.rdd.getNumPartitions() == 40
    assert max(rows.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 6_000
    assert rows.count() == rows.distinct().count() == 200_000


def test_stored_pages_are_rendered_once(spark, sf_dir, monkeypatch):
    """Every kind's test of the source reads stored pages; it does not put them together again."""
    from citeweave.plans.records import RecordStore

    plans, add = [], RecordStore.add

    def watched(store, pages, name):
        plans.append(pages._jdf.queryExecution().optimizedPlan().toString())
        return add(store, pages, name)

    monkeypatch.setattr(RecordStore, "add", watched)
    rows = QUERIES["stored_pages"](spark, sf_dir).collect()
    assert len(plans) == 3 and not any("array_join" in p for p in plans)
    broken = {7, 13, 19}
    assert sorted(r.page_id for r in rows) == sorted(
        i + 10_000_000 if i % 3 == 0 else i for i in range(300) if i % 3 == 0 or i % 25 not in broken
    )


def test_signs_of_odd_spellings(spark):
    """The quick test of a page's source lets through all that the exact one does, and drops plain pages with entities elsewhere."""
    from citeweave.operators.html_nodes import may_hold

    exact = r"""(?i)\b(?:class|id)\s*=+\s*(?:"[^"]*&|'[^']*&|[^"'\s>][^\s>]*&|&)|<!\["""
    names, gaps, values = ("class", "CLASS", "iD", "href"), ("=", " = ", "\n==\t"), ('"a&b"', "'a =&amp;'", "a&b", "&", '"a"', "'a' b='&'")
    bodies = [f"<p x {n}{g}{v}>t &amp; u</p>" for n in names for g in gaps for v in values] + ["<p>a<![foo[", "a &amp; b", ""]
    rows = spark.createDataFrame([(b,) for b in bodies], "html string")
    found = rows.select("html", may_hold(F.col("html"), ("want",)).alias("new"), F.col("html").rlike(exact).alias("old")).collect()
    assert all(r.new for r in found if r.old)
    assert not any(r.new for r in found if r.html in ('<p x href="a&b">t &amp; u</p>', "a &amp; b", ""))


@pytest.mark.parametrize("name", ["position", "bad_page", "page_articles"])
def test_areas_that_decide_on_a_page_are_searched_once(spark, sf_dir, name):
    """A filter by `ok` names an area's fields; it does not search the nodes for each of them again."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gsc_rsb_m_na ") == plan.count("gsc_rsb_sc1 ") == 1


@pytest.mark.parametrize("name", ["bad_element", "page_articles", "page_links", "profile_annual_citations"])
def test_what_is_exploded_is_worked_out_once(spark, sf_dir, name):
    """The filter that Spark adds below an `explode` does not search the nodes again."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert not [line for line in filters if "size(" in line and "lambda" in line]


@pytest.mark.parametrize("name, lists", [("position", 0), ("institution_href", 0), ("research_areas", 1), ("page_articles", 1), ("bad_page", 0)])
def test_only_what_a_field_is_read_from_comes_back_from_the_parser(spark, sf_dir, name, lists, monkeypatch):
    from citeweave.plans import profiles

    asked, real = [], profiles.html_nodes
    monkeypatch.setattr(profiles, "html_nodes", lambda pages, **wanted: asked.append(wanted["within"]) or real(pages, **wanted))
    assert QUERIES[name](spark, sf_dir).count()
    assert [len(set(within) - set(profiles.DECIDING_ROOTS)) for within in asked] == [lists]


def test_fields_alone_are_those_of_the_whole_record(spark):
    from citeweave.plans.citing import listing_records
    from citeweave.plans.profiles import RECORD, profile_records

    row = '<tr class="gsc_a_tr"><td><a class="gsc_a_at" href="/p">T</a></td><td class="gsc_a_y"><span class="gsc_a_h">1999</span></td></tr>'
    found = '<div class="gs_r gs_or gs_scl"><h3 class="gs_rt"><a href="/r">R</a></h3></div>'
    bodies = [
        None, "", "<p>x", "<![x", row, f'<table id="gsc_rsb_st"><tbody>{row}</tbody></table>', found, '<div id="gs_nml"><a class="gs_nma">1</a></div>',
        f'<div class="gsc_prf_il">Professor, <a class="gsc_prf_ila" href="/o">Z</a><table>{row}{row}</table></div>',
        '<div class="gsc_prf_il">Prof. <a class="gsc_prf_ila">Z</a></div><div class="gsc_md_hist_b"><span class="gsc_g_t">1</span><a class="gsc_g_a">2</a></div>',
        f'<div class="gs_r"><div id="gs_nml">{found}<a class="gs_nma" href="/2">2</a></div>{found}</div>', f'<div id="gs_nml"><div class="gs_r">{found}',
        '<tr class="gsc_a_tr"><div class="gsc_prf_il">Head</div><div id="gsc_prf_int"><a class="gsc_prf_inta">a</a></div>',
    ]
    pages = spark.createDataFrame([(str(i), i, html) for i, html in enumerate(bodies)], "url string, page_id long, html string").localCheckpoint()

    def rows(records, *fields):
        return sorted(map(repr, records.select("url", *(f"record.{f}" for f in fields)).collect()))

    whole = profile_records(pages)
    for field in RECORD[1:]:
        assert rows(profile_records(pages, (field,)), "ok", field) == rows(whole, "ok", field)
    assert rows(profile_records(pages, ()), "ok") == rows(whole, "ok")
    for field in ("links", "results"):
        assert rows(listing_records(pages, field), "ok", field) == rows(listing_records(pages), "ok", field)


def test_pages_of_every_kind_lie_in_each_part_of_the_chains_pages(spark, sf_dir):
    """Each job asks for one kind: no task has most of them."""
    from citeweave.rendering import chain_pages

    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").repartition(4)
    nobody = customer.limit(1).select("*", F.lit(None).cast("int").alias("n")).withColumn("c_nationkey", F.col("n")).drop("n")
    kind = F.expr("CASE WHEN url LIKE '%view_op=view_citation%' THEN 1 WHEN url LIKE '%cites=%' THEN 2 WHEN url LIKE '%user=%' THEN 3 "
                  "WHEN url LIKE '%search_authors%' THEN 4 ELSE 5 END")
    pages = chain_pages(customer).select(F.spark_partition_id().alias("part"), kind.alias("kind"))
    kinds = {r.part: r.n for r in pages.groupBy("part").agg(F.countDistinct("kind").alias("n")).collect()}
    assert kinds == dict.fromkeys(range(4), 5)
    assert chain_pages(nobody).count() == 2


def test_result_blocks_bring_no_attributes_along(spark, sf_dir, monkeypatch):
    from citeweave.catalog import nodes

    asked, real = [], nodes.html_nodes
    monkeypatch.setattr(nodes, "html_nodes", lambda pages, **wanted: asked.append(wanted.get("attrs")) or real(pages, **wanted))
    assert QUERIES["result_blocks"](spark, sf_dir).count() and asked == [()]


def test_reference_expression_runs_behind_a_quick_test(spark):
    """Signs with a common beginning are told by it first, and a page without a `&` is spared the expression."""
    from citeweave.operators.html_nodes import may_hold

    frame = spark.createDataFrame([("<p class=gs_nml>",), ("<p class=gs_x>",), ("<p class=g>",), (None,)], "html string")
    found = frame.select(may_hold(F.col("html"), ("gs_r", "gs_nml")).alias("held"))
    assert [r.held for r in found.collect()] == [True, False, False, True]
    rule = found._jdf.queryExecution().optimizedPlan().expressions().head().sql()
    assert "contains(html, 'gs_') AND" in rule and "contains(html, '&') AND" in rule


@pytest.mark.parametrize("name", ["strip", "collapse"])
def test_texts_that_stay_as_they_are_are_spared_the_slow_rules(spark, name):
    """White space of all kinds at the ends and within goes as the slow rules have it; a plain text is not handed to them."""
    import itertools
    import re

    from citeweave.constants import PY_SPACE
    from citeweave.functions import text as X

    ends = ["", " ", "  ", "\t", "  ", "\xa0", "\x85", "!", "~", "\x7f", "\x00", "é", "　\n ", "a", "\U0001f600"]
    texts = [a + m + b for a, m, b in itertools.product(ends, ["", "x", "a b", "a  b", "a \t b", "a b c", "[é] "], ends)]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    found = {r.t: r.x for r in rows.select("t", getattr(X, name)(F.col("t")).alias("x")).collect()}
    run = "[" + re.escape(PY_SPACE) + "]+"
    for t in texts:
        assert found[t] == (t.strip(PY_SPACE) if name == "strip" else re.sub(run, " ", t).strip(" ")), repr(t)
    assert found[None] is None
    rule = rows.select(getattr(X, name)(F.col("t")).alias("x"))._jdf.queryExecution().analyzed().expressions().head().sql()
    assert "CASE WHEN" in rule if name == "strip" else "(?<! )" in rule and "' ')" not in rule.replace("', ' ', 1)", "")
