"""Edge cases of the four jobs, on small hand-written pages."""

import pytest
from pyspark.errors import AnalysisException

from citeweave import append_sink, csv_sink, explode_articles, replace_sink, seed_scan, stage_scan, table_or_empty
from citeweave.constants import SITE
from citeweave.functions.text import title_search_url
from citeweave.plans.citing import citing_edges, listing_records
from citeweave.plans.details import article_details, detail_records
from citeweave.plans.matching import match_titles
from citeweave.plans.profiles import profile_records, profiles
from citeweave.schemas import ARTICLE_DETAILS, CITING_EDGES, MATCHES, PAGES, PROFILES, SEEDS


def pages_of(spark, bodies):
    return spark.createDataFrame([(i, url, html) for i, (url, html) in enumerate(bodies.items())], PAGES).coalesce(2)


def records(spark, extract, bodies):
    """Record per address, as plain values."""
    rows = extract(pages_of(spark, bodies)).collect()
    return {r.url: r.record.asDict(recursive=True) for r in rows}


# -- profiles ------------------------------------------------------------------
ROW = '<table id="gsc_rsb_st"><tbody>{}</tbody></table>'
CELL = '<tr><td class="gsc_rsb_sc1">{}</td><td class="gsc_rsb_std">{}</td><td class="gsc_rsb_std">recent</td></tr>'


def access(a=None, b=None):
    a = "" if a is None else f'<div class="gsc_rsb_m_a"><span>{a}</span></div>'
    b = "" if b is None else f'<div class="gsc_rsb_m_na"><div>{b}</div></div>'
    return f'<div class="gsc_rsb_m">{a}{b}</div>'


def chart(years, counts):
    return (
        '<div class="gsc_md_hist_b">'
        + "".join(f'<span class="gsc_g_t">{y}</span>' for y in years)
        + "".join(f'<a class="gsc_g_a">{c}</a>' for c in counts)
        + "</div>"
    )


def il(text):
    return f'<div class="gsc_prf_il">{text}</div>'


def article(title='<a class="gsc_a_at" href="/p">T</a>', year='<td class="gsc_a_y"><span class="gsc_a_h">1999</span></td>'):
    return f'<table><tr class="gsc_a_tr"><td>{title}</td>{year}</tr></table>'


def test_profile_fields(spark):
    found = records(
        spark,
        profile_records,
        {
            "two positions": il("Professor of A, Prof. B, University X"),
            "both kinds": il("Director of the School of Y"),
            "substring": il("Someone ahead, Nowhere"),
            "anchor text": il('Researcher at <a class="gsc_prf_ila" href="/o">Z Labs</a>'),
            "part before anchor": il('Q College, <a class="gsc_prf_ila" href="/o">Z Labs</a>'),
            "anchor without href": il('<a class="gsc_prf_ila">Z</a>'),
            "nothing": "<p>empty</p>",
            "not a div": '<span class="gsc_prf_il">Professor</span>',
            "site": '<div id="gsc_prf_ivh"><a>x</a><a rel="nofollow" href="h">y</a></div>',
            "site without href": '<div id="gsc_prf_ivh"><a rel="nofollow">y</a></div>',
            "areas": '<div id="gsc_prf_int"><a class="gsc_prf_inta">a <b>b</b></a><a class="gsc_prf_inta">c</a></div>',
            "metrics": ROW.format(CELL.format("Citations", 1) + CELL.format("h-index", 2) + CELL.format("Citations", 3)),
            "no body": '<table id="gsc_rsb_st"><tr></tr></table>',
            "no cell": ROW.format('<tr><td class="gsc_rsb_sc1">Citations</td></tr>'),
        },
    )

    def get(name, *fields):
        return tuple(found[name][f] for f in fields)

    two = ("position", "institution")
    assert get("two positions", *two) == ("Prof. B", "University X")
    assert get("both kinds", *two) == ("Director of the School of Y", None)
    assert get("substring", *two) == ("Someone ahead", None)
    assert get("anchor text", *two, "institution_href") == (None, "Z Labs", SITE + "/o")
    assert get("part before anchor", *two) == (None, "Q College")
    assert get("nothing", *two, "research_areas", "annual_citations", "total_access_articles", "articles") == (
        None, None, "", {}, None, [],
    )
    assert get("not a div", *two) == (None, None)
    assert get("site", "personal_website") == ("h",)
    assert get("areas", "research_areas") == ("ab, c",)
    assert get("metrics", "total_citations", "h_index", "i10_index") == ("3", "2", None)
    failed = {name for name, r in found.items() if not r["ok"]}
    assert failed == {"anchor without href", "site without href", "no body", "no cell"}


def test_profile_lists(spark):
    found = records(
        spark,
        profile_records,
        {
            "more years": chart([1, 2, 3], ["a", "b"]),
            "fewer years": chart([1], ["a", "b"]),
            "repeated year": chart([1, 2, 1], ["a", "b", "c"]),
            "both counts": access("7 articles", " 5 articles "),
            "one count": access(b="5"),
            "no counts": access(),
            "no number": access("some"),
            "blank": access(" "),
            "no inner tag": '<div class="gsc_rsb_m"><div class="gsc_rsb_m_a">7</div></div>',
            "article": article(),
            "no year": article(year=""),
            "no href": article(title='<a class="gsc_a_at"> T <i>x</i></a>'),
            "broken page": None,
        },
    )
    assert found["more years"]["annual_citations"] == {"1": "a", "2": "b"}
    assert found["fewer years"]["annual_citations"] == {"1": "a"}
    assert found["repeated year"]["annual_citations"] == {"1": "c", "2": "b"}
    totals = {name: found[name]["total_access_articles"] for name in ("both counts", "one count", "no counts")}
    assert totals == {"both counts": 12, "one count": 5, "no counts": 0}
    assert {n for n, r in found.items() if not r["ok"]} == {"no number", "blank", "no inner tag", "broken page"}
    assert found["article"]["articles"] == [{"title": "T", "year": "1999", "url": SITE + "/p"}]
    assert found["no year"]["articles"] == []
    assert found["no href"]["articles"] == [{"title": " T x", "year": "1999", "url": None}]


def test_profiles_job_and_retry(spark):
    """Names that are done are skipped; names without a readable page stay pending."""
    def search(name, user):
        url = SITE + "/citations?view_op=search_authors&hl=en&oi=ao&mauthors=" + name
        return {url: f'<div class="gs_ai_t"><h3 class="gs_ai_name"><a href="/u?n={user}">x</a></h3></div>'}

    bodies = {**search("A+B%2C+C", 1), **search("D&E", 2), **search("Bad", 3), SITE + "/u?n=1": article(), SITE + "/u?n=2": "",
              SITE + "/u?n=3": access("x")}
    seeds = spark.createDataFrame([("A B, C",), ("D&E",), ("D&E",), ("Bad",), ("Nobody",), (None,)], SEEDS)
    pages = pages_of(spark, bodies)
    found = profiles(seeds, pages)
    assert sorted(r.name for r in found.collect()) == ["A B, C", "D&E", "D&E"]
    assert found.schema.simpleString() == PROFILES.simpleString()
    rows = explode_articles(found).collect()
    assert sorted((r.name, str(r.title)) for r in rows) == [("A B, C", "T"), ("D&E", "None"), ("D&E", "None")]
    assert profiles(seeds, pages, found).count() == 0


# -- article details -------------------------------------------------------------
def field(label, value="", attrs=""):
    return f'<div class="gs_scl"><div class="gsc_oci_field">{label}</div>{value and f"<div class=gsc_oci_value{attrs}>{value}</div>"}</div>'


def test_detail_fields(spark):
    found = records(
        spark,
        detail_records,
        {
            "english": field("Authors", "A, <b>B</b>") + field("Publication date", "2001/2") + field("Source", "S")
            + field("Pages", "1-2") + field("Description", "d", " id=gsc_oci_descr")
            + field("Total citations", '<a href="/c">Cited by 7</a>'),
            "german": field("Autoren", "A") + field("Publikationsdatum", "2002") + field("Zeitschrift", "Z")
            + field("Seiten", "3") + field("Beschreibung", "e", " id=gsc_oci_descr")
            + field("Zitate insgesamt", '<a href="/c">Zitiert von: 8</a>'),
            "inventors": field("Inventors", "I"),
            "padded": field(" Authors", "A") + field(" Publication date ", "2003") + field("Pages\n", "9"),
            "no authors value": field("Authors"),
            "no date value": field("Publication date"),
            "no description": field("Description", "other"),
            "second date": field("Publication date", "1") + field("Publication date", "2"),
            "no total anchor": field("Total citations", "7"),
            "count with comma": '<a class="gsc_oci_g_a"><span class="gsc_oci_g_al">1,234</span></a>',
            "count without span": '<a class="gsc_oci_g_a">5</a>',
            "chart": '<span class="gsc_oci_g_t">2001</span><span class="gsc_oci_g_t">2002</span>'
            '<a class="gsc_oci_g_a"><span class="gsc_oci_g_al"> 5 </span></a>',
            "empty": "",
        },
    )
    fields = ("authors", "publication_date", "book", "pages", "description", "total_citations")
    get = {name: tuple(r[f] for f in fields) for name, r in found.items()}
    assert get["english"] == ("A,B", "2001/2", "S", "1-2", "d", "7")
    assert get["german"] == ("A", "2002", "Z", "3", "e", "8")
    assert get["inventors"][0] == "I"
    assert get["padded"] == (None, "2003", None, None, None, None)
    assert get["no date value"] == get["no description"] == get["empty"] == (None,) * 6
    assert get["second date"][1] == "1"
    assert get["no total anchor"][5] is None
    assert found["chart"]["annual_citations"] == {"2001": 5}
    assert {n for n, r in found.items() if not r["ok"]} == {"no authors value", "count with comma", "count without span"}


def test_details_job(spark):
    articles = spark.createDataFrame(
        [("T", "u"), ("T", "u"), ("Gone", "x"), (None, None), ("Done", "u")], "title string, url string"
    )
    done = spark.createDataFrame([("Done",)], "title string")
    found = article_details(articles, pages_of(spark, {"u": field("Authors", "A")}), done)
    assert found.schema.simpleString() == ARTICLE_DETAILS.simpleString()
    assert [(r.title, r.paper_url, r.authors) for r in found.collect()] == [("T", "u", "A")] * 2


# -- title matching ----------------------------------------------------------------
def result(heading, rest="", whole="gs_r gs_or gs_scl"):
    return f'<div class="{whole}">{heading}{rest}</div>'


def h3(title, href="h"):
    return f'<h3 class="gs_rt"><a href="{href}">{title}</a></h3>'


def matched(spark, cases):
    """Match of each title; the value is its page."""
    titles = spark.createDataFrame([(t, "o") for t in cases], "title string, paper_url string")
    urls = {r.title: r.u for r in titles.select("title", title_search_url(titles.title).alias("u")).collect()}
    pages = pages_of(spark, {urls[t]: html for t, html in cases.items() if html is not None})
    rows = match_titles(titles, pages)
    assert rows.schema.simpleString() == MATCHES.simpleString()
    return {r.original_title: r for r in rows.collect()}


def test_match_titles(spark):
    other = result(h3("Other"))
    found = matched(
        spark,
        {
            "Exact  one": result(h3("Exact one")) + other,
            "CASE": result(h3("case")) + other,
            "Prefixed": result('<h3 class="gs_rt"><span>[CITATION]</span> Prefixed</h3>') + other,
            "With [18F] inside": result(h3("With [18F] inside")) + other,
            "Bold tags": result(h3("B<b>old</b> tags")) + other,
            "“Quoted”": result(h3('"Quoted"')) + other,
            "ﬁne": result(h3("fine")) + other,
            "Twice": result(h3("Twice", "1")) + result(h3("Twice", "2")),
            "Lone": result(h3("[PDF] Something <i>else</i>", "s"), whole="gs_r gs_or gs_scl gs_fmar"),
            "Two others": other + other,
            "Wrong class": result(h3("Wrong class"), whole="gs_r gs_or"),
            "Nothing": "<p></p>",
            "No page": None,
            "No href": result('<h3 class="gs_rt"><a>No href</a></h3>') + other,
            "No heading": result("", '<a href="/c">Cited by 3</a><div class="gs_a"><a href="/n">N</a></div>'),
        },
    )
    titles = {t: r.matched_title for t, r in found.items()}
    assert titles == {
        "Exact  one": "Exact one", "CASE": "case", "Prefixed": "Prefixed", "With [18F] inside": None,
        "Bold tags": "Bold tags", "“Quoted”": "Quoted", "ﬁne": "fine", "Twice": "Twice", "Lone": "[PDF] Somethingelse", "Two others": None, "Wrong class": None, "Nothing": None,
        "No page": None, "No href": "No href", "No heading": None,
    }
    assert found["Twice"].url == "1" and found["Lone"].url == "s" and found["No href"].url is None
    assert all(r.original_url == "o" and r.authors_with_urls is not None for r in found.values())
    # A lone result without heading keeps its link and authors.
    last = found["No heading"]
    assert (last.cited_articles_url, last.authors_with_urls) == (SITE + "/c", {"N": SITE + "/n"})


def test_abstracts_links_authors(spark):
    csp = '<div class="gsh_csp"> a <b>b</b> </div>'
    rs = '<div class="gs_rs gs_fma_s"> a<b>b</b> </div>'
    snippet = '<div class="gs_fma_snp"><div>a<div>b</div></div><div> </div></div>'
    other = result(h3("Other"))
    authors = '<div class="gs_a"><a href="/1">A</a>, <a>B</a>, <a href="/2">A</a> C</div>'
    found = matched(
        spark,
        {
            "csp": result(h3("csp"), rs + csp) + other,
            "rs": result(h3("rs"), rs + snippet) + other,
            "snippet exact": result(h3("snippet exact"), snippet) + other,
            "snippet lone": result(h3("x"), snippet),
            "none": result(h3("none")) + other,
            "cited": result(h3("cited"), '<a href="/no">is Cited by</a><a href="/c"><b>Cited by 4</b></a>') + other,
            "chinese": result(h3("chinese"), '<a href="/c">被引用次数：4</a>') + other,
            "cited without href": result(h3("cited without href"), "<a>Cited by 4</a>" + authors) + other,
            "authors": result(h3("authors"), authors) + other,
            "fmaa": result(h3("fmaa"), '<div class="gs_fmaa x"><a href="/3">D</a></div>' + authors) + other,
        },
    )
    abstracts = {t: r.abstract for t, r in found.items()}
    assert abstracts["csp"] == "a b" and abstracts["rs"] == "a b"
    assert abstracts["snippet exact"] == "" and abstracts["snippet lone"] == "ab b" and abstracts["none"] is None
    assert found["cited"].cited_articles_url == found["chinese"].cited_articles_url == SITE + "/c"
    assert found["cited without href"].cited_articles_url is None
    assert found["authors"].authors_with_urls == {"A": SITE + "/2", "B": None} == found["cited without href"].authors_with_urls
    assert found["fmaa"].authors_with_urls == {"D": SITE + "/3"}


def test_null_title_survives(spark):
    titles = spark.createDataFrame([(None, "o")], "title string, paper_url string")
    (row,) = match_titles(titles, pages_of(spark, {"u": ""})).collect()
    assert tuple(row) == (None, None, None, None, {}, None, "o")


# -- citing articles -----------------------------------------------------------------
def nav(*hrefs):
    return '<div id="gs_nml">' + "".join(f'<a class="gs_nma" href="{h}">n</a>' for h in hrefs) + "</div>"


def test_listing(spark):
    found = records(
        spark,
        listing_records,
        {
            "results": result('<h3 class="gs_rt"> [CITATION] <a href="h">A <b>b</b></a></h3>', '<a href="/c">Cited by 1</a>')
            + result("", "") + result('<h3 class="gs_rt"><a>no href</a></h3>') + result(h3("x"), "<a>Cited by 2</a>"),
            "no href in navigation": '<div id="gs_nml"><a class="gs_nma">n</a></div>',
        },
    )
    assert found["results"]["results"] == [
        {"title": "[CITATION] A b", "url": "h", "next_url": SITE + "/c"}, {"title": None, "url": None, "next_url": None},
    ]
    assert found["results"]["links_ok"] and not found["no href in navigation"]["links_ok"]


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_citing_edges(spark, hot_rows):
    def one(title):
        return result(h3(title, title))

    bodies = {
        SITE + "/1": one("a") + nav("/1", "/1b", "/1b", "/1c"),
        SITE + "/1b": one("b") + nav("/never"),
        SITE + "/1c": one("c"),
        SITE + "/2": one("d"),
        SITE + "/3": one("e") + nav("/3", "/gone"),
        SITE + "/4": "",
    }
    papers = spark.createDataFrame(
        [("P1", "m1", SITE + "/1")] * 3 + [("P1 too", None, SITE + "/1"), ("P2", "m2", SITE + "/2"), ("P3", "m3", SITE + "/3"),
         ("P4", "m4", SITE + "/4"), ("P5", "m5", SITE + "/missing"), ("P6", "m6", None), ("Done", "m7", SITE + "/2")],
        "original_title string, url string, cited_articles_url string",
    )
    done = spark.createDataFrame([("Done",)], "original_paper_title string")
    found = citing_edges(papers, pages_of(spark, bodies), done, hot_rows)
    assert found.schema.simpleString() == CITING_EDGES.simpleString()
    edges = sorted((r.original_paper_title, str(r.original_paper_url), r.cited_article_title) for r in found.collect())
    assert edges == sorted([("P1", "m1", t) for t in "abc"] * 3 + [("P1 too", "None", t) for t in "abc"] + [("P2", "m2", "d")])


# -- sources and sinks ------------------------------------------------------------------
def test_seed_scan_needs_a_name(spark, tmp_path):
    spark.createDataFrame([("a", "b")], "x string, name string").write.csv(str(tmp_path / "good"), header=True)
    spark.createDataFrame([("a",)], "x string").write.csv(str(tmp_path / "bad"), header=True)
    assert [r.name for r in seed_scan(spark, str(tmp_path / "good"), "csv").collect()] == ["b"]
    with pytest.raises(AnalysisException):
        seed_scan(spark, str(tmp_path / "bad"), "csv")


def test_nested_columns_through_csv_and_parquet(spark, tmp_path):
    row = ("T", "u", None, 'say "hi",\nthere ', "", " lead", "d\\n", "5", {"2001": 7})
    df = spark.createDataFrame([row], ARTICLE_DETAILS)
    csv_sink(df, str(tmp_path / "csv"))
    append_sink(df, str(tmp_path / "parquet"))
    append_sink(df, str(tmp_path / "parquet"))
    assert [tuple(r) for r in stage_scan(spark, str(tmp_path / "csv"), ARTICLE_DETAILS, "csv").collect()] == [row]
    assert [tuple(r) for r in stage_scan(spark, str(tmp_path / "parquet"), ARTICLE_DETAILS).collect()] == [row] * 2


def test_first_run_and_replacing(spark, tmp_path):
    missing, first, second = (str(tmp_path / n) for n in ("missing", "first", "second"))
    assert table_or_empty(spark, missing, MATCHES).schema == MATCHES
    assert table_or_empty(spark, missing, MATCHES).count() == 0
    replace_sink(spark.createDataFrame([("a",)], SEEDS), missing, first)
    replace_sink(spark.createDataFrame([("b",)], SEEDS), first, second)
    assert sorted(r.name for r in stage_scan(spark, second, SEEDS).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        replace_sink(spark.createDataFrame([("b",)], SEEDS), first, first)
