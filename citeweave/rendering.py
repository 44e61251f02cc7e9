"""Sample pages rendered from plain tables, one row at a time.

The jobs read stored pages; these renderers make such pages (same schema as
the page table) out of `customer`, `documents` and `part` rows, so that every
rule has pages to be tested and measured on. A page depends on its own row
only: nothing is grouped or collected, so any number of rows can be rendered.
Rows are spread before rendering, while they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .constants import SITE
from .functions.text import people_search_url, title_search_url
from .session import PAGE_ROWS, spread

RENDERED = ("customer", "documents", "part")
PAGES_OF_CHAIN = 10  # small pages of a customer in `chain_pages`, at least, about


def table(spark, sf_dir: str, name: str, pages: int = 1) -> DataFrame:
    """A table; a page is a hundred times its row, so those that pages are made of get tasks by their number of rows.

    `pages` is more where a row becomes several pages.
    """
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), PAGE_ROWS // pages if name in RENDERED else None)


def _sql(text: str):
    return F.expr(text.replace("{SITE}", SITE))


def _escaped(column: str) -> str:
    """SQL that writes a column as HTML text."""
    text = column
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = f"replace({text}, '{mark}', '{name}')"
    return text


# -- people: customer ------------------------------------------------------------
def people(customer: DataFrame) -> DataFrame:
    """Customers with the name they are searched by and the address of their profile."""
    return customer.withColumn("name", _sql("concat(c_name, ', ', c_mktsegment, ' team')")).withColumn(
        "researcher_url", _sql("concat('{SITE}/citations?hl=en&user=', c_custkey)")
    )


def _search_page():
    """Address and source. No hit, a hit after a heading that is none, two hits, or one."""
    hit = """concat('<div class="gsc_1usr gs_ai gs_ai_t"><h3 class="gs_ai_name">',
        '<a href="/citations?hl=en&amp;user=', c_custkey, '">', c_name, '</a></h3></div>')"""
    other = """'<div class="gs_ai_t"><h3 class="gs_ai_name"><a href="/citations?user=other">x</a></h3></div>'"""
    html = f"""concat('<html><body>', CASE c_mktsegment
        WHEN 'BUILDING' THEN '<p>nobody</p>'
        WHEN 'AUTOMOBILE' THEN concat('<h3 class="gs_ai_name"><a href="/no">x</a></h3>',
            '<div class="gs_ai_t"><h3 class="gs_ai_name">no link</h3><h3><a href="/no">x</a></h3></div>', {hit})
        WHEN 'MACHINERY' THEN concat({hit}, {other})
        ELSE {hit} END, '</body></html>')"""
    return people_search_url(F.col("name")).alias("url"), _sql(html).alias("html")


def people_search_pages(customer: DataFrame) -> DataFrame:
    return people(customer).select(F.col("c_custkey").alias("page_id"), *_search_page())


# A customer has as many articles as its nation key says. Nations 7, 13 and 19 have broken pages.
_HEADLINE = """CASE
    WHEN c_nationkey = 7 THEN '<div class="gsc_prf_il">X, <a class="gsc_prf_ila">no link</a></div>'
    WHEN c_mktsegment = 'BUILDING' THEN concat('<div class="gsc_prf_il">Professor of ', c_mktsegment,
        ', <a class="gsc_prf_ila" href="/org?id=', c_nationkey, '">University of Nation ', c_nationkey, '</a></div>')
    WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('<div class="gsc_prf_il">Head of lab, <b> Ahead </b> thinker ',
        ', College director ', c_nationkey, '</div>')
    WHEN c_mktsegment = 'MACHINERY' THEN concat('<div class="gsc_prf_il">Researcher , Institute ', c_nationkey,
        ' ,\t Campus&nbsp;', c_nationkey, '&nbsp;</div>')
    WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('<div class="extra gsc_prf_il">Prof. emeritus at ',
        '<a class="gsc_prf_ila" href="/org?id=', c_nationkey, '">Acme &amp; Sons ', c_nationkey, '</a></div>')
    ELSE '' END"""

_WEBSITE = """CASE WHEN c_acctbal > 5000 THEN concat('<div id="gsc_prf_ivh"><a href="/verified">v</a>',
        '<a rel="nofollow noopener" href="https://site.example/', c_custkey, '?a=1&amp;b=2">Homepage</a></div>',
        '<div id="gsc_prf_int"><a class="gsc_prf_inta gs_ibl">', lower(c_mktsegment),
        '</a><a class="gsc_prf_inta">nation <b>', c_nationkey, '</b></a></div>')
    ELSE '<div id="gsc_prf_ivh"><a href="/none">none</a></div>' END"""

_METRICS = """concat('<table id="gsc_rsb_st"><thead><tr><th>Metric</th></tr></thead><tbody>',
    '<tr><td class="gsc_rsb_sc1"><a>Citations</a></td><td class="gsc_rsb_std">', c_custkey * 7,
    '</td><td class="gsc_rsb_std">1</td></tr>',
    '<tr><td class="gsc_rsb_sc1">h-index</td><td class="gsc_rsb_std">', c_nationkey, '</td></tr>',
    CASE WHEN c_mktsegment = 'MACHINERY'
        THEN '<tr><td class="gsc_rsb_sc1"> h-index </td><td class="gsc_rsb_std">last</td></tr>' ELSE '' END,
    '<tr><td class="gsc_rsb_sc1">i10-index</td>', CASE WHEN c_nationkey = 13 THEN ''
        ELSE concat('<td class="gsc_rsb_std"> ', c_nationkey + 1, ' </td>') END, '</tr></tbody></table>')"""

_CHART = """CASE WHEN c_nationkey = 0 THEN '' ELSE concat('<div class="gsc_md_hist_b">',
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '<span class="gsc_g_t">2000</span>' ELSE '' END,
    array_join(transform(sequence(1, c_nationkey),
        i -> concat('<span class="gsc_g_t">', 1999 + i, '</span>')), ''),
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '<a class="gsc_g_a"><span>first</span></a>' ELSE '' END,
    array_join(transform(sequence(1, least(c_nationkey, 20)),
        i -> concat('<a class="gsc_g_a"><span class="gsc_g_al">', c_custkey + i, '</span></a>')), ''), '</div>') END"""

_ACCESS = """CASE
    WHEN c_nationkey = 19 THEN '<div class="gsc_rsb_m"><div class="gsc_rsb_m_a"><span>many</span></div></div>'
    WHEN c_mktsegment = 'BUILDING' THEN concat('<div class="gsc_rsb_m"><div class="gsc_rsb_m_a"><span>', c_nationkey,
        ' articles</span></div><div class="gsc_rsb_m_na"><div> ', c_custkey, ' articles</div></div></div>')
    WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('<div class="gsc_rsb_m"><div class="gsc_rsb_m_a"><span>',
        c_nationkey, '</span></div></div>')
    WHEN c_mktsegment = 'MACHINERY' THEN concat('<div class="gsc_rsb_m"><div class="gsc_rsb_m_na"><div>',
        c_custkey, ' article</div></div></div>')
    WHEN c_mktsegment = 'HOUSEHOLD' THEN '<div class="gsc_rsb_m"><p>none</p></div>'
    ELSE '' END"""

_ARTICLE_ROWS = """CASE WHEN c_nationkey = 0 THEN '' ELSE concat('<table>', array_join(transform(sequence(1, c_nationkey),
    k -> concat('<tr class="gsc_a_tr"><td><a class="gsc_a_at"',
        CASE WHEN k = 6 THEN '' ELSE concat(' href="/citations?view_op=view_citation&amp;id=', c_custkey, ':', k, '"') END,
        '>Paper <i>', k, '</i> of ', c_name, ' &amp; co</a></td>',
        CASE WHEN k = 5 THEN '' ELSE concat('<td class="gsc_a_y"><span class="gsc_a_h"> ', 1990 + k, ' </span></td>') END,
        '</tr>')), ''), '</table>') END"""


def _profile_page():
    html = f"""concat('<!DOCTYPE html><html><head><script>var t = "<tr class=gsc_a_tr>";</script></head><body>',
        {_HEADLINE}, {_WEBSITE}, {_METRICS}, {_CHART}, {_ACCESS}, {_ARTICLE_ROWS}, '</body></html>')"""
    return F.col("researcher_url").alias("url"), _sql(html).alias("html")


def profile_pages(customer: DataFrame) -> DataFrame:
    return people(customer).select(F.col("c_custkey").alias("page_id"), *_profile_page())


# -- article pages -----------------------------------------------------------------
def articles(documents: DataFrame) -> DataFrame:
    """Documents as articles, with the number of their source as `kind`."""
    return (
        documents.withColumn("kind", _sql("cast(substring(source, 4) as int)"))
        .withColumn("title", _sql("concat('Study ', doc_id, ' of ', source, ' (', lang, ')')"))
        .withColumn("paper_url", _sql("concat('{SITE}/citations?view_op=view_citation&doc=', doc_id)"))
    )


def _field(label: str, value: str, value_attrs: str = "") -> str:
    return (
        f"""concat('<div class="gs_scl"><div class="gsc_oci_field">', {label}, '</div>',"""
        f"""'<div class="gsc_oci_value"{value_attrs}>', {value}, '</div></div>')"""
    )


def _german(german: str, english: str) -> str:
    return f"CASE WHEN lang = 'de' THEN '{german}' ELSE '{english}' END"


def article_pages(documents: DataFrame) -> DataFrame:
    """German labels for German documents. Kinds 2 and 4 have broken pages; kind 1 pads its journal label."""
    journal = """CASE WHEN kind = 1 THEN ' Journal ' WHEN lang = 'de' THEN 'Zeitschrift'
        WHEN kind = 3 THEN 'Source' WHEN kind = 5 THEN 'Book' ELSE 'Journal' END"""
    authors = """CASE WHEN kind = 3 THEN 'Inventors' WHEN lang = 'de' THEN 'Autoren' ELSE 'Authors' END"""
    pages = f"""CASE WHEN kind = 2 THEN concat('<div class="gs_scl"><div class="gsc_oci_field">',
        {_german("Seiten", "Pages")}, '</div></div>')
        WHEN kind = 6 THEN '' ELSE {_field(_german("Seiten", "Pages"), "concat('1-', n_chars)")} END"""
    total = _field(
        f"concat('<b>', {_german('Zitate insgesamt', 'Total citations')}, '</b>')",
        f"concat('<div><a href=\"/scholar?cites=', doc_id, '\">', {_german('Zitiert von: ', 'Cited by ')}, n_chars, '</a></div>')",
    )
    chart = """concat('<div><span class="gsc_oci_g_t">2019</span><span class="gsc_oci_g_t">2020</span>',
        '<span class="gsc_oci_g_t">2021</span><a class="gsc_oci_g_a"><span class="gsc_oci_g_al">', doc_id,
        '</span></a><a class="gsc_oci_g_a"><span class="gsc_oci_g_al">',
        CASE WHEN kind = 4 THEN '1,234' ELSE cast(n_chars as string) END, '</span></a></div>')"""
    html = f"""concat('<html><body><a href="/top">top</a>',
        {_field(authors, "concat('Author ', doc_id, ', <i>Team</i> ', lang)")},
        {_field(f"concat('&nbsp;', {_german('Publikationsdatum', 'Publication date')}, ' ')", "concat(2000 + kind, '/1/2')")},
        {_field(journal, "concat('Annals of ', source)")}, {pages},
        {_field(_german("Beschreibung", "Description"), _escaped("text"), ' id="gsc_oci_descr"')},
        CASE WHEN kind = 7 THEN '' ELSE {total} END, CASE WHEN kind = 8 THEN '' ELSE {chart} END, '</body></html>')"""
    return articles(documents).select(
        F.col("doc_id").alias("page_id"), F.col("paper_url").alias("url"), _sql(html).alias("html")
    )


# -- search result pages -----------------------------------------------------------
def _result(heading: str, rest: str, whole_class: str = "gs_r gs_or gs_scl") -> str:
    return f"""concat('<div class="{whole_class}"><div class="gs_ri">', {heading}, {rest}, '</div></div>')"""


def _heading(title: str, href: str) -> str:
    return f"""concat('<h3 class="gs_rt"><a href="', {href}, '">', {title}, '</a></h3>')"""


_CITED = """concat('<div class="gs_fl"><a href="/save">Save</a> <a href="/scholar?cites=', doc_id, '">',
    CASE WHEN lang = 'fr' THEN '被引用次数：' ELSE 'Cited by ' END, n_chars, '</a></div>')"""
_LINKED = """concat('<div class="gs_a"><a href="/citations?user=first">A. Author</a>, <a>B. Nolink</a>, ',
    '<a href="/citations?user=', doc_id, '"> A. Author </a>, C. Plain</div>')"""
_LINKED_ONCE = """'<div class="gs_fmaa"><a href="/citations?user=one">A. Author</a></div><div class="gs_a"><a>no</a></div>'"""


def result_pages(documents: DataFrame) -> DataFrame:
    """One page per document and title; `kind % 10` decides what it holds (8: there is no page).

    0 same title; 1 upper case, second of two; 2 `[CITATION]` prefix; 3 curly quotes; 4 two with the same title;
    5 one other title; 6 two other titles; 7 no result; 9 one result without heading.
    """
    text = _escaped("text")
    link = "concat('https://paper.example/', doc_id)"
    other = _result(_heading("'Another study'", "'https://other.example/'"), "'<div class=\"gs_rs\">other</div>'")
    tail = f"concat({_LINKED}, {_CITED})"
    csp = f"""concat('<div class="gs_rs"><div class="gsh_csp"> ', {text}, '</div></div>', {tail})"""
    rs = f"""concat('<div class="gs_rs gs_fma_s">', {text}, '<b>end</b><br></div>', {_LINKED_ONCE})"""
    snippet = f"""concat('<div class="gs_fma_snp"><div>', {text}, '<div>inner</div></div></div>', {tail})"""
    html = f"""concat('<html><body><div class="gs_r gs_or"><h3 class="gs_rt">', title, '</h3></div>', CASE kind % 10
        WHEN 0 THEN {_result(_heading("title", link), csp, "gs_r gs_or gs_scl gs_fmar")}
        WHEN 1 THEN concat({other}, {_result(_heading("concat('<b>', upper(title), '</b>')", link), rs)})
        WHEN 2 THEN concat({_result("concat('<h3 class=\"gs_rt\"><span>[CITATION]</span>  <span>', title, '</span></h3>')", snippet)}, {other})
        WHEN 3 THEN concat({_result(_heading("concat('“', title, '”')", link), tail)}, {other})
        WHEN 4 THEN concat({_result(_heading("title", link), rs)}, {_result(_heading("title", "'https://second.example/'"), csp)})
        WHEN 5 THEN {_result(_heading("concat('[PDF] Other <i>study</i> ', doc_id)", link), snippet)}
        WHEN 6 THEN concat({other}, {other})
        WHEN 7 THEN '<p>nothing found</p>'
        WHEN 9 THEN {_result("''", csp)} END, '</body></html>')"""
    rows = articles(documents).filter("kind % 10 <> 8")
    return rows.select(
        F.col("doc_id").alias("page_id"), title_search_url(F.col("title")).alias("url"), _sql(html).alias("html")
    )


# -- citing list pages -------------------------------------------------------------
def papers(part: DataFrame) -> DataFrame:
    """Parts as matched papers with a cited-by link; those of type SMALL have none."""
    return part.select(
        _sql("concat(p_name, ' ', p_partkey)").alias("original_title"),
        _sql("concat('https://paper.example/', p_partkey)").alias("url"),
        _sql("CASE WHEN p_type <> 'SMALL' THEN concat('{SITE}/scholar?cites=', p_partkey) END").alias("cited_articles_url"),
    )


_LISTED = """transform(sequence(10 * j + 1, least(10 * j + 10, p_size)), i -> concat(
    '<div class="gs_r gs_or gs_scl', CASE WHEN i % 2 = 0 THEN ' gs_fmar' ELSE '' END, '">',
    CASE WHEN i % 7 = 0 THEN '' ELSE concat('<h3 class="gs_rt"><span> [CITATION]</span> <a',
        CASE WHEN i % 5 = 0 THEN '' ELSE concat(' href="https://citing.example/', p_partkey, '/', i, '"') END,
        '>Citing <b>', i, '</b> of ', p_name, '</a></h3>') END,
    CASE WHEN i % 3 = 0 THEN '' ELSE concat('<a href="/scholar?cites=', p_partkey, 'x', i, '">Cited by ', i, '</a>') END,
    '</div>'))"""


def listing_pages(part: DataFrame) -> DataFrame:
    """`p_size` citing articles per part, ten a page; the third pages of Brand#13 are missing."""
    html = f"""concat('<html><body>', array_join({_LISTED}, ''), '<div id="gs_nml">',
        array_join(transform(sequence(0, cast(ceil(p_size / 10) as int) - 1), n -> concat(
            '<a class="gs_nma" href="/scholar?cites=', p_partkey,
            CASE WHEN n = 0 THEN '' ELSE concat('&amp;start=', 10 * n) END, '">', n + 1, '</a>')), ''),
        '<a class="gs_nma" href="/scholar?cites=', p_partkey, '">1</a><a href="/next">next</a></div></body></html>')"""
    rows = part.withColumn("j", _sql("explode(sequence(0, cast(ceil(p_size / 10) as int) - 1))"))
    rows = rows.filter("NOT (p_brand = 'Brand#13' AND j = 2)")
    return rows.select(
        F.col("p_partkey").alias("page_id"),
        _sql("concat('{SITE}/scholar?cites=', p_partkey, CASE WHEN j = 0 THEN '' ELSE concat('&start=', 10 * j) END)").alias("url"),
        _sql(html).alias("html"),
    )


# -- all pages a run of the four jobs needs --------------------------------------------
def chain_pages(customer: DataFrame) -> DataFrame:
    """Search and profile pages of the customers; article, result and listing page of each article."""
    # 0 stands for the customer's own pages. All kinds lie together, so that each file holds about as many of every kind.
    rows = people(customer).withColumn("k", _sql("explode(sequence(0, greatest(coalesce(c_nationkey, 0), 0)))"))
    rows = rows.withColumn("title", _sql("concat('Paper ', k, ' of ', c_name, ' & co')"))
    article = f"""concat('<html><body>', {_field("'Authors'", "c_name")}, {_field("'Journal'", "c_mktsegment")}, '</body></html>')"""
    result = f"""concat('<html><body>', {_result(_heading(_escaped("title"), "concat('https://paper.example/', c_custkey, '/', k)"),
        "concat('<a href=\"/scholar?cites=', c_custkey, 'p', k, '\">Cited by ', k, '</a>')")}, '</body></html>')"""
    listing = """concat('<html><body>', array_join(transform(sequence(1, 1 + k % 3), i -> concat(
        '<div class="gs_r gs_or gs_scl"><h3 class="gs_rt"><a href="https://citing.example/', i, '">Citing ', i, ' of ',
        c_name, '</a></h3></div>')), ''), '</body></html>')"""
    addressed = [
        (_sql("concat('{SITE}/citations?view_op=view_citation&id=', c_custkey, ':', k)"), article),
        (title_search_url(F.col("title")), result),
        (_sql("concat('{SITE}/scholar?cites=', c_custkey, 'p', k)"), listing),
    ]
    of_article = F.array(*(F.struct(url.alias("url"), _sql(html).alias("html")) for url, html in addressed))
    of_customer = F.array(F.struct(*_search_page()), F.struct(*_profile_page()))
    return rows.select(F.col("c_custkey").alias("page_id"), F.inline(F.when(F.col("k") == 0, of_customer).otherwise(of_article)))
