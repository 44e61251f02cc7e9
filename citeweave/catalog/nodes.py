"""Nodes, selectors and text modes: on the given pages, and on small snippets made from parts."""

from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..operators.html_nodes import html_nodes
from ..operators.selectors import (
    all_nodes,
    attr,
    class_is,
    first_node,
    has_class,
    has_id,
    inside,
    labelled_section,
    labelled_value,
    let,
    next_anchor,
    page_nodes,
    page_texts,
    raw_text,
    sole_string,
    spaced_text,
    tag,
    tight_text,
    word_text,
)
from ..plans.matching import result_blocks
from ..rendering import listing_pages, table
from ..sources.tables import page_source
from .tables import UNESCAPED_H1


def _pages(spark, sf_dir, **wanted):
    return html_nodes(page_source(spark, f"{sf_dir}/pages.parquet").select("page_id", "html"), **wanted)


def node_counts(spark, sf_dir):
    """Elements per page and tag."""
    tags = _pages(spark, sf_dir, attrs=()).select("page_id", F.explode("nodes.tag").alias("tag"))
    return tags.groupBy("page_id", "tag").agg(F.count("*").alias("n"))


def headings(spark, sf_dir):
    h1 = first_node(page_nodes(), tag("h1"))
    return _pages(spark, sf_dir, within=("h1",)).select("page_id", tight_text(page_texts(), h1).alias("h1"))


def list_items(spark, sf_dir):
    texts = F.transform(all_nodes(page_nodes(), tag("li")), lambda n: tight_text(page_texts(), n))
    return _pages(spark, sf_dir, within=("li",)).select("page_id", F.posexplode(texts).alias("pos", "item")).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "item"
    )


def nav_links(spark, sf_dir):
    """Anchors inside the navigation, with their address and text."""
    anchors = all_nodes(inside(page_nodes(), first_node(page_nodes(), tag("nav"))), tag("a"))
    links = F.transform(anchors, lambda a: F.struct(attr(a, "href").alias("href"), raw_text(page_texts(), a).alias("text")))
    return _pages(spark, sf_dir, within=("nav",)).select("page_id", F.inline(links))


def languages(spark, sf_dir):
    """An attribute of the root element."""
    return _pages(spark, sf_dir, attrs=("lang",)).select(
        "page_id", attr(first_node(page_nodes(), tag("html")), "lang").alias("lang")
    )


def ads(spark, sf_dir):
    ad = first_node(page_nodes(), tag("div"), has_class("ad"))
    return _pages(spark, sf_dir, within=(".ad",)).select("page_id", spaced_text(page_texts(), ad).alias("ad"))


# -- snippets from parts -----------------------------------------------------------
def _snippets(spark, sf_dir, html, **wanted):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.expr(html).alias("html"))
    return html_nodes(parts, **wanted)


def text_modes(spark, sf_dir):
    html = """concat('<div><p id="x">  ', p_name, '<b> ', p_brand, ' &amp;</b>  <br>', p_type,
        '<script>no</script><!-- no --> </p>after</div>')"""
    parsed = _snippets(spark, sf_dir, html).withColumn("n", first_node(page_nodes(), has_id("x")))
    texts, n = page_texts(), F.col("n")
    return parsed.select(
        "p_partkey",
        raw_text(texts, n).alias("raw"),
        tight_text(texts, n).alias("tight"),
        spaced_text(texts, n).alias("spaced"),
        word_text(texts, n).alias("words"),
        normalize_text(raw_text(texts, n)).alias("normal"),
    )


def class_tests(spark, sf_dir):
    """One class token, the whole attribute, any of several tokens."""
    html = """concat('<div class="', p_type, ' box"></div><div class=" box  ', p_type, ' "></div>',
        '<p class="boxes ', p_name, '"></p>')"""

    def count(test):
        return F.size(all_nodes(page_nodes(), test)).cast("bigint")

    return _snippets(spark, sf_dir, html).select(
        "p_partkey",
        count(has_class("SMALL")).alias("token"),
        count(class_is("SMALL box", "box PROMO")).alias("whole"),
        count(has_class("red", "SMALL", "boxes")).alias("any_of"),
    )


# Value beside its label, away from it, missing, or a label that is not exact.
_LABELS = """concat('<div><div class="f">Brand</div><p>x</p><div class="v">', p_brand, '<i> !</i></div></div>',
    CASE p_type WHEN 'SMALL' THEN '' WHEN 'PROMO' THEN '<div><div class="f">Size</div><p><b class="v">no</b></p></div>'
        WHEN 'LARGE' THEN concat('<div><div class="f"> Size</div><div class="v">', p_size, '</div></div>')
        ELSE concat('<div><div class="f"><b>Size</b></div><div class="v">', p_size, '</div><div class="v">no</div></div>')
    END, '<a href="/after/', p_partkey, '">after</a>')"""


def labelled_values(spark, sf_dir):
    def value(label):
        return labelled_value(page_nodes(), page_texts(), (has_class("f"), sole_string(label)), (tag("div"), has_class("v")))

    parsed = _snippets(spark, sf_dir, _LABELS)
    return parsed.select("p_partkey", value("Brand").alias("b"), value("Size").alias("s")).select(
        "p_partkey", F.col("b.value").alias("brand"), F.col("s.labelled").alias("labelled"), F.col("s.value").alias("size")
    )


def labelled_sections(spark, sf_dir):
    """The first section whose stripped label fits; a padded label fits here."""
    size = labelled_section(page_nodes(), page_texts(), (tag("div"),), (has_class("f"),), (has_class("v"),), ("Size",))
    return _snippets(spark, sf_dir, _LABELS).select("p_partkey", size.alias("size"))


def following_anchors(spark, sf_dir):
    label = first_node(page_nodes(), has_class("f"), sole_string("Size"))
    return _snippets(spark, sf_dir, _LABELS).select(
        "p_partkey", attr(next_anchor(page_nodes(), label), "href").alias("href")
    )


def blocks(spark, sf_dir):
    """Result blocks of the listing pages, with their place and heading text."""
    parsed = html_nodes(listing_pages(table(spark, sf_dir, "part")).select("url", "html"), within=(".gs_r",), attrs=())
    texts = result_blocks(page_nodes(), lambda below: let(first_node(below, tag("h3")), lambda h: tight_text(page_texts(), h)))
    return parsed.select("url", F.posexplode(texts).alias("pos", "heading")).select(
        "url", F.col("pos").cast("bigint").alias("pos"), "heading"
    )


QUERIES = {
    "html_nodes": node_counts,
    "first_node": headings,
    "all_nodes": list_items,
    "nested_node": nav_links,
    "node_attr": languages,
    "class_selector": ads,
    "text_modes": text_modes,
    "class_tests": class_tests,
    "labelled_value": labelled_values,
    "labelled_section": labelled_sections,
    "next_anchor": following_anchors,
    "result_blocks": blocks,
}

_TAGS = "html head meta title style script body nav ul li a div article h1 p b br footer".split()

ORACLES = {
    "html_nodes": "SELECT * FROM (SELECT page_id, tag, len(regexp_extract_all(html, '<' || tag || '[ >]')) AS n"
    f" FROM pages, (SELECT unnest({_TAGS}) AS tag)) WHERE n > 0",
    "first_node": f"SELECT page_id, trim({UNESCAPED_H1}) AS h1 FROM pages",
    "all_nodes": """SELECT page_id, pos, items[pos + 1] AS item
        FROM (SELECT *, unnest(range(len(items))) AS pos
            FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items FROM pages))""",
    "nested_node": """SELECT page_id, unnest(regexp_extract_all(nav, '<a href="([^"]*)">', 1)) AS href,
            unnest(regexp_extract_all(nav, '<a href="[^"]*">([^<]*)</a>', 1)) AS text
        FROM (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS nav FROM pages)""",
    "node_attr": "SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages",
    "class_selector": "SELECT page_id, trim(regexp_extract(html, '<div class=\"ad\">(.*?)</div>', 1, 's')) AS ad FROM pages",
    "text_modes": """SELECT p_partkey, '  ' || p_name || ' ' || p_brand || ' & ' || p_type || ' ' AS raw,
            p_name || p_brand || ' &' || p_type AS tight,
            p_name || '  ' || p_brand || ' &   ' || p_type AS spaced,
            p_name || ' ' || p_brand || ' & ' || p_type AS words,
            p_name || ' ' || p_brand || ' & ' || p_type AS normal FROM part""",
    "class_tests": """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 2 ELSE 0 END::BIGINT AS token,
            CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 1 ELSE 0 END::BIGINT AS whole,
            (1 + CASE WHEN p_type = 'SMALL' THEN 2 ELSE 0 END)::BIGINT AS any_of FROM part""",
    "labelled_value": """SELECT p_partkey, p_brand || '!' AS brand, p_type NOT IN ('SMALL', 'LARGE') AS labelled,
            CASE WHEN p_type NOT IN ('SMALL', 'LARGE', 'PROMO') THEN p_size::VARCHAR END AS size FROM part""",
    "labelled_section": """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'no' WHEN p_type <> 'SMALL'
            THEN p_size::VARCHAR END AS size FROM part""",
    "next_anchor": """SELECT p_partkey, CASE WHEN p_type NOT IN ('SMALL', 'LARGE')
            THEN '/after/' || p_partkey END AS href FROM part""",
    "result_blocks": """SELECT 'https://scholar.google.com/scholar?cites=' || p_partkey ||
                CASE WHEN i <= 10 THEN '' ELSE '&start=' || ((i - 1) // 10 * 10) END AS url,
            (i - 1) % 10 AS pos, CASE WHEN i % 7 <> 0 THEN '[CITATION]Citing' || i || 'of ' || p_name END AS heading
        FROM (SELECT *, unnest(range(1, p_size + 1)) AS i FROM part)
        WHERE NOT (p_brand = 'Brand#13' AND i > 20 AND i <= 30)""",
}
