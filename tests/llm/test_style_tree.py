import html
import math
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.llm import style_tree
from citeweave.llm.dom import read_page
from citeweave.llm.queries import QUERIES
from citeweave.llm.style_tree import extract, main_text
from citeweave.llm.tables import read

SF = "/root/testdata/sf0.001"
PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)


def text(source):
    return main_text(read_page(source))


@pytest.mark.parametrize(
    "source, want",
    [
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<article><p>a &amp; b&nbsp;c &#233;<p>d<br>e <b>f</b>g</article>", "a & b c é\n\nd e fg"),
        ("<title>no</title><body><nav>menu</nav><article><h1>T</h1><p>x</article><footer>f</footer>", "T\n\nx"),
        ("<article><header><h1>T</h1><p>By me</p></header><p>x</p><aside>side</aside><p>y</article>", "T\n\nx\n\ny"),
        ("<article>x<script>var t='</article><p>no';</script>y<style>p{}</style></article>", "xy"),
        ("<article><p>x</p><div class='cookie-notice'>eat<div>deep</div></div><ul><li>a<li>b</ul></article>", "x\n\na\n\nb"),
        ("<main><p>x</p><section id=comments><p>first!</p></section><form><p>mail</p></form></main>", "x"),
        ("<article><p>x</p><div class=readerComments><article class=comment><p>hm</p></article></div></article>", "x"),
        ("<div class=content><p>x</p></div><div class='ad'>buy</div><!-- <p>no</p> --><p>y", "x\n\ny"),
        ("<article></article><p>only here", "only here"),
        ("<article><p>1 < 2 and a<b></p><p title='>'>z</p></article>", "1 < 2 and a\n\nz"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes <span class='share'>tweet</span>!</p></article>", "yes !"),
        ("<ARTICLE><DIV>A<P>B</DIV>C</ARTICLE>", "A\n\nB\n\nC"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("<article><p>open <!-- never closed", "open"),
    ],
)
def test_blocks(source, want):
    assert text(source) == want


def soup(i, host="h"):
    """No element says what it is; only statistics tell the frame from the story."""
    story = f"<div class=c3><p>Story {i} tells of {i * 7}</p><p>and ends with {i * i}</p></div>"
    return (i, f"http://{host}.example/{i}", f"<div class=c1><p>Home</p><p>News</p></div><div class=c2>{story}</div><div class=c4><p>All rights</p></div>")


def test_unimportant_branches_go(spark):
    rows = [soup(i) for i in range(30)] + [soup(i, "tiny") for i in range(100, 103)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    assert got[7] == "Story 7 tells of 49\n\nand ends with 49"
    assert got[101].startswith("Home")  # three pages are no evidence
    assert len(got) == 33


def test_repeated_block_inside_articles(spark):
    rows = [(i, "http://a.example/x", f"<article><p>Text {i}</p><p>Read more on our site</p></article>") for i in range(40)]
    rows += [(i, "http://b.example/x", "<article><p>The same copy</p></article>") for i in range(50, 60)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Text 3" and got[55] == "The same copy"


def brute_decisions(rows):
    """Branches and repeated texts by the definition, from all pages at once."""
    looks, texts, pages, above_of = defaultdict(Counter), defaultdict(Counter), defaultdict(set), {}
    for i, _, source in rows:
        page, mine = read_page(source), defaultdict(list)
        for path, above, children in page.styles:
            mine[path].append(children)
            above_of[path] = above
        for path, children in mine.items():
            looks[path]["|".join(children)] += 1
            pages[path].add(i)
        for path, value in {(above[-1], t) for above, _, t in page.blocks}:
            texts[path][value] += 1

    def entropy(counts):
        n = sum(counts.values())
        return 1.0 if n == 1 else -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(n)

    weight, total = Counter(), Counter()
    for path, counts in texts.items():
        for distance, branch in enumerate((path, *reversed(above_of[path]))):
            w = style_tree.DECAY**distance * sum(counts.values())
            weight[branch] += w
            total[branch] += w * entropy(counts)
    return {
        b for b in total
        if len(pages[b]) >= style_tree.LEAST_PAGES
        and max(total[b] / weight[b], entropy(looks[b]) * style_tree.DECAY) < style_tree.LEAST_IMPORTANCE
    }


def test_importance_is_the_discounted_entropy(spark):
    rows = [soup(i) for i in range(25)]
    rows += [(i, "http://h.example/q", f"<div class=c1><p>Home</p></div><div class=c9><p>{i % 3}</p><ul><li>x</ul></div>") for i in range(50, 70)]
    seen = style_tree._observations(spark.createDataFrame(rows, PAGES).select(F.lit(1).cast("long").alias("host"), "html").repartition(3))
    (found,) = style_tree._decisions(seen).collect()
    assert set(found.branches) == brute_decisions(rows) and found.branches


def test_odd_tables(spark):
    assert extract(spark.createDataFrame([], PAGES)).count() == 0
    rows = [(1, None, None), (None, "not a url", "<p>x"), (1, "http://a/b", ""), (1, "http://a/b", "")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"text": F.lit("old"), "host": F.lit(3), "_host": F.lit(4)})
    got = extract(pages)
    assert sorted(r.text for r in got.collect()) == ["", "", "", "x"] and "host" in got.columns
    long = "<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "<p>word " * 20_000
    assert extract(spark.createDataFrame([(1, "http://a/b", long)], PAGES)).first().text.startswith("deep\n\nword")


def test_whole_table_against_a_plain_reading(spark):
    source = {r.page_id: r for r in read(spark, SF, "pages").collect()}
    rows = QUERIES["op10_style_tree"](spark, SF).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r.page_id].html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|article|ul|li|div)\b[^>]*>", re.sub(r"<br[^>]*>", " ", article))
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b), r.page_id
        assert r.url == source[r.page_id].url and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "source, want",
    [
        ("<div class='layout has-sidebar'><article><p>a story</p></article></div><nav>menu</nav>", "a story"),
        ("<div class='no-comments'><p>all there is</p></div>", "all there is"),
        ("<article class='post category-legal'><h1>T</h1><p>x</article>", "T\n\nx"),
        ("<article class='social search'>x</article><article class='related'>y</article>", "x\n\ny"),
        ("<article><h1>T</h1><div class='social-body'><p>the story in full</div></article>", "T\n\nthe story in full"),
        ("<body><form action=/x><div><article><p>a story</article></div></form>", "a story"),
        ("<body><form action=/x><div><p>a story</div></form>", "a story"),
        ("<article data-title='Hidden costs'><p data-hidden='false'>x<p data-class=ad>y</article>", "x\n\ny"),
        ("<article><p>one <span class='search-hit'>word</span> more</p></article>", "one word more"),
        ("<p><span class=share>most of the words</span> here", "most of the words here"),
        ("<article><p>x</article><div class=ad>an advert of more words</div>", "x"),
        ("<div class='layout has-sidebar'><article>x</article><div class=sidebar>y</div></div>", "x"),
        ("<article><p>x y<div class=share-bar hidden><p>a b c d</div></article>", "x y"),
    ],
)
def test_a_name_alone_drops_no_article(source, want):
    assert text(source) == want


def words(i, n=30):
    return " ".join(f"w{i * j % 997}x{j}" for j in range(n))


def test_body_beside_teaser_articles(spark):
    teasers = "".join(f"<article class=card><p>Teaser {k} is the same on all pages</p></article>" for k in range(4))
    rows = [(i, "http://a.example/x", f"<body>{teasers}<div class=story><p>{words(i)}</p></div></body>") for i in range(1, 31)]
    # Too few pages for statistics: the body is longer than any teaser.
    rows += [(i, "http://few.example/x", f"<body>{teasers}<div class=story><p>{words(i)}</p></div></body>") for i in range(40, 43)]
    # Short bodies beside longer teasers: the tree alone tells.
    long = "".join(f"<article class=card><p>{words(k, 40)}</p></article>" for k in (5, 6))
    rows += [(i, "http://b.example/x", f"<body>{long}<div class=story><p>Body {i}</p></div></body>") for i in range(50, 80)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == words(3) and got[41].endswith(words(41)) and got[55] == "Body 55"


def test_unnamed_frame_inside_main(spark):
    frame = "<div class=offers><p>All sections</p><p>Our offers</p></div>"
    rows = [(i, "http://a.example/x", f"<main>{frame}<div class=story><p>{words(i)}</p></div></main>") for i in range(1, 11)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: words(i) for i in range(1, 11)}
    # Many texts in one place, each on all pages.
    frame = "".join(f"<p>Offer {k}</p>" for k in range(40))
    rows = [(i, "http://a.example/x", f"<main>{frame}<div class=story><p>{words(i)}</p></div></main>") for i in range(1, 41)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: words(i) for i in range(1, 41)}


def test_a_heavy_frame_takes_no_article_with_it(spark):
    frame = "".join(f"<div class={a}{b}><p>Frame {a}{b}</p></div>" for a in "qxyz" for b in "qwxyz")
    rows = [(i, "http://a.example/x", f"<body>{frame}<article><p>{words(i)}</p></article></body>") for i in range(1, 21)]
    rows += [(i, "http://b.example/x", f"<body>{frame}<div><p>{words(i)}</p></div></body>") for i in range(30, 50)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(text == words(i) for i, text in got.items())


def test_copies_are_evidence_once(spark):
    story = "".join(f"<p>Part {k} of the one story</p>" for k in range(3))
    whole = "\n\n".join(f"Part {k} of the one story" for k in range(3))
    rows = [(i, f"http://a.example/{i}", f"<article>{story}</article>") for i in range(100)]
    rows += [(i, f"http://a.example/{i}", f"<article><p>Other {i}</p></article>") for i in range(100, 110)]
    rows += [(i, f"http://b.example/{i}", f"<div><p>Seen {i} times</p></div><article>{story}</article>") for i in range(200, 300)]
    rows += [(i, f"http://c.example/{i}", f"<div class=c1>{story}</div>") for i in range(300, 400)]
    rows += [(i, None if i % 2 else "odd", f"<article>{story}</article>") for i in range(400, 500)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[105] == "Other 105" and len(got) == 410
    assert all(whole in text for i, text in got.items() if not 100 <= i < 110)


def test_repeated_texts_go_where_they_repeat(spark):
    rows = [(i, "http://a.example/x", f"<article><p>Text {i}</p><p>Read more</p></article>") for i in range(40)]
    rows += [(40, "http://a.example/x", "<article><h2>Read more</h2><p>Text 40</p></article>")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Text 3" and got[40] == "Read more\n\nText 40"


STORY = " ".join(f"story{k}" for k in range(40))
LONG = "<p>" + "</p><p>".join(" ".join(f"remark{i}x{k}" for k in range(30)) for i in range(3)) + "</p>"


@pytest.mark.parametrize(
    "source",
    [
        "<main><h1>T</h1><p>{story}</p><div id=comments>{long}</div></main>",
        "<article><h1>T</h1><p>{story}</p><section class=replies>{long}</section></article>",
        "<article><h1>T</h1><p>{story}</p></article><div class=comment-list>{long}</div>",
        "<main><article><h1>T</h1><p>{story}</p></article><div class='post comments-open'><div class=comment>{long}</div></div></main>",
        "<div><h1>T</h1><p>{story}</p></div><div id=disqus_thread>{long}</div>",
        "<article><h1>T</h1><p>{story}</p></article><div class=sidebar>{long}</div>",
        "<main><h1>T</h1><p>{story}</p><div class=sidebar-right>{long}</div></main>",
        "<div><h1>T</h1><p>{story}</p></div><div class=sidebar>{long}</div>",
        "<main><h1>T</h1><p>{story}</p><form action=/x>{long}</form></main>",
        "<div><h1>T</h1><p>{story}</p></div><form action=/x>{long}</form>",
        "<article><h1>T</h1><p>{story}</p><div class=advert>{long}</div></article>",
        "<div class='layout has-sidebar no-comments'><h1>T</h1><p>{story}</p><div class=sidebar>{long}</div></div><p>Skip",
        "<article><h1>T</h1><p>{story}</p></article><div class=c7>{long}</div>",
    ],
)
def test_length_makes_no_surroundings_a_story(source):
    got = text(source.format(story=STORY, long=LONG))
    assert got.replace("\n\nSkip", "") == f"T\n\n{STORY}"


def test_comments_of_a_whole_host(spark):
    def page(i):
        remarks = "".join(f"<p>{words(i + 31 * k)}</p>" for k in range(1, 4))
        return f"<main><p>{words(i, 40)}</p><div id=comments>{remarks}</div></main>"

    rows = [(i, "http://a.example/x", page(i)) for i in range(1, 31)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: words(i, 40) for i in range(1, 31)}


@pytest.mark.parametrize(
    "source",
    [
        "<a " * 100_000, "<div" * 100_000, "<div>" * 100_000, "<div class=nav>" * 100_000 + "x", "<div class=nav><p>a" * 50_000,
        "<a '>' " * 50_000 + '"', "<a \"" * 100_000 + ">", "<!x" * 100_000, "<span hidden>" * 100_000,
        "<span class=share>" * 100_000 + "<p>x</span>", "<div>" * 50_000 + "</p></section>" * 50_000, "<script></script " * 50_000,
        "<form>" * 100_000 + "<h1>x", "<b x='" * 100_000, "</div x" * 100_000, "<p hidden>" * 100_000 + "</span>",
    ],
)
def test_reading_takes_time_in_proportion(source):
    def seconds(n):
        begun = time.process_time()
        main_text(read_page(source[:n]))
        return time.process_time() - begun

    half, whole = seconds(len(source) // 2), seconds(len(source))
    assert whole < 4 and whole < 3.2 * half + 0.3


def test_tags_with_unclosed_quotes_end_at_the_next_bracket():
    assert text("<article><p>a <a href='x>link</a> b<p title=\"y>c</article>") == "a link b\n\nc"
    assert text("<p>1 < 2 <b") == "1 < 2 <b"


def test_depth_changes_paths_alone():
    deep = "<article>" + "<div>" * 400 + "<nav>menu<div>menu</div>menu</nav>text" + "</div>" * 400 + "end</article>beside"
    page = read_page(deep)
    assert main_text(page) == "text\n\nend" and max(len(b[0]) for b in page.blocks) <= 129
