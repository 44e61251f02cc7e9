"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged into one tree: a node is the path of elements that leads to it, with the
names of their classes. How a node's children look and what it says, over the pages, gives its
importance: an entropy near 1 where every page differs, near 0 where all pages are alike. A branch's
importance is the mean over its nodes, near ones counting more; unimportant branches are
removed from each page, whether it marks an article or not. A branch that holds most of what is important on a page stays.

Elements that say what they are (menus, footers, adverts, comments) go without statistics. An article or main is a sign, and so is a
name of surroundings on an element too large to drop by it: what stands outside of the page's article needs twice the importance
unless it is longer than the article, and so does what is inside of such a name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import ARTICLE, HEADER, NAMED, NUMBER, Page, read_page, text_name, words_in
from .tables import materialise

DECAY = 0.7  # how much less each level below counts for a branch
LEAST_IMPORTANCE = 0.3
SIGN = 0.5  # what a sign against a branch leaves of its importance
LEAST_PAGES = 8  # a tree of fewer pages says nothing about its branches
REPEATED_SHARE, REPEATED_PAGES = 0.6, 20
LEAST_ARTICLE = 25  # words from which on the only article of a page is taken at its word, however long what stands beside it
MAX_BROADCAST_HOSTS, MAX_BROADCAST_NAMES = 20_000, 2_000_000  # hosts, and 8-byte names in all their lists
BATCH_CHARS = 4 << 20
STYLE, CONTENT, PLACE = 0, 1, 2


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _pages(batches: Iterator[pa.RecordBatch], html: int):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch, i, read_page(batch.column(html)[i].as_py() or "")


def content_name(page: Page) -> int:
    """Equal for copies: a name of the texts of the page's one article if that is most of the page, else of all its texts."""
    inside = [b for b in page.blocks if b[1] & ARTICLE]
    if len({b[1] >> NUMBER for b in inside}) != 1 or 2 * sum(words_in(b[2]) for b in inside) < sum(words_in(b[2]) for b in page.blocks):
        inside = page.blocks
    return text_name("\n".join(sorted({b[2] for b in inside})))


def _observations(pages: DataFrame) -> DataFrame:
    """What each page shows of its host's tree: looks and texts of nodes, and the place of each node once per task."""
    ddl = "host long, path long, kind int, value long, above array<long>, page long"

    def run(batches):
        placed, out = set(), ([], [], [], [], [], [])

        def put(*row):
            for column, value in zip(out, row):
                column.append(value)

        def batch():
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64())
            names = ["host", "path", "kind", "value", "above", "page"]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
            for column in out:
                column.clear()
            return made

        for source, i, page in _pages(batches, 1):
            host = source.column(0)[i].as_py()
            looks, texts, name = {}, set(), content_name(page)
            for path, above, children in page.styles:
                looks.setdefault(path, []).append(children)
                if (host, path) not in placed:
                    if len(placed) > 200_000:
                        placed.clear()
                    placed.add((host, path))
                    put(host, path, PLACE, 0, list(above), name)
            for path, children in looks.items():
                put(host, path, STYLE, text_name("|".join(children)), None, name)
            for above, _, text in page.blocks:
                texts.add((above[-1] if above else 0, text_name(text)))
            for path, value in texts:
                put(host, path, CONTENT, value, None, name)
            if len(out[0]) > 20_000:
                yield batch()
        if out[0]:
            yield batch()

    return pages.select("host", "html").mapInArrow(run, ddl)


def _decisions(seen: DataFrame, copies: bool = True) -> DataFrame:
    """`(host, branches, repeated, doubtful, important)` of each host.

    branches: those of low importance; repeated: names of texts, with their paths, most pages repeat; doubtful: branches that a sign
    against them makes low; important: those with text of their own that stay even so. Without `copies`, what copies of a
    page show alike counts once.
    """
    facts = seen.filter(F.col("kind") != PLACE)
    if not copies:
        facts = facts.select("host", "page", "path", "kind", "value").distinct()
    counts = facts.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("c"))
    counts = materialise(counts, "style_counts")
    c = F.col("c").cast("double")
    nodes = counts.groupBy("host", "path", "kind").agg(F.sum("c").alias("n"), F.sum(c * F.log(c)).alias("s"))
    n = F.col("n").cast("double")
    entropy = F.when(F.col("n") > 1, (F.log(n) - F.col("s") / n) / F.log(n)).otherwise(1.0)
    nodes = materialise(nodes.withColumn("importance", entropy), "style_nodes")
    pages = nodes.filter(F.col("kind") == STYLE).select("host", "path", F.col("n").alias("pages"))

    places = seen.filter(F.col("kind") == PLACE).groupBy("host", "path").agg(F.max("above").alias("above"))
    # A node's texts count for the node and for every branch it is in.
    distance = F.posexplode(F.concat(F.array("path"), F.reverse("above"))).alias("distance", "branch")
    content = nodes.filter(F.col("kind") == CONTENT).select("host", "path", "n", "importance")
    weighed = content.join(places, ["host", "path"]).select("host", distance, "n", "importance")
    weight = F.pow(F.lit(DECAY), F.col("distance")) * F.col("n")
    looks = nodes.filter(F.col("kind") == STYLE).select("host", F.col("path").alias("branch"), F.col("importance").alias("look"))
    # A branch with one look on all pages may still say something new on each: it counts by the larger.
    importance = F.greatest("text", F.col("look") * F.lit(DECAY))
    listed = {
        "branches": importance < LEAST_IMPORTANCE,
        "doubtful": (importance >= LEAST_IMPORTANCE) & (importance * SIGN < LEAST_IMPORTANCE),
        "important": (importance * SIGN >= LEAST_IMPORTANCE) & F.col("own"),
    }
    branches = (
        weighed.groupBy("host", "branch")
        .agg((F.sum(weight * F.col("importance")) / F.sum(weight)).alias("text"), (F.min("distance") == 0).alias("own"))
        .join(looks, ["host", "branch"]).join(pages.withColumnRenamed("path", "branch"), ["host", "branch"])
        .filter(F.col("pages") >= LEAST_PAGES)
        .groupBy("host").agg(*(F.collect_set(F.when(which, F.col("branch"))).alias(name) for name, which in listed.items()))
    )
    repeated = (
        counts.filter((F.col("kind") == CONTENT) & (F.col("c") >= REPEATED_PAGES)).join(pages, ["host", "path"])
        .filter(F.col("c") >= F.lit(REPEATED_SHARE) * F.col("pages"))
        .groupBy("host").agg(F.collect_set(F.col("value").bitwiseXOR(F.col("path"))).alias("repeated"))
    )
    return branches.join(repeated, "host", "full").select("host", "branches", "repeated", "doubtful", "important")


def _removed(blocks: list, branches: frozenset[int]) -> frozenset[int]:
    """The low branches of a page, without those that hold most of the words whose own node is not low."""
    low, total = {}, 0
    for paths, _, text in blocks:
        if paths and paths[-1] in branches:
            low.setdefault(paths[-1], 0)
            continue
        n = words_in(text)
        total += n
        for path in set(paths):
            if path in branches:
                low[path] = low.get(path, 0) + n
    return frozenset(path for path, n in low.items() if not n or 2 * n <= total)


def main_text(
    page: Page, branches: frozenset[int] = frozenset(), repeated: frozenset[int] = frozenset(),
    doubtful: frozenset[int] = frozenset(), important: frozenset[int] = frozenset(),
) -> str:
    """Blocks outside of unimportant branches; of those beside an article, the important ones, or all if they are longer than every article.

    The only article of a page counts from `LEAST_ARTICLE` words on, whatever the length of what stands beside it.
    """
    kept = [b for b in page.blocks if not b[1] & HEADER]
    if not any(b[1] & ARTICLE for b in kept):
        kept = page.blocks
    if branches:
        removed = _removed(kept, branches)
        kept = [b for b in kept if removed.isdisjoint(b[0]) and not (b[0] and b[0][-1] in branches)]
    if doubtful:
        kept = [b for b in kept if not (b[1] & NAMED and b[0] and b[0][-1] in doubtful)]
    if repeated:
        kept = [b for b in kept if text_name(b[2]) ^ (b[0][-1] if b[0] else 0) not in repeated]
    articles, beside = {}, 0
    for _, flags, text in kept:
        if flags & ARTICLE:
            articles[flags >> NUMBER] = articles.get(flags >> NUMBER, 0) + words_in(text)
        else:
            beside += words_in(text)
    lone = len(articles) == 1 and max(articles.values()) >= LEAST_ARTICLE
    if articles and (lone or beside <= max(articles.values())):
        kept = [b for b in kept if b[1] & ARTICLE or (not b[1] & NAMED and b[0] and b[0][-1] in important)]
    return "\n\n".join(text for _, _, text in kept)


def extract(pages: DataFrame) -> DataFrame:
    """`pages` with `text`: the main text of each page, its blocks joined by an empty line; "" if there is none.

    A NULL html is an empty page; a NULL or odd url belongs to the host without a name. Repeated
    pages have rows of their own but are evidence once; a column named text is replaced, one named host is kept. Very
    long and deep pages are read in time in proportion to their length.
    """
    columns = [c for c in pages.columns if c not in ("text",)]
    hosts = F.xxhash64(host_of(F.col("url")))
    seen = materialise(_observations(pages.select(hosts.alias("host"), "html")), "style_seen")
    decided = materialise(_decisions(seen, copies=False), "style_tree")
    held = sum(F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0)) for c in decided.columns[1:])
    sizes = decided.agg(F.count("*").alias("hosts"), F.coalesce(F.sum(held), F.lit(0)).alias("names")).first()
    few = sizes.hosts <= MAX_BROADCAST_HOSTS and sizes.names <= MAX_BROADCAST_NAMES
    packed = pages.select(hosts.alias("_host"), "html", F.struct(*columns).alias("_page"))
    lists = ["_branches", "_repeated", "_doubtful", "_important"]
    decided = decided.toDF("_host", *lists)
    joined = packed.join(F.broadcast(decided) if few else decided, "_host", "left").select("html", *lists, "_page")
    schema = joined.select("_page").schema.add("text", "string")

    def run(batches):
        known = {}
        for batch in batches:
            texts = []
            for i in range(batch.num_rows):
                found = tuple(batch.column(k)[i].as_py() for k in range(1, 1 + len(lists)))
                name = tuple(tuple(x or ()) for x in found)
                sets = known.get(name)
                if sets is None:
                    known.clear()
                    sets = known[name] = tuple(map(frozenset, name))
                texts.append(main_text(read_page(batch.column(0)[i].as_py() or ""), *sets))
            yield pa.RecordBatch.from_arrays([batch.column(1 + len(lists)), pa.array(texts, pa.string())], names=["_page", "text"])

    return joined.mapInArrow(run, schema).select("_page.*", "text")
