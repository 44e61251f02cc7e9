"""Joins give the same rows whether or not their hot keys are dealt out."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from citeweave.operators import hot_keys, lookup
from citeweave.operators.hot_keys import hot_join, profile_keys
from citeweave.operators.lookup import PageLookup
from citeweave.operators.pending import pending
from citeweave.schemas import PAGES


def skewed(spark, n=600):
    """A third of the rows has key `hot`, a tenth has no key, half of the hot rows are copies."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 50) END")
    rows = spark.range(n).select(key.alias("key"), F.expr("CASE WHEN id % 2 = 0 THEN 0 ELSE id END").alias("v"))
    return rows.repartition(5)


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_join(spark, how, null_safe):
    left = skewed(spark)
    right = spark.createDataFrame([("hot",), ("hot",), ("k1",), ("k2",), (None,), ("z",)], "other string")
    a, b = F.col("key"), F.col("other")
    right_once = right.distinct()
    expected = left.join(right_once, a.eqNullSafe(b) if null_safe else a == b, how).select("key", "v")
    for hot_rows in (1, 20, 10_000):
        found = hot_join(left, "key", right, "other", how, null_safe, distinct=True, hot_rows=hot_rows)
        assert rows(found.select("key", "v")) == rows(expected)


def test_hot_join_keeps_repeated_right_rows(spark):
    left = skewed(spark)
    right = spark.createDataFrame([("hot", 1), ("hot", 1), ("k1", 2)], "other string, w int")
    expected = left.join(right, F.col("key") == F.col("other"))
    assert rows(hot_join(left, "key", right, "other", "inner", hot_rows=10)) == rows(expected)


def test_hot_rows_are_dealt_over_parts(spark):
    left = skewed(spark)
    hot = hot_keys.HotKeys(left, "key", profile_keys(left, "key", 20), 20)
    sizes = hot.deal(left).filter("key = 'hot'").groupBy(hot.LEFT_PART).count().collect()
    assert hot.any and len(sizes) > 4
    assert max(r["count"] for r in sizes) < 100


def test_profile_is_exact_when_it_decides(spark):
    profile = profile_keys(skewed(spark), "key", hot_rows=10)
    assert (profile.rows, profile.hottest) == (600, 200)
    assert profile.keys == skewed(spark).select("key").distinct().count()


def test_hot_list_is_bounded(spark):
    """However small the limit asked for, at most MAX_HOT_KEYS keys can pass the one used."""
    profile = hot_keys.KeyProfile(rows=10**12, keys=10**9, hottest=10**11, key_bytes=10**11)
    assert profile.rows // profile.hot_rows(1) <= hot_keys.MAX_HOT_KEYS


def extract(pages):
    return pages.select("url", "page_id", F.struct(F.col("html").alias("body")).alias("record"))


@pytest.mark.parametrize("narrow", [True, False])
@pytest.mark.parametrize("hot_rows", [10, 10_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_page_lookup(spark, monkeypatch, narrow, hot_rows, how):
    """The newest copy of each page; the same rows on all four ways to get them."""
    if not narrow:
        monkeypatch.setattr(hot_keys, "MAX_BROADCAST_KEYS", 0)
    copies = [(i, "hot", f"old{i}") for i in range(300)]
    pages = copies + [(999, "hot", "new"), (1, "k1", "one"), (2, "k2", "two"), (3, None, "no address"), (4, "x", "other")]
    stored = spark.createDataFrame(pages, PAGES).repartition(4)
    left = skewed(spark)
    newest = {"hot": "new", "k1": "one", "k2": "two"}
    expected = Counter()
    for key, v in left.collect():
        if how == "left" or key in newest:
            expected[(key, v, newest.get(key))] += 1
    found = PageLookup(stored, extract, "test", hot_rows, reuse=True).join(left, "key", how)
    assert rows(found.select("key", "v", "record.body")) == expected


@pytest.mark.parametrize("null_done", [True, False])
@pytest.mark.parametrize("hot_rows", [10, 10_000])
def test_pending_null_rule(spark, null_done, hot_rows):
    done = [("k1",), ("k1",), ("hot",)] + [(None,)] * null_done
    left = skewed(spark)
    keys = {k for k, in done}
    expected = Counter(tuple(r) for r in left.collect() if r.key not in keys)
    found = pending(left, "key", spark.createDataFrame(done, "d string"), "d", hot_rows)
    assert found.columns == ["key", "v"]
    assert rows(found) == expected


def test_pending_without_done_table(spark):
    left = skewed(spark)
    assert rows(pending(left, "key", None, "d")) == rows(left)
    assert rows(pending(left, "key", spark.createDataFrame([], "d string"), "d")) == rows(left)


def test_lookup_never_moves_html(spark):
    """Pages are parsed before any shuffle of theirs."""
    stored = spark.createDataFrame([(1, "k1", "one")], PAGES)
    plan = lookup.PageLookup(stored, extract, "test").join(skewed(spark), "key", "inner")
    text = plan._jdf.queryExecution().executedPlan().toString()
    for line in text.split("\n"):
        if "Exchange" in line:
            assert "html" not in line
