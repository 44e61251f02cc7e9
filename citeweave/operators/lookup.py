"""Page lookups: the record extracted from the page a row points to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .hot_keys import HOT_ROWS, HotKeys, profile_keys

LEAST_ID = -(1 << 63)  # stands for a missing page id, which is lower than any


def page_lookup(pages, extract, name: str, **options):
    """A lookup in `pages`, or in the records of a store that was given in their place."""
    if not isinstance(pages, DataFrame):
        return pages.lookup(extract, **options)
    return PageLookup(pages, extract, name, **options)


class PageLookup:
    """Joins rows to `extract(pages)` on the page address.

    `extract` turns pages into `(url, page_id, record)`. HTML is never shuffled: pages are parsed
    where they are read and only the records move. Which pages are parsed follows from the
    measured size of the wanted addresses:

    * small: they are broadcast and the other pages are dropped before parsing;
    * large: all pages are parsed, once, and the records are kept for further lookups.

    `plan` is "auto" for this choice by size, "broadcast" or "scan" to make it: the rows are the same.

    If an address is stored more than once, its page with the highest `page_id` counts; no `page_id` is
    lower than any, and among equal ones the page's hash decides, so a run always takes the same page. The choice
    reads addresses and ids alone; HTML is read once, to be parsed, and hashed only where ids are equal.
    """

    def __init__(self, pages: DataFrame, extract, name: str, hot_rows: int = HOT_ROWS,
                 reuse: bool = False, plan: str = "auto"):
        if plan not in ("auto", "broadcast", "scan"):
            raise ValueError(f"plan must be auto, broadcast or scan, not {plan!r}")
        self.pages, self.extract, self.name = pages, extract, name
        self.hot_rows, self.reuse, self.plan = hot_rows, reuse, plan
        self._all = None

    def _versions(self):
        """Address and id of every page: two columns of the page table."""
        return self.pages.select(F.col("url").alias("_wanted"), F.coalesce("page_id", F.lit(LEAST_ID)).alias("_id"))

    def _parsed(self, pages, several: bool):
        """Records of `pages`, one per address; `several` tells that an address may have more than one page."""
        if not several:
            return self.extract(pages).select(F.col("url").alias("_url"), "record")
        version = F.struct(F.coalesce("page_id", F.lit(LEAST_ID)).alias("page_id"), F.xxhash64("html").alias("hash"))
        records = self.extract(pages.withColumn("page_id", version)).select(F.col("url").alias("_url"), "page_id", "record")
        # Copies are reduced map-side first. Without hot keys the join reuses this shuffle.
        return records.groupBy("_url").agg(F.max_by("record", "page_id").alias("record"))

    def _records(self, left, key, profile):
        known = self.pages.filter("url IS NOT NULL")
        if self.plan == "broadcast" or (self.plan == "auto" and profile.fits_broadcast):
            wanted = left.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct()
            found = self._versions().join(F.broadcast(wanted), F.col("_wanted") == F.col("_key"), "left_semi")
            # Older copies are dropped before they are parsed: one short row per wanted address tells the newest.
            newest = found.groupBy("_wanted", "_id").agg(F.count("*").alias("_copies"))
            newest = newest.groupBy("_wanted").agg(F.max(F.struct("_id", "_copies")).alias("_newest"))
            newest = materialise(newest.select("_wanted", "_newest.*"), "newest")
            tied = newest.filter("_copies > 1").limit(1).count() > 0
            same = (F.col("url") == F.col("_wanted")) & (F.coalesce("page_id", F.lit(LEAST_ID)) == F.col("_id"))
            return self._parsed(known.join(F.broadcast(newest), same, "left_semi"), tied)
        if self._all is None:
            several = self._versions().filter("_wanted IS NOT NULL").groupBy("_wanted").count().filter("count > 1").limit(1).count() > 0
            records = self._parsed(known, several)
            self._all = materialise(records, self.name) if self.reuse else records
        return self._all

    def join(self, left: DataFrame, key: str, how: str) -> DataFrame:
        """`left` with a `record` column; `how` is inner or left."""
        profile = profile_keys(left, key, self.hot_rows)
        hot = HotKeys(left, key, profile, self.hot_rows)
        # The one newest page of a hot address is repeated, never its copies.
        newest = self._records(left, key, profile)
        equal = F.col(key) == F.col("_url")
        return hot.join(hot.deal(left), hot.repeat(newest, "_url"), equal, how).drop("_url")
