"""Benchmark decontamination by winnowing.

Of every `SPAN` words in a row, the word runs (k-grams) with the smallest hash are kept as fingerprints, so a
shared span of that length has a fingerprint in common, at the same place in both texts. Fingerprints
of the documents that may be the benchmark's (a bit table tells) are joined with the benchmark's, and each hit
is extended word by word to both sides. A benchmark item shorter than a span is one run of its own length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom import bit_table, may_hold
from .tables import drop_listed, materialise, numbered
from .words import ALNUM, Words, mix, slices, windows, words_of

SPAN, RUN = 13, 6
SIDE = SPAN - RUN  # words a hit can be extended by on either side
MAX_BROADCAST_FINGERPRINTS = 50_000
_BEFORE_DOC, _BEFORE_ITEM = np.uint64(0), np.uint64(1)  # stand-ins beyond a text's ends: equal to nothing


def _rolling(function, values: np.ndarray, size: int) -> np.ndarray:
    """`function` over each `size` values in a row, by doubling."""
    out, width = values, 1
    while 2 * width <= size:
        out, width = function(out[:-width], out[width:]), 2 * width
    return out if width == size else function(out[: len(values) - size + 1], out[size - width :])


def winnow(hashes: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest hash of some `width` hashes in a row of one text; all of equal ones."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _rolling(np.minimum, hashes, width)
    # A window lies in one text if it ends before the text does.
    counts = np.diff(bounds)
    end = np.repeat(bounds[1:], counts)[: len(least)]
    least[np.arange(len(least)) + width > end] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero((_rolling(np.maximum, padded, width) == hashes) & (hashes > 0))


def _context(words: Words, row: np.ndarray, first: np.ndarray, beyond: np.uint64) -> np.ndarray:
    """The `SIDE` words before a run, nearest first, and those after it."""
    at = np.concatenate([first[:, None] - 1 - np.arange(SIDE), first[:, None] + RUN + np.arange(SIDE)], axis=1)
    outside = (at < words.bounds[row][:, None]) | (at >= words.bounds[row + 1][:, None])
    at[outside] = 0
    out = words.hash[at] if len(first) else np.zeros((0, 2 * SIDE), np.uint64)
    out[outside] = beyond
    return out


def _tagged(hashes: np.ndarray, n: int) -> np.ndarray:
    return mix(hashes + np.uint64(n))


def _runs(words: Words, size: int, winnowed: bool):
    """Row, first word and key of the runs of `size` words; only fingerprints if `winnowed`."""
    hashes, bounds = windows(words, size)
    at = winnow(hashes, bounds, SPAN - size + 1) if winnowed else np.arange(len(hashes))
    row = np.searchsorted(bounds, at, "right") - 1
    return row, words.bounds[row] + at - bounds[row], _tagged(hashes[at], SPAN if winnowed else size)


def _lists(row: np.ndarray, rows: int, values: np.ndarray, width: int = 1) -> pa.Array:
    """A list per row of what belongs to it; `row` ascends."""
    bounds = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32) * width
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.ravel()))


def _item_runs(items: DataFrame) -> DataFrame:
    """Fingerprints of the benchmark: item, run length, key, and the words around."""
    ddl = "item_id long, n int, key long, around array<long>"

    def run(batches: Iterator[pa.RecordBatch]):
        for batch, texts in slices(batches, "text"):
            words = words_of(texts, ALNUM)
            counts = words.counts
            row, first, key = _runs(words, RUN, winnowed=True)
            parts = [(row, np.full(len(row), RUN), key, _context(words, row, first, _BEFORE_ITEM))]
            for n in np.unique(counts[(counts > 0) & (counts < SPAN)]):
                row, _, key = _runs(words, int(n), winnowed=False)
                mine = counts[row] == n
                row, key = row[mine], key[mine]
                parts.append((row, np.full(len(row), n), key, np.zeros((len(row), 2 * SIDE), np.uint64)))
            row, n, key, around = (np.concatenate(x) for x in zip(*parts))
            bounds = pa.array(np.arange(len(row) + 1, dtype=np.int32) * 2 * SIDE)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)), pa.array(n, pa.int32()), pa.array(key.view(np.int64)),
                    pa.ListArray.from_arrays(bounds, pa.array(around.view(np.int64).ravel())),
                ],
                names=["item_id", "n", "key", "around"],
            )

    return items.select("item_id", "text").mapInArrow(run, ddl)


def _scan(docs: DataFrame, table: np.ndarray, shorts: list[int]) -> DataFrame:
    """A row per document with its word count and the runs that may be the benchmark's."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    ddl = "_row long, doc_id long, text_hash long, n_words long, key array<long>, n array<int>, first array<int>, around array<long>"

    def run(batches: Iterator[pa.RecordBatch]):
        for batch, texts in slices(batches, "text"):
            words = words_of(texts, ALNUM)
            parts = []
            for n in [RUN, *shorts]:
                row, first, key = _runs(words, n, winnowed=n == RUN and not parts)
                maybe = may_hold(shared.value, key)
                row, first, key = row[maybe], first[maybe], key[maybe]
                around = _context(words, row, first, _BEFORE_DOC)
                parts.append((row, first - words.bounds[row], key, around, np.full(len(row), n)))
            row, first, key, around, n = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(row, kind="stable")
            row, size = row[order], len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), pa.array(words.counts, pa.int64()),
                    _lists(row, size, key[order].view(np.int64)), _lists(row, size, n[order].astype(np.int32)),
                    _lists(row, size, first[order].astype(np.int32)), _lists(row, size, around[order].view(np.int64), 2 * SIDE),
                ],
                names=["_row", "doc_id", "text_hash", "n_words", "key", "n", "first", "around"],
            )

    docs = numbered(docs).select("_row", "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return docs.mapInArrow(run, ddl)


def _extended(hits: DataFrame) -> DataFrame:
    """Hits as spans of words, as far as both texts agree; shorter ones than a span are no windows."""

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            one, other = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) for i in (4, 5))
            same = one == other
            before, after = (np.cumprod(x, axis=1).sum(axis=1) for x in (same[:, :SIDE], same[:, SIDE:]))
            n, first = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            short = batch.column(6).to_numpy(zero_copy_only=False)
            before[short], after[short] = 0, 0
            keep = short | (before + n + after >= SPAN)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(first - before), pa.array(first + n + after)],
                names=["_row", "passage", "start", "end"],
            ).filter(pa.array(keep))

    picked = hits.select("_row", "passage", "n", "first", "around", "item_around", "short")
    return picked.mapInArrow(run, "_row long, passage long, start long, end long")


def contamination(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with the benchmark's words marked: `(documents, spans, items)`.

    documents: _row, doc_id, text_hash, n_words, n_hit (words inside a shared window), n_items, item_ids,
    contaminated (a twentieth of its words or more are hit). spans: _row, start, end of hits, in words;
    they may overlap. items: _row and item_id of each item found. A window is `SPAN` words of an item, or all
    of a shorter one. NULL or empty texts have no words and no windows; repeated rows are rows of
    their own; an item with a NULL id marks words but is not named. Only doc_id, text and item_id, text are read.
    """
    # A passage: one fingerprint with its surroundings, however many items hold it. Short items have none.
    runs = _item_runs(items).withColumn("short", F.forall("around", lambda w: w == 0))
    runs = materialise(runs.withColumn("passage", F.xxhash64("key", "n", "around")), "item_runs")
    shorts = sorted(r.n for r in runs.filter("short").select("n").distinct().collect())
    found = materialise(_scan(docs, bit_table(runs, "key"), shorts), "scan")

    passages = runs.select("key", "n", "passage", "short", F.col("around").alias("item_around")).dropDuplicates(["key", "passage"])
    if passages.limit(MAX_BROADCAST_FINGERPRINTS + 1).count() <= MAX_BROADCAST_FINGERPRINTS:
        passages = F.broadcast(passages)
    at = found.filter(F.size("key") > 0).select(
        "_row", F.posexplode("key").alias("i", "key"), F.col("n").alias("ns"), F.col("first").alias("firsts"), F.col("around").alias("arounds")
    )
    at = at.select(
        "_row", "key", F.get("ns", F.col("i")).alias("n"), F.get("firsts", F.col("i")).alias("first"),
        F.slice("arounds", F.col("i") * (2 * SIDE) + 1, 2 * SIDE).alias("around"),
    )
    hits = materialise(_extended(at.join(passages, ["key", "n"])), "hits")

    spans = hits.select("_row", "start", "end").distinct()
    earlier = F.coalesce(F.max("end").over(Window.partitionBy("_row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", earlier))
    n_hit = spans.select("_row", fresh.alias("fresh")).groupBy("_row").agg(F.sum("fresh").alias("n_hit"))

    named = runs.filter("item_id IS NOT NULL").select("passage", "item_id").distinct()
    held = hits.select("_row", "passage").distinct().join(named, "passage").select("_row", "item_id").distinct()
    ids = held.groupBy("_row").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids"))

    zero = F.lit(0).cast("long")
    documents = (
        found.select("_row", "doc_id", "text_hash", "n_words")
        .join(n_hit, "_row", "left")
        .join(ids, "_row", "left")
        .select(
            "_row", "doc_id", "text_hash", "n_words",
            F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce(F.size("item_ids").cast("long"), zero).alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )
    hit = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return documents.withColumn("contaminated", hit), spans, held


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without contaminated rows, all columns kept; see `contamination`. Rows equal in doc_id and text go together."""
    listed = contamination(docs, items)[0].filter("contaminated").select("doc_id", "text_hash")
    return drop_listed(docs, materialise(listed, "contaminated"), {"doc_id": F.col("doc_id"), "text_hash": F.xxhash64("text")})
