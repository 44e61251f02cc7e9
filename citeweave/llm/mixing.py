"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent, normalised. The exponent is
bisected: from 1 (as the corpus is) towards 0 (all sources alike) until the weights reach a target entropy, unless a
limit on repetition is met before. Each source then gets its quota of the budget: whole passes over its documents, and a
part of one more, cut from a permutation of its blocks and of the rows in them.

Whether a row lies before the cut follows from its own hash and one line per source, so texts are never
shuffled, and one source may hold any share of the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise
from .words import NOT_SPACE, slices, word_ranges

BLOCK_ROWS = 2_000
SEED = 11
GRID, PASSES = 32, 5  # the interval of exponents shrinks by GRID in each pass over the source totals
MAX_BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Temperature:
    """The exponent found, its normaliser, and the tokens of the corpus and of the mix."""

    exponent: float
    norm: float
    tokens: int
    budget: float


def count_tokens(docs: DataFrame, *keep: Column) -> DataFrame:
    """`keep`, the source and n_tokens (words) of every row; a NULL text has none."""
    docs = docs.select(*keep, "source", "text")
    names = docs.columns[:-1]
    schema = docs.drop("text").schema.add("n_tokens", "long")

    def run(batches):
        for batch, texts in slices(batches, "text"):
            _, _, bounds = word_ranges(texts, NOT_SPACE)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(bounds[1:] - bounds[:-1], pa.int64())], names=[*names, "n_tokens"]
            )

    return docs.mapInArrow(run, schema)


def _place(seed: int) -> Column:
    """A row's place in the permutation; the same wherever it is worked out."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def _block(place: Column, blocks: Column) -> Column:
    return F.pmod(place, blocks)


def _block_key(seed: int, source: Column, block: Column) -> Column:
    """Blocks of a source are ordered by this key."""
    return F.xxhash64(F.lit(seed + 1), source, block)


def find_temperature(
    sources: DataFrame, entropy_share: float = 1.0, max_repeats: float = math.inf, budget: float | None = None
) -> Temperature:
    """The smallest flattening that reaches `entropy_share` of the largest entropy, within the repetition limit.

    `sources (tokens)` is stored. A grid of exponents is summed in one pass over it, so no list of
    sources comes to the driver. Without a budget the mix is as large as using every document once takes.
    """
    shares = sources.filter("tokens > 0")
    total, n, least, most = shares.agg(F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")).first()
    if not n:
        return Temperature(1.0, 1.0, 0, 0.0)
    share = F.col("tokens") / F.lit(float(total))

    def size(exponent, norm):
        return budget if budget is not None else total * (most / total) ** (1 - exponent) * norm

    def sums(exponents):
        row = shares.agg(
            *(F.sum(F.pow(share, F.lit(a))) for a in exponents), *(F.sum(F.pow(share, F.lit(a)) * F.log(share)) for a in exponents)
        ).first()
        return list(zip(exponents, row[: len(exponents)], row[len(exponents) :]))

    def flat_enough(exponent, norm, logs):
        """Whether no more flattening is wanted, or none allowed beyond here."""
        entropy = math.log(norm) - exponent * logs / norm
        repeats = size(exponent, norm) * (least / total) ** exponent / norm / least
        return entropy >= entropy_share * math.log(n) - 1e-12 or repeats > max_repeats

    # Flattening grows as the exponent falls: the largest exponent that is flat enough, or just within the limit.
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
        flat = [a for a, norm, logs in sums(grid) if flat_enough(a, norm, logs)]
        if not flat:
            high = low
            break
        low = max(flat)
        high = min((a for a in grid if a > low), default=low)
    exponent = round(high, 6)
    norm = sums([exponent])[0][1]
    return Temperature(exponent, norm, total, size(exponent, norm))


def mixture(
    docs: DataFrame,
    entropy_share: float = 0.95,
    max_repeats: float = 2.0,
    budget: float | None = None,
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame, Temperature]:
    """`(docs with copies, sources, temperature)`: how often each row is used, as a column `copies` of `docs`.

    sources: source, tokens, docs, weight, quota, passes, blocks, and the cut (cut_key, cut_place). A source's rows are used
    `passes` times, those before the cut once more; its tokens stay within its quota, by less than the next row. A NULL source is a
    source of its own. Rows with equal doc_id and text are used alike. Rows without words cost nothing
    and take part like others; a source of such rows only is passed once. A column named copies is replaced.
    """
    place = _place(seed)
    counted = materialise(count_tokens(docs, place.alias("place")), "counted")
    sources = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    sources = materialise(sources, "sources")
    found = find_temperature(sources, entropy_share, max_repeats, budget)
    share = F.col("tokens") / F.lit(float(max(found.tokens, 1)))
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(found.exponent)) / F.lit(found.norm)).otherwise(F.lit(0.0))
    # A millionth of a token against rounding, so that a quota of whole passes stays whole.
    quota = F.floor(F.col("weight") * F.lit(float(found.budget)) + F.lit(1e-6) * F.col("tokens")).cast("long")
    sources = sources.withColumn("weight", weight).withColumn("quota", quota)
    sources = sources.withColumns(
        {
            "passes": F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.greatest("tokens", F.lit(1)))).otherwise(F.lit(1)).cast("int"),
            "blocks": F.ceil(F.col("docs") / block_rows).cast("long"),
        }
    )
    sources = sources.withColumn("rest", F.greatest(F.col("quota") - F.col("passes") * F.col("tokens"), F.lit(0)))
    sources = materialise(sources, "quotas")

    lines = sources.select(F.col("source").alias("_source"), "rest", F.col("blocks").alias("_blocks"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    # Block totals first: what follows has a row per block, and then the rows of one block per source.
    blocks = counted.join(_small(lines, sources), same).withColumn("block", _block(F.col("place"), F.col("_blocks")))
    totals = blocks.groupBy("source", "rest", "block").agg(F.sum("n_tokens").alias("tokens"))
    totals = totals.withColumn("key", _block_key(seed, F.col("source"), F.col("block")))
    before = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    cut = materialise(
        totals.filter((F.col("rest") > 0) & (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("tokens") > F.col("rest")))
        .select(F.col("source").alias("_source"), F.col("block").alias("_block"), (F.col("rest") - F.col("before")).alias("left"), F.col("key").alias("cut_key")),
        "cuts",
    )
    rows = blocks.select("source", "block", "place", "n_tokens").join(_small(cut, sources), same & (F.col("block") == F.col("_block")))
    rows = rows.groupBy("_source", "left", "cut_key", "place").agg(F.sum("n_tokens").alias("tokens"))
    upto = Window.partitionBy("_source").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (
        rows.withColumn("upto", F.sum("tokens").over(upto)).groupBy("_source", "cut_key")
        .agg(F.max(F.when(F.col("upto") <= F.col("left"), F.col("place"))).alias("cut_place"))
    )
    sources = materialise(sources.join(edge, same, "left").drop("_source"), "sources")

    lines = sources.select(F.col("source").alias("_source"), "passes", F.col("blocks").alias("_blocks"), "cut_key", "cut_place")
    key = _block_key(seed, F.col("source"), _block(place, F.col("_blocks")))
    once_more = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & (place <= F.col("cut_place")))
    copies = (F.col("passes") + F.coalesce(once_more, F.lit(False)).cast("int")).alias("copies")
    columns = [c for c in docs.columns if c != "copies"]
    # Only the four columns below are named in the join, the rest travels as one struct and so cannot clash.
    packed = docs.select("doc_id", "text", "source", F.struct(*columns).alias("_document"))
    used = packed.join(_small(lines, sources), same).select("_document.*", copies)
    return used, sources, found


def _small(lines: DataFrame, sources: DataFrame) -> DataFrame:
    """A line per source, broadcast only if there are few sources."""
    few = sources.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES
    return F.broadcast(lines) if few else lines


def realised(mixed: DataFrame) -> DataFrame:
    """Rows as often as they are used; a row of no copies is left out."""
    return mixed.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies")
