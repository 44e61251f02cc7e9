"""Near-duplicate documents by MinHash with tensored banding.

A document is its set of word shingles. Two collections of short minhash bands are made, and a
table key is a pair of one band from each: `bands` squared tables cost the minhashes of only twice
`bands` bands. Documents that share a key are candidates, and a link is confirmed on full sets.

Work that would grow with the square of a group's size is avoided as far as it can be without losing a link:
1. documents with equal sets become one node;
2. in each bucket a node is paired with its predecessor and with the first node, and each node's
   best such pairs are confirmed; this joins most groups by a number of pairs linear in their size;
3. only buckets that still hold several components are paired out, between components: nodes that share a
   rare shingle, and nodes of small buckets whose common shingles alone would be enough for a link;
4. before that, the nodes of large buckets that meet around a common centre are dealt into small shares by chance, a few times over,
   and paired within them: where links are many, they soon are one component, whose other pairs need not be looked at;
5. the nodes that are still apart are told by what they add to and leave out of the centre. Two sets at d and e shingles from it, with the sizes m and n, are linked if and only if at least (d + e - (100 - p) / (100 + p) * (m + n)) / 2 of
   these differences are the same; where that asks for none, both are linked to the centre. Differences of one
   node alone are left out and the others taken rarest first, so only as many are joined as must hold one in common.
   Where many edits of a group meet in the same places and few of its pairs are links, a share of its pairs still comes up.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom import bit_table, may_hold
from .components import components
from .tables import arrow_schema, drop_listed, materialise, numbered
from .words import NOT_SPACE, Texts, mix, slices, windows, words_of

SHINGLE = 5
BANDS, BAND_ROWS = 10, 3
LEAST_CHANCE = 1e-8  # that a link has fewer agreeing minhashes than are asked for
RARE_NODES = 32
SMALL_BUCKET = 32
PER_PART = 1000  # members of a centre that meet one copy of its set
SHARE, DEALS = 16, 4  # members of a centre that are paired with each other in a deal, and the most deals
FEW_MERGES = 20  # a deal that leaves no more than one component less for so many members is the last
CLASSES = 16  # of distances from a centre, in each doubling

_rng = np.random.Generator(np.random.PCG64(3))
_FACTORS = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TAGS = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64)


def shingle_sets(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's distinct shingles in ascending order, and the bounds of the rows.

    A row of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words = words_of(texts, NOT_SPACE)
    hashes, bounds = windows(words, size)
    counts = np.diff(bounds)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    row = np.repeat(np.arange(len(texts)), counts)
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            held = words.counts[short] > k
            whole[held] = mix(whole[held] + words.hash[words.bounds[short[held]] + k] + np.uint64(k + 1))
        hashes, row = np.concatenate([hashes, mix(whole)]), np.concatenate([row, short])
    order = np.argsort(hashes)
    hashes, row = hashes[order], row[order]
    order = np.argsort(row.astype(np.uint16) if len(texts) < 1 << 16 else row, kind="stable")
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(texts) + 1))


def _per_row(function, values: np.ndarray, bounds: np.ndarray, held: np.ndarray) -> np.ndarray:
    """A reduction of each row's values, for the rows that have any."""
    return function.reduceat(values, bounds[:-1][held]) if held.any() else values[:0]


def _fingerprints(hashes, bounds, held):
    """128 bits of a set, in two halves."""
    return [_per_row(np.add, mix(hashes ^ tag), bounds, held) for tag in _TAGS[:2]]


def _minhashes(hashes, bounds, held, n: int) -> np.ndarray:
    out = np.empty((int(held.sum()), n), np.uint32)
    for k in range(n):
        out[:, k] = _per_row(np.minimum, (hashes * _FACTORS[k]) >> np.uint64(32), bounds, held)
    return out


def half_keys(minhashes: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    """Hashes of the bands of both collections, `(documents, 2, bands)`."""
    grouped = minhashes.reshape(len(minhashes), 2, bands, band_rows).astype(np.uint64)
    half = np.zeros(grouped.shape[:3], np.uint64)
    for k in range(band_rows):
        half = mix(half + grouped[..., k] + np.uint64(k + 1))
    return half


def table_keys(minhashes: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    """Keys of all tables, a row per document: every band of one collection with every band of the other."""
    half = half_keys(minhashes, bands, band_rows)
    paired = half[:, 0, :, None] * np.uint64(0x9E3779B97F4A7C15) + half[:, 1, None, :]
    return mix(paired.reshape(len(minhashes), -1) + _TAGS[: bands * bands])


def _fill(values: np.ndarray, held: np.ndarray) -> pa.Array:
    out = np.zeros(len(held), np.int64)
    out[held] = values.view(np.int64)
    return pa.array(out)


def text_hash(text="text"):
    return F.xxhash64(text)


def _signatures(docs: DataFrame, bands: int, band_rows: int, size: int) -> DataFrame:
    n = 2 * bands * band_rows
    ddl = "_row long, doc_id long, text_hash long, n_shingles long, hi long, lo long, minhashes binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch, texts in slices(batches, "text"):
            hashes, bounds = shingle_sets(texts, size)
            counts = np.diff(bounds)
            held = counts > 0
            hi, lo = _fingerprints(hashes, bounds, held)
            packed = np.zeros((len(held), n), np.uint32)
            packed[held] = _minhashes(hashes, bounds, held, n)
            blobs = pa.Array.from_buffers(
                pa.binary(), len(held),
                [None, pa.py_buffer((np.arange(len(held) + 1) * 4 * n).astype(np.int32)), pa.py_buffer(packed)],
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()), _fill(hi, held), _fill(lo, held), blobs],
                schema=schema,
            )

    return numbered(docs).select("_row", "doc_id", text_hash().alias("text_hash"), "text").mapInArrow(run, ddl)


def _keys(nodes: DataFrame, bands: int, band_rows: int) -> DataFrame:
    ddl = "node long, n_shingles long, keys array<long>"

    def run(batches):
        for batch in batches:
            blobs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32)
            keys = table_keys(blobs.reshape(batch.num_rows, -1), bands, band_rows).view(np.int64)
            bounds = np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["node", "n_shingles", "keys"])

    made = nodes.select("node", "n_shingles", "minhashes").mapInArrow(run, ddl)
    return made.select(F.explode("keys").alias("key"), "node", "n_shingles")


def _buckets(keys: DataFrame) -> DataFrame:
    """Rows that share a key with another one, with the predecessor and the first of their run.

    Keys are dealt by range together with the node, so one hot key spreads over several tasks. A run at the
    edge of a partition may go on in the next one: its rows stay, even a single one.
    """
    ddl = "key long, node long, n_shingles long, before long, first long"

    def emit(key, node, n, before, first, keep):
        return pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in (key, node, n, before, first)], names=["key", "node", "n_shingles", "before", "first"]
        )

    def run(batches):
        rest, opening = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            part = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is None:
                start_before, start_first = np.array([-1]), part[1][:1]
            else:
                part = [np.concatenate([a, b]) for a, b in zip(rest[:3], part)]
                start_before, start_first = rest[3], rest[4]
            key, node, n = part
            same = np.zeros(len(key), bool)
            same[1:] = key[1:] == key[:-1]
            begins = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
            first = np.where(begins == 0, start_first[0], node[begins])
            before = np.where(same, np.concatenate([[-1], node[:-1]]), -1)
            before[0] = start_before[0]
            linked = (before >= 0) | np.append(same[1:], False)
            if opening:
                linked |= begins == 0
                opening = bool(same[1:].all())
            yield emit(key[:-1], node[:-1], n[:-1], before[:-1], first[:-1], linked[:-1])
            rest = [key[-1:], node[-1:], n[-1:], before[-1:], first[-1:]]
        if rest is not None:
            yield emit(*rest, np.array([True]))

    dealt = keys.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(run, ddl)


def _sizes_allow(a: str, b: str, percent: int):
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def least_agreeing(percent: int, n: int) -> float:
    """The share of `n` minhashes that a link has but for a chance of 10^-8: at the threshold the agreeing ones are binomial."""
    p, below, k = percent / 100, 0.0, 0
    while k < n:
        below += comb(n, k) * p**k * (1 - p) ** (n - k)
        if below > LEAST_CHANCE:
            break
        k += 1
    return k / n


def _agreeing(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs `(a, b)` of which at least the share `least` of minhashes agrees, with that number."""
    minhashes = nodes.select("node", "minhashes")
    both = pairs.join(minhashes.toDF("a", "of_a"), "a").join(minhashes.toDF("b", "of_b"), "b").select("a", "b", "of_a", "of_b")

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32) for i in (2, 3))
            if not len(a):
                continue
            same = (a == b).reshape(batch.num_rows, -1)
            count = same.sum(axis=1)
            keep = pa.array(count >= least * same.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count)], names=["a", "b", "agreeing"]
            ).filter(keep)

    return both.mapInArrow(run, "a long, b long, agreeing long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have a Jaccard similarity of `percent` or more, as edges `(u, v)`."""
    both = (
        pairs.select("a", "b").join(sets.toDF("a", "of_a"), "a").join(sets.toDF("b", "of_b"), "b").select("a", "b", "of_a", "of_b")
    )

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                common = int((b[at] == a).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """`(node, hashes)` of the wanted nodes, from a second scan of the texts: no set of another document is kept."""
    wanted = materialise(nodes.select("node", "hi", "lo", "doc_id", F.xxhash64("doc_id").bitwiseXOR(F.col("lo")).alias("h")), "wanted")
    table = bit_table(wanted, "h")
    shared = docs.sparkSession.sparkContext.broadcast(table)
    ddl = "hi long, lo long, set binary"

    def run(batches):
        seen = set()
        for batch, texts in slices(batches, "text"):
            hashes, bounds = shingle_sets(texts, size)
            held = np.diff(bounds) > 0
            hi, lo = _fingerprints(hashes, bounds, held)
            salt = batch.column(0).to_numpy(zero_copy_only=False)[held].view(np.uint64)
            rows = np.flatnonzero(held)
            out = ([], [], [])
            for i in np.flatnonzero(may_hold(shared.value, salt ^ lo)):
                name = (int(hi[i]), int(lo[i]))
                if name in seen:
                    continue
                seen.add(name)
                out[0].append(int(hi[i].view(np.int64)))
                out[1].append(int(lo[i].view(np.int64)))
                out[2].append(hashes[bounds[rows[i]] : bounds[rows[i] + 1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["hi", "lo", "set"]
            )

    found = docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(run, ddl)
    return found.join(wanted.select("hi", "lo", "node"), ["hi", "lo"]).dropDuplicates(["node"]).select("node", F.col("set"))


def _mixed(rows: DataFrame, key: str = "key") -> DataFrame:
    """Rows of the buckets, or of what else `key` names, that hold more than one component."""
    mixed = rows.groupBy(key).agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return rows.join(mixed.select(key), key, "left_semi")


def _shared_shingles(open_rows: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(cores, pairs)` of the nodes of open buckets.

    A shingle of at most `RARE_NODES` of these nodes is rare. pairs: nodes that share a rare shingle, few for each
    occurrence of one. cores `(node, core)`: how many of a node's shingles more nodes have; two nodes that
    share no rare one have no more in common than the smaller core. Nodes that can still be
    linked share a bucket, so all of them are here.
    """

    def run(batches):
        for batch in batches:
            blobs = [b.as_buffer() for b in batch.column(1)]
            bounds = np.concatenate([[0], np.cumsum([len(b) // 8 for b in blobs])]).astype(np.int32)
            values = np.frombuffer(b"".join(blobs), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))], names=["node", "hashes"]
            )

    nodes = open_rows.select("node", "n_shingles", "component").distinct()
    lists = sets.join(nodes.select("node"), "node", "left_semi").select("node", "set").mapInArrow(run, "node long, hashes array<long>")
    each = materialise(lists.select(F.explode("hashes").alias("hash"), "node"), "shingles")
    counts = each.groupBy("hash").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    alone = counts.filter("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
    rare = counts.filter(F.col("n").between(2, RARE_NODES)).select("hash")
    rare = materialise(each.join(rare, "hash").join(nodes, "node"), "rare_shingles")
    few = rare.groupBy("node").agg(F.count("*").alias("few"))
    gone = F.coalesce("alone", F.lit(0)) + F.coalesce("few", F.lit(0))
    cores = nodes.join(alone, "node", "left").join(few, "node", "left").select("node", (F.col("n_shingles") - gone).alias("core"))
    return cores, rare


def _with_bands(rows: DataFrame, nodes: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """Bucket rows with their node's band hashes, and which bands of either collection the bucket's table is made of."""
    columns = ["key", "node", "n_shingles", "component", "core"]
    ddl = ", ".join(f"{c} long" for c in columns) + ", one int, two int, ones array<long>, twos array<long>"

    def run(batches):
        for batch in batches:
            blobs = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            table = np.argmax(table_keys(blobs, bands, band_rows) == key[:, None], axis=1).astype(np.int32)
            half = half_keys(blobs, bands, band_rows).view(np.int64)
            cuts = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands)
            lists = [pa.ListArray.from_arrays(cuts, pa.array(half[:, k].ravel())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(table // bands), pa.array(table % bands), *lists], names=[*columns, "one", "two", "ones", "twos"]
            )

    return rows.join(nodes.select("node", "minhashes"), "node").select(*columns, "minhashes").mapInArrow(run, ddl)


def _first_table(bands: int):
    """Whether a pair's table is the first they share: then a pair comes up once, not once per table."""

    def first(one, other):
        found = F.lit(bands)
        for k in reversed(range(bands)):
            found = F.when(F.get(one, F.lit(k)) == F.get(other, F.lit(k)), F.lit(k)).otherwise(found)
        return found

    return (first("ones", "ones_2") == F.col("one")) & (first("twos", "twos_2") == F.col("two"))


def _across(rows: DataFrame, key: str, percent: int, more=None) -> DataFrame:
    """Pairs `(a, b)` of nodes of different components that share a key and may be similar enough."""
    columns = [c for c in ("node", "n_shingles", "component", "core", "ones", "twos") if c in rows.columns]
    other = rows.select(key, *(F.col(c).alias(f"{c}_2") for c in columns))
    fits = (F.col("component") < F.col("component_2")) & _sizes_allow("n_shingles", "n_shingles_2", percent)
    if more is not None:
        fits = fits & more
    return rows.join(other, key).filter(fits).select(F.col("node").alias("a"), F.col("node_2").alias("b"))


def _linkable(rows: DataFrame, percent: int) -> DataFrame:
    """Rows whose core could be enough for the smallest set in their bucket: the others are linked with none of it."""
    least = rows.groupBy("key").agg(F.min("n_shingles").alias("least"))
    enough = (100 + percent) * F.col("core") >= percent * (F.col("n_shingles") + F.col("least"))
    return rows.join(least, "key").filter(enough).drop("least")


def _centres(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bucket rows of small buckets, and `(centre, part, node, n_shingles, component)` of the others.

    A centre is the smallest node of a bucket, or of one that shares a node with it: then few centres serve a group.
    """
    sizes = materialise(rows.groupBy("key").agg(F.count("*").alias("rows"), F.min("node").alias("centre")), "bucket_sizes")
    large = sizes.filter(F.col("rows") > SMALL_BUCKET)
    small = rows.join(large.select("key"), "key", "left_anti")
    held = materialise(rows.select("key", "node", "n_shingles", "component").join(large.select("key", "centre"), "key"), "large_buckets")
    for _ in range(2):
        nearest = held.groupBy("node").agg(F.min("centre").alias("nearest"))
        moved = held.select("key", "node").join(nearest, "node").groupBy("key").agg(F.min("nearest").alias("centre"))
        held = materialise(held.drop("centre").join(moved, "key"), "large_buckets")
    members = materialise(held.filter("node <> centre").select("centre", "node", "n_shingles", "component").distinct(), "members")
    parts = members.groupBy("centre").agg(F.floor(F.count("*") / PER_PART + 1).alias("parts"))
    dealt = members.join(parts, "centre").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    return small, dealt.select("centre", "part", "node", "n_shingles", "component")


def _renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with the new names of their components, from `names (was, now)`."""
    now = F.coalesce("now", "component").alias("component")
    return rows.join(names, F.col("component") == F.col("was"), "left").select(*(now if c == "component" else c for c in rows.columns))


def _dealt(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, least: float) -> tuple[DataFrame, DataFrame]:
    """`(links, names)`: confirmed links `(u, v)` of members that chance has brought together, and components by what they are part of now.

    Pairs are a few for each member and deal, whatever the size of its group.
    """
    links = members.sparkSession.createDataFrame([], "u long, v long")
    shares = members.groupBy("centre").agg(F.ceil(F.count("*") / SHARE).alias("shares"))
    held = materialise(members.drop("part").join(shares, "centre").withColumn("first", F.col("component")), "dealt")
    total = held.count()
    for deal in range(DEALS):
        share = F.xxhash64("centre", F.pmod(F.xxhash64("node", F.lit(deal)), F.col("shares")))
        pairs = _across(held.withColumn("share", share), "share", percent).distinct()
        found = materialise(_confirmed(_agreeing(pairs, nodes, least), sets, percent), "links")
        labels = held.select("node", "component").distinct()
        joined = found.join(labels.toDF("u", "x"), "u").join(labels.toDF("v", "y"), "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
        merged = components(joined).toDF("was", "now").filter("was > now")
        merges = merged.count()
        if not merges:
            break
        links = links.unionByName(found)
        held = materialise(_renamed(held, merged), "dealt")
        if merges * FEW_MERGES <= total:
            break
    return links, materialise(held.filter("first > component").select(F.col("first").alias("was"), F.col("component").alias("now")).distinct(), "names")


def _differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members with the size of their centre's set, whether they are linked to it, the number of shingles only one of
    both has, and those: added ones by their hash, left out ones by their hash under a mask."""
    centres = members.select("centre", "part").distinct().join(sets.toDF("centre", "of_centre"), "centre")
    both = members.join(centres, ["centre", "part"]).join(sets.toDF("node", "of_node"), "node")
    columns = ["centre", "part", "node", "n_shingles", "component"]
    ddl = ", ".join(f"{c} long" for c in columns) + ", n_centre long, linked boolean, apart long, differences array<long>"
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            found, sizes = [], []
            for a, c in zip(batch.column(5), batch.column(6)):
                a, c = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), np.uint64)
                added, left = np.setdiff1d(a, c, assume_unique=True), np.setdiff1d(c, a, assume_unique=True)
                found.append(np.concatenate([added, left ^ _TAGS[2]]).view(np.int64))
                sizes.append((len(a), len(c)))
            if not found:
                continue
            n, n_centre = np.array(sizes, np.int64).T
            apart = np.array([len(x) for x in found], np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(apart)]).astype(np.int32)), pa.array(np.concatenate(found))
            )
            linked = pa.array((100 + percent) * apart <= (100 - percent) * (n + n_centre))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(n_centre), linked, pa.array(apart), lists], schema=schema
            )

    return both.select(*columns, "of_node", "of_centre").mapInArrow(run, ddl)


def _around_centres(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """`(links, pairs)` of members: links `(u, v)` to their centre, and pairs `(a, b)` of different components with one centre
    that have enough differences in common to be linked, as far as one each of the rarest can tell."""
    gain, loss = 100 + percent, 100 - percent
    found = materialise(_differences(members, sets, percent), "differences")
    links = found.filter("linked").select(F.col("node").alias("u"), F.col("centre").alias("v"))

    # A difference of one component only is none that a pair to be found has in common.
    each = found.select("centre", "node", "component", F.explode("differences").alias("difference"))
    counts = each.groupBy("centre", "difference").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    counts = counts.filter("x < y").drop("x", "y")
    shared = each.join(counts, ["centre", "difference"]).groupBy("centre", "node").agg(
        F.sort_array(F.collect_list(F.struct("n", "difference"))).getField("difference").alias("shared")
    )
    # far: how far beyond the centre's reach, in classes whose least value stands for all their members.
    rows = found.drop("differences").join(shared, ["centre", "node"]).withColumn("far", gain * F.col("apart") - loss * F.col("n_shingles"))
    unit = loss * F.col("n_centre")
    rows = rows.withColumn("own", F.floor(CLASSES * F.log2(1 + (F.col("far") + unit) / unit)))
    rows = materialise(rows, "shared_differences")
    classes = rows.groupBy("centre").agg(F.collect_set("own").alias("classes"))
    classes = rows.select("centre", "part").distinct().join(classes, "centre")
    least = F.floor(unit * (F.pow(2.0, F.col("want") / CLASSES) - 1)) - 1 - unit
    wanted = rows.join(classes, ["centre", "part"]).withColumn("want", F.explode("classes"))
    wanted = wanted.withColumn("common", F.greatest(F.lit(1), F.ceil((F.col("far") + least) / (2 * gain))))
    wanted = wanted.filter(F.size("shared") >= F.col("common"))
    rarest = F.slice("shared", F.lit(1), (F.size("shared") - F.col("common") + 1).cast("int"))
    of_node = ["node", "n_shingles", "component", "far", "rest"]
    one = wanted.withColumn("size", F.size("shared")).select("*", F.posexplode(rarest).alias("before", "difference"))
    one = one.withColumn("rest", F.col("size") - F.col("before")).select("centre", "own", "want", "difference", "before", *of_node)
    one = materialise(one, "rarest_differences")
    two = one.select(
        "centre", F.col("want").alias("own"), F.col("own").alias("want"), "difference",
        *(F.col(c).alias(f"{c}_2") for c in ("before", *of_node)),
    )
    # As both lists have one order, the differences in common lie before this one in both, or from it on in both.
    most = F.least("before", "before_2") + F.least("rest", "rest_2")
    fits = (F.col("component") < F.col("component_2")) & _sizes_allow("n_shingles", "n_shingles_2", percent)
    fits = fits & (2 * gain * most >= F.col("far") + F.col("far_2"))
    pairs = one.join(two, ["centre", "own", "want", "difference"]).filter(fits)
    return links, pairs.select(F.col("node").alias("a"), F.col("node_2").alias("b"))


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    size: int = SHINGLE,
) -> DataFrame:
    """A row per document: `_row`, doc_id, text_hash, n_shingles, component_id, kept.

    Documents are linked if their shingle sets have a Jaccard similarity of `percent` hundredths or
    more; component_id is the smallest doc_id of those reachable. One row of each component is kept: the one with
    that doc_id and, among repeated rows, the first. A NULL or empty text is linked with nothing
    and kept. A NULL doc_id counts as larger than any other; a component of such
    rows only has a NULL component_id. Only `doc_id` and `text` are read.

    Two documents at the threshold become candidates with probability 0.9998 (0.9985 for a `percent` of 80), more similar
    ones more surely; every candidate is decided, whatever the size of its group.
    """
    docs = docs.select("doc_id", "text")
    rows = materialise(_signatures(docs, bands, band_rows, size), "signatures")
    classes = rows.filter("n_shingles > 0").groupBy("hi", "lo").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "_row")).alias("top")
    )
    classes = materialise(classes.select("hi", "lo", F.col("top._row").alias("node"), F.col("top.doc_id").alias("doc_id")), "classes")
    nodes = materialise(
        classes.join(rows.select(F.col("_row").alias("node"), "n_shingles", "minhashes"), "node"), "nodes"
    )
    buckets = materialise(_buckets(_keys(nodes, bands, band_rows)), "buckets")

    # Per node, of those it follows in some table, the smallest one and the one it follows most often.
    met = (
        buckets.filter("before >= 0").select(F.explode(F.array("before", "first")).alias("a"), F.col("node").alias("b"))
        .filter("a <> b").groupBy("a", "b").agg(F.count("*").alias("times"))
    )
    best = met.groupBy("b").agg(F.array(F.max_by("a", F.struct("times", -F.col("a"))), F.min("a")).alias("a"))
    best = materialise(best.select(F.explode(F.array_distinct("a")).alias("a"), "b"), "pairs")

    paired = buckets.filter("before >= 0").select(F.explode(F.array("node", "before", "first")).alias("node")).distinct()
    sets = materialise(_sets(docs, nodes.join(paired, "node", "left_semi"), size), "sets")
    first = components(_confirmed(best, sets, percent))
    first = materialise(first, "components")

    # What is still apart within a bucket: the links between components, if any.
    labelled = buckets.select("key", "node", "n_shingles").join(first, "node", "left").select(
        "key", "node", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    open_rows = materialise(_mixed(labelled), "open")
    least = least_agreeing(percent, 2 * bands * band_rows)
    if open_rows.limit(1).count():
        # Runs that a partition's edge has cut were not paired so far.
        more = open_rows.select("node").distinct().join(sets.select("node"), "node", "left_anti")
        more = nodes.join(more, "node", "left_semi")
        if more.limit(1).count():
            sets = materialise(sets.unionByName(_sets(docs, more, size)), "sets")
        cores, rare = _shared_shingles(open_rows, sets)
        open_rows = materialise(_mixed(_linkable(open_rows.join(cores, "node"), percent)), "open")
        overlap = (100 + percent) * F.least("core", "core_2") >= percent * (F.col("n_shingles") + F.col("n_shingles_2"))
        small, members = _centres(open_rows)
        drawn, names = _dealt(members, nodes, sets, percent, least)
        members, small, rare = _renamed(members, names), _mixed(_renamed(small, names)), _mixed(_renamed(rare, names), "hash")
        to_centres, around = _around_centres(members, sets, percent)
        small = materialise(_with_bands(small, nodes, bands, band_rows), "open")
        across = _across(small, "key", percent, overlap & _first_table(bands))
        across = across.unionByName(around).unionByName(_across(rare, "hash", percent)).distinct()
        first_links = first.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(to_centres).unionByName(drawn)
    else:
        across = open_rows.select(F.col("node").alias("a"), F.col("node").alias("b"))
        first_links = first.select(F.col("node").alias("u"), F.col("component").alias("v"))
    left = materialise(_agreeing(across, nodes, least).select("a", "b"), "pairs")
    final = components(_confirmed(left, sets, percent).unionByName(first_links))

    labels = classes.join(final, "node", "left").select("hi", "lo", "node", "doc_id", F.coalesce("component", "node").alias("component"))
    top = labels.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", F.col("node").alias("_row"))).alias("top")
    )
    labels = labels.select("hi", "lo", "component").join(top, "component").select("hi", "lo", "top")
    empty = F.col("n_shingles") == 0
    return (
        rows.select("_row", "doc_id", "text_hash", "n_shingles", "hi", "lo")
        .join(labels, ["hi", "lo"], "left")
        .select(
            "_row", "doc_id", "text_hash", "n_shingles",
            F.when(empty, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("component_id"),
            (empty | (F.col("_row") == F.col("top._row"))).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one row of each group of near duplicates, all columns kept; see `near_duplicates`.

    Rows are told apart by doc_id and text. Of rows equal in both, one is kept if the group keeps one of them.
    """
    found = near_duplicates(docs, **options)
    listed = materialise(
        found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"), F.sum(F.col("kept").cast("long")).alias("kept"))
        .filter("kept < rows"),
        "repeats",
    )
    same = {"doc_id": F.col("doc_id"), "text_hash": text_hash()}
    single = drop_listed(docs, listed, same)
    again = listed.filter("kept > 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("kept").alias("_kept"))
    if not again.limit(1).count():
        return single
    # Rows with one id and one text, of which some are to stay.
    packed = docs.select(F.struct(*docs.columns).alias("_document"), "doc_id", text_hash().alias("_text_hash"))
    packed = packed.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")))
    nth = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.xxhash64("_document")))
    kept = packed.withColumn("_nth", nth).filter("_nth <= _kept").select("_document.*")
    return single.unionByName(kept)
