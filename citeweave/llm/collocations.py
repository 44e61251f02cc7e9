"""Phrases whose words stand together more often than their parts would by chance, from a weighted de Bruijn graph.

Nodes are runs of words one shorter than the longest phrase asked for, and an edge is a run of that longest length: it joins the node of
its first words to that of its last. Tasks count the edges of their texts and put unary paths, chains of edges with one way in and one way
on and the same weight, together to one row each. After the edges are summed, the count of every shorter run is the flow through
it: what its edges carry on to the right, plus the places where a piece ends behind it.

Runs that cannot reach the least count need no edges. A first pass over the texts counts words exactly, and runs of two and three
words in a table of fixed size, whose counters can only be too high; a run with a word that falls short does so too. Where a run falls short there, the path ends as at the end of
a piece: the flow of every run that does reach the least count stays exact. The larger the input, the fewer runs the table
rules out; results do not depend on it.

Words are known by 64-bit hashes within the graph and by their text in the dictionary, which tells if two frequent ones share a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom import bit_table, may_hold
from .tables import materialise, packed
from .words import Texts, Words, mix, slices, word_ranges, hash_ranges

LONGEST = 5
LEAST = 100
TOP = 2_000
SKETCH_BITS = 24  # counters of the table, as a power of two
SLICE = 4 << 20
HELD_WORDS = 4 << 20  # words of runs that a task holds before it puts them together, and sends them on if more than half are left
SPLITS = 4  # of the input that a task counts together, at least, where there are so many for each core
_BLOCK_BITS = 16  # counters are moved in blocks
_UNKNOWN = "und"

# What parts pieces, and what parts the words of a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_ENDS = np.zeros(256, bool)
_ENDS[list(PIECE_ENDS)] = True
_WORD = ~_ENDS
_WORD[list(WORD_ENDS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_PLACE = mix(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)


def _language(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


class Pieces:
    """Words of a slice of texts: a hash of each with its language, and whether the next one is in the same piece."""

    def __init__(self, texts: Texts, languages: pa.Array):
        coded = languages.cast(pa.string()).fill_null(_UNKNOWN).dictionary_encode()
        self.names = coded.dictionary.to_pylist()
        start, end, bounds = word_ranges(texts, _WORD)
        self.texts, self.words = texts, Words(start, end, hash_ranges(texts.data, start, end), bounds)
        self.language = np.repeat(coded.indices.to_numpy(), self.words.counts)
        seeds = np.array([_language(n) for n in self.names], np.uint64)
        self.key = mix(self.words.hash + seeds[self.language]) if len(start) else np.zeros(0, np.uint64)
        ends = np.concatenate([[0], np.cumsum(_ENDS[texts.data])])
        self.goes_on = np.zeros(len(start), bool)
        if len(start):
            self.goes_on[:-1] = ends[start[1:]] == ends[end[:-1]]
            filled = bounds[1:][self.words.counts > 0]
            self.goes_on[filled - 1] = False

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The words at some places, as text."""
        start, size = self.words.start[at], self.words.end[at] - self.words.start[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        flat = self.texts.data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[flat].tobytes())]
        return pa.LargeStringArray.from_buffers(len(at), *buffers[1:]).cast(pa.string())


def run_hash(key: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` words from each place on."""
    value = np.full(len(at), size, np.uint64)
    for k in range(size):
        value += key[at + k] * _PLACE[k]
    return mix(value)


def _starts(goes_on: np.ndarray, size: int) -> np.ndarray:
    """Places from which a piece has `size` words."""
    if len(goes_on) < size:
        return np.zeros(0, np.int64)
    whole = np.ones(len(goes_on) - size + 1, bool)
    for k in range(size - 1):
        whole &= goes_on[k : k + len(whole)]
    return np.flatnonzero(whole)


def _place(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _survey(docs: DataFrame, text: str, lang: str, least: int, bits: int) -> DataFrame:
    """Words of the texts with their counts, and per task the counters of its runs of two and three words, none above `least`."""
    kind = np.uint8 if least < 256 else np.uint32
    ddl = "lang string, word string, key long, n long, block int, counters binary"
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def batch_of(rows: int, **columns):
        names = [part.split(" ")[0] for part in ddl.split(", ")]
        arrays = [columns.get(n, pa.nulls(rows, t)) for n, t in zip(names, types)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]):
        counters = np.zeros(1 << bits, np.uint32)
        for batch, texts in slices(batches, text, SLICE):
            pieces = Pieces(texts, batch.column(batch.schema.get_field_index(lang)))
            key, first, n = np.unique(pieces.key, return_index=True, return_counts=True)
            if not len(key):
                continue
            names = pa.array(pieces.names).take(pa.array(pieces.language[first]))
            yield batch_of(len(key), lang=names, word=pieces.spelled(first), key=pa.array(key.view(np.int64)), n=pa.array(n))
            for size in (2, 3):
                hashes = run_hash(pieces.key, _starts(pieces.goes_on, size), size)
                # Counts stop at `least` after each slice, so none can run over.
                np.add.at(counters, _place(hashes, bits), 1)
            np.minimum(counters, least, out=counters)
        step = 1 << min(_BLOCK_BITS, bits)
        for block in range(len(counters) // step):
            part = counters[block * step : (block + 1) * step]
            if part.any():
                yield batch_of(1, block=pa.array([block], pa.int32()), counters=pa.array([part.astype(kind).tobytes()], pa.binary()))

    return docs.select(F.col(text), F.col(lang).cast("string").alias(lang)).mapInArrow(run, ddl)


def _may_reach(surveyed: DataFrame, least: int, bits: int) -> np.ndarray:
    """A bit per counter whose sum over all tasks reaches `least`; at most 2^bits bits come to the driver."""
    kind = np.uint8 if least < 256 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]):
        block, total = None, None

        def done():
            packed_bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed_bits], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for b, counters in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(counters.as_buffer(), kind)
                if b != block:
                    if block is not None:
                        yield done()
                    block, total = b, np.zeros(len(part), np.int64)
                np.minimum(total + part, least, out=total)
        if block is not None:
            yield done()

    blocks = surveyed.filter("block IS NOT NULL").select("block", "counters")
    summed = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block int, bits binary")
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    for row in summed.toLocalIterator():
        part = np.frombuffer(row.bits, np.uint8)
        out[row.block * len(part) : (row.block + 1) * len(part)] = part
    return out


def _flagged(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    place = _place(hashes, bits)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def runs_of(pieces: Pieces, table: np.ndarray, bits: int, longest: int = LONGEST, words: np.ndarray | None = None) -> np.ndarray:
    """Per place, the length of the longest run from there on that may be frequent; up to `longest`.

    words: a bit table of the frequent words; no run that has another one is frequent."""
    key, goes_on = pieces.key, pieces.goes_on
    known = np.ones(len(key), bool) if words is None else may_hold(words, key)
    held = [np.zeros(len(key) + longest, bool) for _ in (2, 3)]
    for size, flags in zip((2, 3), held):
        at = _starts(goes_on, size)
        at = at[np.all([known[at + k] for k in range(size)], axis=0)]
        flags[at[_flagged(table, run_hash(key, at, size), bits)]] = True
    two, three = held
    length = np.ones(len(key), np.int64)
    length[two[: len(key)]] = 2
    still = two[: len(key)].copy()
    for size in range(3, longest + 1):
        # Each run of three words within it must be frequent too.
        still &= three[size - 3 : size - 3 + len(key)]
        length[still] = size
    return length


def _distinct(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of words and the sums of their counts."""
    value = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        value += rows[:, k] * _PLACE[k]
    _, first, back = np.unique(value, return_index=True, return_inverse=True)
    found = rows[first]
    if not np.array_equal(found[back], rows):  # two rows with one hash
        found, back = np.unique(rows, axis=0, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, back.ravel(), n)
    return found, sums


def _heads(before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first edge of each edge's path and the steps from there, by pointer doubling; on a ring, the edge itself."""
    head = np.where(before >= 0, before, np.arange(len(before)))
    steps = (before >= 0).astype(np.int64)
    for _ in range(len(before).bit_length()):
        steps, head = steps + steps[head], head[head]
    ring = before[head] >= 0
    return np.where(ring, np.arange(len(before)), head), np.where(ring, 0, steps)


def compact(edges: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unary paths of distinct edges: their words after one another, the bounds of each, and its weight.

    Two edges are put together at a node that only one of them leads to and only the other leaves, if they weigh the same. The
    runs of a path that are as long as an edge are its edges, so nothing is lost. A ring without a way in stays as single edges.
    """
    n, size = edges.shape
    at = np.arange(n) * size
    names, numbers = np.unique(np.concatenate([run_hash(edges.ravel(), at + k, size - 1) for k in (0, 1)]), return_inverse=True)
    leaves, enters = numbers[:n], numbers[n:]
    one_out, one_in = (np.bincount(x, minlength=len(names)) == 1 for x in (leaves, enters))
    leaving = np.zeros(len(names), np.int64)
    leaving[leaves] = np.arange(n)
    follower = leaving[enters]
    joined = one_in[enters] & one_out[enters] & (weights[follower] == weights) & (edges[follower][:, :-1] == edges[:, 1:]).all(1)
    before = np.full(n, -1)
    before[follower[joined]] = np.flatnonzero(joined)
    head, steps = _heads(before)
    order = np.lexsort((steps, head))
    first = steps[order] == 0
    # A path's first edge gives all its words, each other one its last.
    words = edges[order][first[:, None] | (np.arange(size) == size - 1)]
    bounds = np.concatenate([[0], np.cumsum(np.where(first, size, 1))])
    return words, bounds[np.append(np.flatnonzero(first), n)], weights[order][first]


def _tasks(splits: int, cores: int) -> int:
    """Tasks that fill the cores once or several times over, each of `SPLITS` splits or more where there are so many."""
    return min(splits, cores * max(1, splits // (SPLITS * cores)))


def _paths(docs: DataFrame, text: str, lang: str, table: np.ndarray, bits: int, longest: int, words: np.ndarray | None = None) -> DataFrame:
    """`(words, n)`: paths of edges, and the shorter runs that no frequent longer one goes on from, with how often they occur."""
    shared = docs.sparkSession.sparkContext.broadcast((table, words))

    def row(keys: np.ndarray, bounds: np.ndarray, n: np.ndarray):
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(keys.view(np.int64)))
        return pa.RecordBatch.from_arrays([lists, pa.array(n, pa.int64())], names=["words", "n"])

    def run(batches: Iterator[pa.RecordBatch]):
        # Runs of the slices so far by size, put together whenever they hold too many words.
        held: dict[int, list] = {size: [] for size in range(2, longest + 1)}
        waiting = 0

        def put_together():
            for parts in held.values():
                if len(parts) > 1:
                    parts[:] = [_distinct(*(np.concatenate(x) for x in zip(*parts)))]
            return sum(rows.size for parts in held.values() for rows, _ in parts)

        def together():
            for size, parts in held.items():
                if parts:
                    rows, n = _distinct(*(np.concatenate(x) for x in zip(*parts)))
                    parts.clear()
                    yield row(*compact(rows, n)) if size == longest else row(rows.ravel(), np.arange(len(rows) + 1) * size, n)

        for batch, texts in slices(batches, text, SLICE):
            pieces = Pieces(texts, batch.column(batch.schema.get_field_index(lang)))
            length = runs_of(pieces, shared.value[0], bits, longest, shared.value[1])
            for size, parts in held.items():
                at = np.flatnonzero(length == size)
                if len(at):
                    parts.append(_distinct(pieces.key[at[:, None] + np.arange(size)], np.ones(len(at), np.int64)))
                    waiting += parts[-1][0].size
            if waiting > HELD_WORDS:
                waiting = put_together()
                if waiting > HELD_WORDS // 2:
                    yield from together()
                    waiting = 0
        yield from together()

    # A run is sent once a task: tasks of several splits send it less often.
    wanted = docs.select(F.col(text), F.col(lang).cast("string").alias(lang))
    wanted = wanted.coalesce(max(1, _tasks(wanted.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism)))
    return wanted.mapInArrow(run, "words array<long>, n long")


def run_counts(paths: DataFrame, least: int, longest: int) -> DataFrame:
    """`(run, f)` of the runs of two and more words that occur `least` times, from the flow through the graph."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - longest + 1, F.lit(1)))
    edges = paths.select(F.explode(F.transform(starts, lambda i: F.slice("words", i, longest))).alias("run"), "n")
    edges = materialise(edges.groupBy("run").agg(F.sum("n").alias("f")), "edges")
    counts = [edges.filter(F.size("run") == longest)]
    for size in range(longest - 1, 1, -1):
        # What leaves a node: the runs one word longer that begin with it, and the places that end behind it.
        on = counts[-1].select(F.slice("run", 1, size).alias("run"), "f")
        flow = on.unionByName(edges.filter(F.size("run") == size)).groupBy("run").agg(F.sum("f").alias("f"))
        counts.append(materialise(flow, "flow"))
    return reduce(DataFrame.unionByName, counts).filter(F.col("f") >= least)


def _dictionary(surveyed: DataFrame, least: int) -> DataFrame:
    """`(key, lang, word, f, n)` of frequent words; n counts all words of the language."""
    words = surveyed.filter("word IS NOT NULL")
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    counted = words.groupBy("lang", "word").agg(F.first("key").alias("key"), F.sum("n").alias("f"))
    found = materialise(counted.filter(F.col("f") >= least).join(n, "lang").select("key", "lang", "word", "f", "n"), "dictionary")
    if found.groupBy("key").count().filter("count > 1").limit(1).count():
        raise ValueError("two frequent words share a hash: change the seeds in Pieces")
    return found


def _most(rows: DataFrame, top: int) -> DataFrame:
    """Rows that may be among the first `top` of their language, ties included; ranked in parts before languages as a whole."""
    better = [F.col("score").desc(), F.col("a").desc()]
    for by in (["lang", F.pmod(F.xxhash64("run"), F.lit(1024))], ["lang"]):
        rows = rows.withColumn("_rank", F.rank().over(Window.partitionBy(*by).orderBy(*better))).filter(F.col("_rank") <= top).drop("_rank")
    return rows


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP,
    absorbed: int = 100, bits: int = SKETCH_BITS,
) -> DataFrame:
    """`(lang, rank, phrase, a, l, r, n, score)`: each language's first `top` phrases of 2 to `longest` words.

    A phrase occurs `a` times (`least` or more). Cut in two, its parts occur l and r times, and floor(1000 a n / (l r)), with n the
    words of the language, is the score of a cut; the lowest one counts, of equal ones the one behind the fewest words. A phrase
    that lies in a longer one which occurs at least `absorbed` hundredths as often is left out. Order: score and a from the top, then
    the phrase's bytes.

    A NULL language is `und`, a NULL or empty text has no words, repeated rows count each, an empty table gives an empty one, and other columns are
    left out, whatever their names. A text of any length is read whole; its windows cost a task a multiple of its size.
    """
    surveyed = packed(_survey(docs, text, lang, least, bits), "survey")
    words = _dictionary(surveyed, least)
    paths = _paths(docs, text, lang, _may_reach(surveyed, least, bits), bits, longest, bit_table(words, "key"))
    runs = materialise(run_counts(paths, least, longest), "runs")

    size = F.size("run")
    longer = runs.filter(size > 2).select(F.explode(F.array(F.slice("run", 1, size - 1), F.slice("run", 2, size - 1))).alias("_in"), F.col("f").alias("_f"))
    longer = longer.groupBy("_in").agg(F.max("_f").alias("_f"))
    inside = (F.col("run") == F.col("_in")) & (100 * F.col("_f") >= absorbed * F.col("f"))
    kept = runs.join(longer, inside, "left_anti")

    cuts = kept.select("run", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    parts = runs.select("run", "f", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("long").alias("n")).unionByName(
        words.select(F.array("key").alias("run"), "f", "lang", "n")
    )
    left = parts.select(F.col("run").alias("_left"), F.col("f").alias("l"), "lang", "n")
    right = parts.select(F.col("run").alias("_right"), F.col("f").alias("r"))
    cuts = cuts.join(left, F.slice("run", F.lit(1), F.col("k")) == F.col("_left"))
    cuts = cuts.join(right, F.slice("run", F.col("k") + 1, size - F.col("k")) == F.col("_right"))
    # The first word's row brings the language.
    whole = cuts.groupBy("run", "a").agg(F.max("lang").alias("lang"), F.max("n").alias("n"), F.collect_list(F.struct("k", "l", "r")).alias("cuts"))
    wide = "cast({} as decimal({},0))".format
    above = f"{wide(1000, 4)} * {wide('a', 14)} * {wide('n', 18)}"
    lowest = f"array_min(transform(cuts, c -> struct(({above}) div ({wide('c.l', 18)} * {wide('c.r', 18)}) as score, c.k, c.l, c.r)))"
    scored = whole.select("run", "lang", "a", "n", F.expr(lowest).alias("c")).select("run", "lang", "a", "c.l", "c.r", "n", "c.score")
    first = materialise(_most(scored, top), "first")

    spelled = first.select("run", F.posexplode("run").alias("i", "key")).join(words.select("key", "word"), "key")
    spelled = spelled.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
    named = first.join(spelled.select("run", F.array_join(F.transform("w", lambda w: w["word"]), " ").alias("phrase")), "run")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
