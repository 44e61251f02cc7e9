"""Tokens of two tokenizers over the same texts, cut into the smallest groups that cover the same bytes.

Both tokenizers spell the same bytes, so a token is known by where it ends, and groups end where both have an end. Along a
stretch of one-to-one tokens the two end arrays agree under one index shift (a diagonal): the shift is probed over 1, 2, 4, ...
tokens at once, and a stretch is jumped as a whole. Where probing fails, the irregular group is resolved token by
token up to the next common end, which gives the shift from there on. Many stretches, parted at common ends, are
followed side by side.

What a pair of ids is worth is a sum over the whole corpus. Tasks count the pairs of a block of documents and write the block's
links to a file; only its distinct pairs are shuffled, packed by parts of the second vocabulary, to be summed and sent
back to their blocks, where the links are read again. No table of all pairs is held anywhere: a part's table is bounded
by the vocabularies, a block's by its links.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_path
from .files import NewFile, Reader
from .tables import packed
from .vocabularies import Pair, load, pair
from .words import mix, slices

VOCABULARY_A = os.environ.get("CORPUS_VOCABULARY_A", "/opt/tokenizers/byte_bpe_50k.json")
VOCABULARY_B = os.environ.get("CORPUS_VOCABULARY_B", "/opt/tokenizers/piece_bpe_32k.model")
LANE_TOKENS = 64  # about how many tokens one of the stretches followed side by side has
MOST_PROBED = 64
BLOCK_LINKS = 2 << 20  # a block is closed at the first slice of texts past so many links
PARTS = 256


@dataclass
class Alignment:
    """`links` as indexes of both sides in order of place; per token, whether a group ends with it."""

    link_a: np.ndarray
    link_b: np.ndarray
    closes_a: np.ndarray
    closes_b: np.ndarray


def lanes(end_a: np.ndarray, end_b: np.ndarray, tokens: int = LANE_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) right behind common ends, about every `tokens` tokens, the first of all included."""
    i = np.arange(tokens, len(end_a), tokens)
    found_i, found_j = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for _ in range(tokens):
        if not len(i):
            break
        j = np.searchsorted(end_b, end_a[i - 1])
        common = end_b[j] == end_a[i - 1]
        found_i.append(i[common])
        found_j.append(j[common] + 1)
        i = i[~common] + 1
        i = i[i < len(end_a)]
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    first = np.concatenate([[True], np.diff(i) > 0])
    return i[first], j[first]


def align(end_a: np.ndarray, end_b: np.ndarray, tokens: int = LANE_TOKENS) -> Alignment:
    """Align two ascending arrays of ends with the same last one, texts after one another."""
    n_a, n_b = len(end_a), len(end_b)
    closes_a, closes_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
    # A link (i, j) stands at i + j: each step along the two arrays goes up by one or two.
    partner = np.full(n_a + n_b, -1, np.int64)
    if n_a:
        i, j = lanes(end_a, end_b, tokens)
        stop = np.append(i[1:], n_a)
        width = np.ones(len(i), np.int64)
        active = np.arange(len(i))
        while len(active):
            stuck = []
            for w in np.unique(width[active]).tolist():
                lane = active[width[active] == w]
                step = np.arange(w)
                at_a, at_b = i[lane][:, None] + step, j[lane][:, None] + step
                inside = at_a < stop[lane][:, None]
                equal = inside & (end_a[np.minimum(at_a, n_a - 1)] == end_b[np.minimum(at_b, n_b - 1)])
                run = np.where(equal.all(1), w, equal.argmin(1))
                jumped = step < run[:, None]
                a, b = at_a[jumped], at_b[jumped]
                closes_a[a], closes_b[b], partner[a + b] = True, True, b
                i[lane] += run
                j[lane] += run
                width[lane] = np.where(run == w, min(2 * w, MOST_PROBED), 1)
                stuck.append(lane[(run < w) & (i[lane] < stop[lane])])
            # The irregular group of each lane, up to where both sides end.
            lane = np.concatenate(stuck)
            while len(lane):
                a, b = i[lane], j[lane]
                partner[a + b] = b
                behind, ahead = end_a[a] <= end_b[b], end_b[b] <= end_a[a]
                i[lane] += behind
                j[lane] += ahead
                met = behind & ahead
                closes_a[a[met]], closes_b[b[met]] = True, True
                lane = lane[~met]
            active = active[i[active] < stop[active]]
    place = np.flatnonzero(partner >= 0)
    link_b = partner[place]
    return Alignment(place - link_b, link_b, closes_a, closes_b)


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below `most`, padded, and how many each has."""
    width = len(str(max(most - 1, 0)))
    numbers = np.arange(most)
    count = np.ones(most, np.int64)
    for k in range(1, width):
        count += numbers >= 10**k
    table = np.zeros((most, width + 1), np.uint8)
    for k in range(width):
        has = count > k
        table[has, k] = 0x30 + numbers[has] // 10 ** (count[has] - 1 - k) % 10
    return table, count


def digests(ids_a, bounds_a, ids_b, bounds_b, found: Alignment, digits) -> list[str]:
    """Per text, the SHA-256 of its groups `a1,a2|b1;a3|b2,b3`; '' without tokens."""
    table, count = digits
    last_a, last_b = np.flatnonzero(found.closes_a), np.flatnonzero(found.closes_b)
    group_a = np.cumsum(found.closes_a) - found.closes_a
    group_b = np.cumsum(found.closes_b) - found.closes_b
    first_b = np.concatenate([[0], last_b + 1])
    total = len(ids_a) + len(ids_b)
    ids, mark = np.empty(total, np.int64), np.empty(total, np.uint8)
    at = np.arange(len(ids_a)) + first_b[group_a]
    ids[at], mark[at] = ids_a, np.where(found.closes_a, ord("|"), ord(","))
    at = np.arange(len(ids_b)) + last_a[group_b] + 1
    ids[at], mark[at] = ids_b, np.where(found.closes_b, ord(";"), ord(","))
    size = count[ids]
    chars = table[ids]
    chars[np.arange(total), size] = mark
    text = chars[np.arange(table.shape[1]) <= size[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(size + 1)])[bounds_a + bounds_b].tolist()
    return [hashlib.sha256(text[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(ends, ends[1:])]


def _tokens(batch: pa.RecordBatch, text: str, both: Pair) -> list[np.ndarray]:
    strings = batch.column(batch.schema.get_field_index(text)).to_pylist()
    return both.encode([s or "" for s in strings])


def _align(both: Pair, ids_a: np.ndarray, ids_b: np.ndarray) -> Alignment:
    return align(*(np.cumsum(v.size[ids]) for v, ids in zip(both.sides, (ids_a, ids_b))))


def _files(docs: DataFrame, a: str, b: str):
    contents = []
    for path in (a, b):
        with open(path, "rb") as file:
            contents.append(file.read())
    return docs.sparkSession.sparkContext.broadcast(tuple(contents))


def align_documents(docs: DataFrame, text: str = "text", id: str = "doc_id", a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """`(id, a_ids, b_ids, a_ends, b_ends)`: the tokens of each text, and behind which of them each group ends.

    Group g holds the tokens from `a_ends[g - 1]` to `a_ends[g]` of one side and from `b_ends[g - 1]` to `b_ends[g]` of the other. A NULL or
    empty text, or one that a tokenizer does not spell byte by byte, has no tokens.
    """
    files = _files(docs, a, b)
    added = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("a_ids", "b_ids", "a_ends", "b_ends")]

    def lists(values, bounds):
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]):
        both = pair(*files.value)
        for batch, _ in slices(batches, text):
            ids_a, bounds_a, ids_b, bounds_b = _tokens(batch, text, both)
            found = _align(both, ids_a, ids_b)
            columns = [batch.column(0), lists(ids_a, bounds_a), lists(ids_b, bounds_b)]
            for closes, bounds in ((found.closes_a, bounds_a), (found.closes_b, bounds_b)):
                last = np.flatnonzero(closes)
                groups = np.searchsorted(last, bounds)
                columns.append(lists(last + 1 - np.repeat(bounds[:-1], np.diff(groups)), groups))
            yield pa.RecordBatch.from_arrays(columns, names=[id, "a_ids", "b_ids", "a_ends", "b_ends"])

    return docs.select(id, text).mapInArrow(run, T.StructType([docs.schema[id], *added]))


# -- figures of the pairs over the whole corpus ----------------------------------
_LINKS = ("n_a", "n_b", "n_groups", "n_links")


def _squeeze(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unsqueeze(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class _Block:
    """Documents whose links are counted together."""

    def __init__(self):
        self.batches, self.keys, self.links = [], [], 0

    def add(self, batch: pa.RecordBatch, keys: np.ndarray):
        self.batches.append(batch)
        self.keys.append(keys)
        self.links += len(keys)

    def close(self, out: NewFile, parts: int) -> list[tuple]:
        """Write rows and links; per part with pairs, `(part, offset, length, keys, counts)`. The first part always comes."""
        keys = np.concatenate(self.keys)
        distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        rows = pa.Table.from_batches(self.batches).combine_chunks().to_batches()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows[0].schema) as writer:
            writer.write_batch(rows[0])
        head, body = sink.getvalue().to_pybytes(), _squeeze(inverse.astype(np.uint32))
        sizes = len(head).to_bytes(8, "little")
        offset = out.write(sizes + head + body)
        length = 8 + len(head) + len(body)
        cuts = np.searchsorted(distinct, np.arange(parts + 1) << _PART_BITS)
        found = []
        for part, (lo, hi) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if hi > lo or part == 0:
                found.append((part, offset, length, _squeeze(distinct[lo:hi]), _squeeze(counts[lo:hi])))
        return found


_PART_BITS = 48  # a key is the part of the second id, then the second id times the first vocabulary's size plus the first id


def _keys(ids_a: np.ndarray, ids_b: np.ndarray, size_a: int, parts: int) -> np.ndarray:
    part = (mix(ids_b.astype(np.uint64) + np.uint64(1)) % np.uint64(parts)).astype(np.int64)
    return (part << _PART_BITS) + ids_b * size_a + ids_a


def _write_blocks(docs: DataFrame, text: str, id: str, files, folder: str, parts: int, block_links: int) -> DataFrame:
    kinds = {"block": pa.int64(), "part": pa.int32(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "keys": pa.binary(), "counts": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        both = pair(*files.value)
        digits = _digits(max(map(len, both.sides)))
        out, block, number = None, _Block(), TaskContext.get().partitionId() << 32

        def close():
            nonlocal out, block, number
            out = out or NewFile(folder, "links", ".bin")
            found = block.close(out, parts)
            columns = [[number] * len(found), [f[0] for f in found], [out.name] * len(found), *([f[k] for f in found] for k in range(1, 5))]
            block, number = _Block(), number + 1
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

        for batch, _ in slices(batches, text):
            ids_a, bounds_a, ids_b, bounds_b = _tokens(batch, text, both)
            found = _align(both, ids_a, ids_b)
            groups = np.searchsorted(np.flatnonzero(found.closes_a), bounds_a)
            links = np.searchsorted(found.link_a, bounds_a)
            counts = [np.diff(x) for x in (bounds_a, bounds_b, groups, links)]
            shas = digests(ids_a, bounds_a, ids_b, bounds_b, found, digits)
            rows = pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string())], names=[id, *_LINKS, "groups_sha256"]
            )
            block.add(rows, _keys(ids_a[found.link_a], ids_b[found.link_b], len(both.sides[0]), parts))
            if block.links >= block_links:
                yield close()
        if block.batches:
            yield close()
        if out is not None:
            out.close()

    ddl = "block long, part int, file string, offset long, length long, keys binary, counts binary"
    return docs.select(id, text).mapInArrow(run, ddl)


def _summed(pieces: DataFrame, size_a) -> DataFrame:
    """Per part, its distinct pairs, the sum of each, and whether no pair of the same second id has more."""

    def finish(part, held):
        keys, sums = _merged(held)
        second = (keys & ((1 << _PART_BITS) - 1)) // size_a
        best = np.zeros(len(keys), bool)
        if len(keys):
            starts = np.flatnonzero(np.concatenate([[True], np.diff(second) > 0]))
            most = np.maximum.reduceat(sums, starts)
            best = sums == np.repeat(most, np.diff(np.append(starts, len(keys))))
        return [part], [_squeeze(keys)], [_squeeze(sums)], [_squeeze(best)]

    def run(batches: Iterator[pa.RecordBatch]):
        part, held, waiting = None, [], 0
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

        def row(values):
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["part", "keys", "sums", "best"])

        for batch in batches:
            for p, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    if part is not None:
                        yield row(finish(part, held))
                    part, held, waiting = p, [], 0
                held.append((_unsqueeze(keys, np.int64), _unsqueeze(counts, np.int64)))
                waiting += len(held[-1][0])
                # What waits is at most as much again as what is held already.
                if waiting > 2 * len(held[0][0]) + (1 << 16):
                    held, waiting = [_merged(held)], 0
        if part is not None:
            yield row(finish(part, held))

    sorted_ = pieces.select("part", "keys", "counts").repartition("part").sortWithinPartitions("part")
    return sorted_.mapInArrow(run, "part int, keys binary, sums binary, best binary")


def _merged(held: list) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    starts = np.flatnonzero(np.concatenate([[True], np.diff(keys) > 0]))
    return keys[starts], np.add.reduceat(counts, starts)


def _answered(pieces: DataFrame, sums: DataFrame) -> DataFrame:
    """Each block's pieces again, with the corpus-wide figures of their pairs in place of the pairs."""
    nothing = F.lit(None)
    asked = pieces.select("part", F.lit(1).alias("kind"), "block", "file", "offset", "length", "keys", nothing.cast("binary").alias("sums"), nothing.cast("binary").alias("best"))
    told = sums.select(
        "part", F.lit(0).alias("kind"), nothing.cast("long").alias("block"), nothing.cast("string").alias("file"),
        nothing.cast("long").alias("offset"), nothing.cast("long").alias("length"), "keys", "sums", "best",
    )
    kinds = {"block": pa.int64(), "part": pa.int32(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "sums": pa.binary(), "best": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]):
        known = None
        for batch in batches:
            out = []
            for part, kind, block, file, offset, length, keys, total, best in zip(*(c.to_pylist() for c in batch.columns)):
                keys = _unsqueeze(keys, np.int64)
                if kind == 0:
                    known = keys, _unsqueeze(total, np.int64), _unsqueeze(best, bool)
                else:
                    at = np.searchsorted(known[0], keys)
                    out.append((block, part, file, offset, length, _squeeze(known[1][at]), _squeeze(known[2][at])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds.values())], names=list(kinds))

    both = told.unionByName(asked).repartition("part").sortWithinPartitions("part", "kind")
    return both.mapInArrow(run, "block long, part int, file string, offset long, length long, sums binary, best binary")


def _finished(answers: DataFrame, folder: str, schema: T.StructType) -> DataFrame:
    """Per document, the figures of its links, read again from its block's file."""

    def rows(reader: Reader, place: tuple, held: list) -> pa.RecordBatch:
        data = reader.read(*place)
        size = int.from_bytes(data[:8], "little")
        batch = pa.ipc.open_stream(data[8 : 8 + size]).read_next_batch()
        links = _unsqueeze(data[8 + size :], np.uint32)
        bounds = np.concatenate([[0], np.cumsum(batch.column("n_links").to_numpy())])
        figures = []
        for kind, k in ((bool, 1), (np.int64, 0)):
            values = np.concatenate([_unsqueeze(h[k], kind) for h in held]).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(values[links])])[bounds]
            figures.append(pa.array(np.diff(total), pa.int64()))
        *first, sha = batch.columns
        return pa.RecordBatch.from_arrays([*first, *figures, sha], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]):
        reader, block, place, held = Reader(folder), None, None, []
        for batch in batches:
            for b, _, file, offset, length, total, best in zip(*(c.to_pylist() for c in batch.columns)):
                if b != block:
                    if block is not None:
                        yield rows(reader, place, held)
                    block, place, held = b, (file, offset, length), []
                held.append((total, best))
        if block is not None:
            yield rows(reader, place, held)
        reader.close()

    return answers.repartition("block").sortWithinPartitions("block", "part").mapInArrow(run, schema)


def align_tokens(
    docs: DataFrame, text: str = "text", id: str = "doc_id", a: str = VOCABULARY_A, b: str = VOCABULARY_B,
    parts: int = PARTS, block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """`(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)` of each text, a row per row of `docs`.

    A link is a pair of tokens, one of each side, that share a byte. Its count is how often the corpus links its two ids;
    `count_sum` adds those of a text's links, `n_best` counts the links for whose second id no other first id is linked more
    often (ties count). A NULL or empty text, or one that a tokenizer does not spell byte by byte, has no tokens: zeros and an empty digest.
    Repeated rows count each, an empty table gives an empty one, and other columns are left out, whatever their names. A
    text is encoded as a whole, so a task holds the tokens of its longest text.
    """
    files = _files(docs, a, b)
    folder = new_path(docs.sparkSession, "links")
    pieces = packed(_write_blocks(docs, text, id, files, folder, parts, block_links), "pairs")
    sums = packed(_summed(pieces, len(load(files.value[0]))), "pair_sums")
    names = [*_LINKS, "n_best", "count_sum"]
    schema = T.StructType([docs.schema[id], *(T.StructField(n, T.LongType()) for n in names), T.StructField("groups_sha256", T.StringType())])
    return _finished(_answered(pieces, sums), folder, schema)
