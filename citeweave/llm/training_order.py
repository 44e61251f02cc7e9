"""Training order, materialised: every sequence gets a global slot, and slots are files of fixed stride.

Texts are packed end to end, task by task, into sequences of one length; only a task's last one is filled up. The slot of a
sequence is a keyed permutation of its number: a Feistel network over the smallest square that holds them all,
walked on until it falls inside. A slot's file and place follow from the slot alone, so a reader goes on from
any step with one seek.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_path
from .files import NewFile, Reader
from .subwords import END_OF_TEXT, VOCABULARY, encode
from .tables import materialise, packed

LENGTH = 1024  # ids of a sequence
PER_SHARD = 4_096  # sequences of a file: 8 MB
ROUNDS = 4
MAX_BROADCAST_TASKS = 1_000_000
MOST_READERS, MOST_WRITERS = 10_000, 50_000
LEVEL = 6  # of the compression that sequences are stored with, and that their ids move to their slot with
WIDTH = 2  # bytes of an id, little-endian


def feistel(number: Column, side: int, key: int, rounds: int = ROUNDS) -> Column:
    """A permutation of the numbers below `side` squared: two digits to the base `side`, one mixed into the other in turn."""
    left, right = F.floor(number / side).cast("long"), F.pmod(number, F.lit(side))
    for turn in range(rounds):
        left, right = right, F.pmod(left + F.pmod(F.xxhash64(F.lit(key), F.lit(turn), right), F.lit(side)), F.lit(side))
    return left * side + right


def permuted(numbers: DataFrame, number: str, total: int, key: int) -> Column:
    """The slot of a number as an expression: a permutation of 0 to `total` - 1.

    A value that falls outside is permuted again until it lies inside: as the network is a permutation, no two walks
    meet. About two in the root of `total` fall outside at first. How many steps the longest walk takes is found out
    on `numbers` alone, a narrow stored table, so that whatever belongs to them moves only once, to its slot.
    """
    side = math.isqrt(total - 1) + 1
    outside = materialise(numbers.select(feistel(F.col(number), side, key).alias("slot")).filter(F.col("slot") >= total), "walk")
    steps = 0
    while outside.limit(1).count():
        steps += 1
        outside = materialise(outside.select(feistel(F.col("slot"), side, key).alias("slot")).filter(F.col("slot") >= total), "walk")
    first = feistel(F.col(number), side, key)
    if not steps:
        return first
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), first, lambda slot, _: F.when(slot < total, slot).otherwise(feistel(slot, side, key))
    )


def _sequences(docs: DataFrame, length: int, vocabulary: str) -> DataFrame:
    """Sequences in the order of the table: task, place in the task, documents begun in it, used ids, and the ids."""
    ddl = "part int, nth long, first_doc_id long, n_docs int, n_tokens int, ids binary"
    names = ["part", "nth", "first_doc_id", "n_docs", "n_tokens", "ids"]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]):
        part, nth, held, begun, out = TaskContext.get().partitionId(), 0, np.zeros(0, np.uint16), [], []
        end = np.array([END_OF_TEXT], np.uint16)

        def put(ids):
            nonlocal nth, begun
            filled = np.pad(ids, (0, length - len(ids)), constant_values=END_OF_TEXT)
            out.append((part, nth, begun[0] if begun else None, len(begun), len(ids), filled.astype("<u2").tobytes()))
            begun, nth = [], nth + 1

        def batch():
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for rows in batches:
            for doc_id, text in zip(rows.column(0), rows.column(1)):
                begun.append(doc_id.as_py())
                held = np.concatenate([held, encode(text.as_py() or "", vocabulary), end])
                full = len(held) // length * length
                for at in range(0, full, length):
                    put(held[at : at + length])
                held = held[full:]
                if len(out) >= 1_000:
                    yield batch()
        if len(held):
            put(held)
        if out:
            yield batch()

    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def _smaller(placed: DataFrame) -> DataFrame:
    """Each sequence's ids compressed by themselves: what is shuffled is smaller than rows that are compressed in blocks as they come."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=LEVEL)
        for rows in batches:
            ids = pa.array([codec.compress(data.as_buffer(), asbytes=True) for data in rows.column(5)], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns[:5], ids], names=rows.schema.names)

    columns = placed.select("slot", "shard", "first_doc_id", "n_docs", "n_tokens", "ids")
    return columns.mapInArrow(run, "slot long, shard long, first_doc_id long, n_docs int, n_tokens int, ids binary")


def _write_shards(placed: DataFrame, folder: str, length: int, shards: int) -> DataFrame:
    """One file per shard, slot after slot. Tasks take ranges of slots, whole shards each; a task holds a few sequences at a time."""
    ddl = "slot long, shard long, place long, file string, first_doc_id long, n_docs int, n_tokens int, crc32 long"

    def run(batches):
        file, shard, out, codec = None, None, ([], [], [], [], [], [], [], []), pa.Codec("zstd")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        names = [part.strip().split(" ")[0] for part in ddl.split(",")]

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
            for column in out:
                column.clear()
            return made

        for rows in batches:
            for slot, own, first, docs, n, ids in zip(*(c for c in rows.columns)):
                if own.as_py() != shard:
                    if file is not None:
                        file.close()
                    shard = own.as_py()
                    file = NewFile(folder, f"shard-{shard:08d}", ".bin")
                data = codec.decompress(ids.as_buffer(), decompressed_size=length * WIDTH, asbytes=True)
                at = file.write(data)
                values = (slot.as_py(), shard, at // len(data), file.name, first.as_py(), docs.as_py(), n.as_py(), zlib.crc32(data))
                for column, value in zip(out, values):
                    column.append(value)
            yield batch()
        if file is not None:
            file.close()

    # Slots are known to be 0 to the last one, so the ranges need no sample: as many tasks as shards, or equal runs of shards.
    writers = max(1, min(shards, MOST_WRITERS))
    writer = F.floor(F.col("shard") * writers / max(shards, 1)).cast("int")
    return _smaller(placed).repartitionById(writers, writer).sortWithinPartitions("slot").mapInArrow(run, ddl)


@dataclass(frozen=True)
class Order:
    """The folder of shard files, and a stored table of the sequences: where each lies and what it holds."""

    folder: str
    sequences: DataFrame
    total: int
    length: int
    per_shard: int


def materialise_order(
    docs: DataFrame, key: int = 7, length: int = LENGTH, per_shard: int = PER_SHARD, vocabulary: str = VOCABULARY
) -> Order:
    """Write `docs (doc_id, text)` as sequences in training order.

    Each text is followed by the end id; NULL and empty texts are their end alone, repeated rows are written each. No id
    is dropped: the last sequence of a task is filled up with end ids, its n_tokens tells how many are real. The
    table says of each sequence: slot, shard, place in its file, file, first_doc_id (the document that first begins
    in it, NULL if none does), n_docs (how many begin in it), n_tokens, and crc32 of its bytes. An empty table gives no
    file and no row; columns other than the two are not read, whatever their names.
    """
    folder = new_path(docs.sparkSession, "order")
    made = packed(_sequences(docs, length, vocabulary), "sequences", LEVEL)
    # Numbers without gaps: one row per task is summed up.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = made.groupBy("part").agg(F.count("*").alias("n"))
    parts = materialise(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), "n"), "parts")
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    few = parts.limit(MAX_BROADCAST_TASKS + 1).count() <= MAX_BROADCAST_TASKS
    numbered = made.join(F.broadcast(parts) if few else parts, "part").withColumn("number", F.col("offset") + F.col("nth"))
    placed = numbered.withColumn("slot", permuted(numbered.select("number"), "number", max(total, 1), key))
    placed = placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long"))
    return Order(folder, materialise(_write_shards(placed, folder, length, -(-total // per_shard)), "order"), total, length, per_shard)


def read_from(order: Order, step: int, count: int) -> list[np.ndarray]:
    """The sequences of `count` slots from `step` on, by seeks alone: resuming costs one look at a file's name."""
    last = min(step + count, order.total)
    if step >= last:
        return []
    shards = F.col("shard").between(step // order.per_shard, (last - 1) // order.per_shard)
    files = dict(order.sequences.filter(shards).select("shard", "file").distinct().collect())
    reader, stride, out = Reader(order.folder), order.length * WIDTH, []
    for slot in range(step, last):
        data = reader.read(files[slot // order.per_shard], slot % order.per_shard * stride, stride)
        out.append(np.frombuffer(data, "<u2"))
    reader.close()
    return out


def read_back(order: Order) -> DataFrame:
    """`(slot, n_ends, crc32)` of every slot, read from the files alone, a shard after another in each task."""
    folder, stride = order.folder, order.length * WIDTH
    files = order.sequences.groupBy("shard", "file").agg(F.count("*").alias("n"))

    def run(batches):
        reader = Reader(folder)
        for batch in batches:
            for shard, name, n in zip(*(c.to_pylist() for c in batch.columns)):
                data = reader.read(name, 0, n * stride)
                ends = (np.frombuffer(data, "<u2").reshape(n, -1) == END_OF_TEXT).sum(axis=1)
                sums = [zlib.crc32(data[k * stride : (k + 1) * stride]) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n) + shard * per_shard), pa.array(ends, pa.int64()), pa.array(sums, pa.int64())], names=["slot", "n_ends", "crc32"]
                )
        reader.close()

    per_shard = order.per_shard
    # A task for each few files, however short their list is.
    dealt = files.select("shard", "file", "n").repartition(min(order.total // per_shard + 1, MOST_READERS), "shard")
    return dealt.mapInArrow(run, "slot long, n_ends long, crc32 long")
