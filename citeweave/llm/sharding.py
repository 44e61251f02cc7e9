"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

A row's key is its text, so equal texts lie side by side on the ring. Each virtual node owns the arc that ends at
it. A shard takes the rows of its own arcs until it is full; what is over goes on clockwise to the next
virtual node whose shard has room. Spark counts the arcs and ranks the rows within them; only the arcs' counts, at most
shards times virtual nodes, are handed out on the driver.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise, numbered

VIRTUAL_NODES = 64
CELL_BITS = 16  # the ring has so many places; an arc is a run of them
BLOCK_ROWS = 1_000  # rows that are ranked together; a fuller place is dealt over several blocks


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, bits: int = CELL_BITS) -> list[tuple[int, int]]:
    """`(last place of the arc, shard)` in order; a shard's places depend on its number alone."""
    nodes = {}
    for shard in range(shards):
        for copy in range(virtual_nodes):
            digest = hashlib.sha256(f"{shard}/{copy}".encode()).digest()
            nodes.setdefault(int.from_bytes(digest[:8], "big") >> (64 - bits), shard)
    return sorted(nodes.items())


def hand_out(arcs: list[int], owner: list[int], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """`(arc, from, to, shard)` for loads `arcs` in ring order: own arcs first, then clockwise.

    The capacities must add up to the loads at least; then a second round never lacks room.
    """
    room, pieces, waiting = list(capacity), [], []
    over = []
    for arc, load in enumerate(arcs):
        taken = min(load, room[owner[arc]])
        room[owner[arc]] -= taken
        if taken:
            pieces.append((arc, 0, taken, owner[arc]))
        over.append(taken)
    for turn in range(2 * len(arcs) + 1):
        arc = turn % len(arcs)
        while waiting and room[owner[arc]]:
            origin, start, stop = waiting[0]
            taken = min(stop - start, room[owner[arc]])
            room[owner[arc]] -= taken
            pieces.append((origin, start, start + taken, owner[arc]))
            if start + taken == stop:
                waiting.pop(0)
            else:
                waiting[0] = (origin, start + taken, stop)
        if turn < len(arcs) and over[arc] < arcs[arc]:
            waiting.append((arc, over[arc], arcs[arc]))
    return sorted(pieces)


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Without slack the loads are at most one apart."""
    if slack:
        return [int(-(-total * (1 + slack) // shards))] * shards
    return [total // shards + (shard < total % shards) for shard in range(shards)]


def shard_table(docs: DataFrame, shards: int) -> DataFrame:
    """`assign_shards` by rows, as the columns reports use: doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL)."""
    return assign_shards(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def assign_shards(
    docs: DataFrame,
    shards: int,
    measure: str = "rows",
    slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES,
    key: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A row per document: `_row`, doc_id, size (bytes of the text plus 16), text_crc32, shard, slot, overflowed.

    `measure` is what is bounded: "rows", or "bytes" (to within one document). A shard holds its share of
    the total times (1 + slack) at most. Slots count from 0 within a shard. `key` places a row on the
    ring, the text unless given; equal keys stay in one shard unless that is full. NULL texts count as empty ones;
    repeated rows get slots of their own. Only doc_id, text and the columns of `key` are read.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long") + 16
    place = F.xxhash64(text if key is None else key)
    keyed = materialise(
        numbered(docs).select(
            "_row", "doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), place.alias("place"),
            F.shiftrightunsigned(place, 64 - CELL_BITS).alias("cell"),
            (F.lit(1).cast("long") if measure == "rows" else size).alias("load"),
        ),
        "keyed",
    )
    nodes = ring(shards, virtual_nodes)
    ends = [place for place, _ in nodes]
    owner = [shard for _, shard in nodes]
    # A row per place at most: bounded, whatever the input.
    cells = keyed.groupBy("cell").agg(F.count("*").alias("cell_rows"))
    spark = docs.sparkSession
    arc_of = spark.createDataFrame(
        [(cell, bisect.bisect_left(ends, cell) % len(ends)) for cell in range(1 << CELL_BITS)], "cell long, arc int"
    )
    cells = F.broadcast(cells.join(F.broadcast(arc_of), "cell"))
    # The order within an arc: place, block, hash of the key, row. The arc that passes the ring's end keeps that order too.
    in_block = Window.partitionBy("cell", "block").orderBy("place", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks_of_cell = F.ceil(F.col("cell_rows") / block_rows)
    dealt = keyed.join(cells, "cell").withColumn("block", F.pmod(F.xxhash64("_row"), blocks_of_cell).cast("int"))
    blocks = dealt.groupBy("arc", "cell", "block").agg(F.count("*").alias("rows"), F.sum("load").alias("loads"))
    in_arc = Window.partitionBy("arc").orderBy("cell", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialise(
        blocks.withColumns(
            {"rows_before": F.coalesce(F.sum("rows").over(in_arc), F.lit(0)), "load_before": F.coalesce(F.sum("loads").over(in_arc), F.lit(0))}
        ),
        "blocks",
    )
    loads = [0] * len(nodes)
    for arc, load in blocks.groupBy("arc").agg(F.sum("loads")).collect():
        loads[arc] = load
    pieces = hand_out(loads, owner, capacities(sum(loads), shards, slack))
    table = spark.createDataFrame(
        [(i, *piece, piece[3] != owner[piece[0]]) for i, piece in enumerate(pieces)],
        "piece int, piece_arc int, start long, stop long, shard int, overflowed boolean",
    )
    ranked = (
        dealt.withColumns({"nth": F.row_number().over(in_block), "upto": F.sum("load").over(in_block)})
        .join(blocks.select("cell", "block", "rows_before", "load_before"), ["cell", "block"])
        .withColumns({"rank": F.col("rows_before") + F.col("nth") - 1, "at": F.col("load_before") + F.col("upto") - F.col("load")})
        .join(F.broadcast(table), (F.col("arc") == F.col("piece_arc")) & (F.col("at") >= F.col("start")) & (F.col("at") < F.col("stop")))
        .select("_row", "doc_id", "size", "text_crc32", "shard", "overflowed", "piece", "rank")
    )
    if measure == "rows":
        held = [(i, shard, start, stop - start) for i, (_, start, stop, shard) in enumerate(pieces)]
    else:
        ranked = materialise(ranked, "ranked")
        counted = ranked.groupBy("piece", "shard").agg(F.min("rank"), F.count("*")).collect()
        held = sorted(tuple(r) for r in counted)
    base, offsets = [0] * shards, []
    for piece, shard, first, count in held:
        offsets.append((piece, base[shard] - first))
        base[shard] += count
    offset = spark.createDataFrame(offsets, "piece int, offset long")
    return ranked.join(F.broadcast(offset), "piece").select(
        "_row", "doc_id", "size", "text_crc32", "shard", (F.col("rank") + F.col("offset")).alias("slot"), "overflowed"
    )
