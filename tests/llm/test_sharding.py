import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from citeweave.llm.queries import QUERIES
from citeweave.llm.sharding import assign_shards, capacities, hand_out, ring
from citeweave.llm.tables import read

from .cases import documents, prose

SF = "/root/testdata/sf0.001"


def one_by_one(arcs, owner, capacity):
    """Rows put down singly: own rows first in ring order, then what is over, clockwise, in the order it meets a node."""
    held, room, over = {}, list(capacity), []
    for arc, load in enumerate(arcs):
        for rank in range(load):
            if room[owner[arc]]:
                room[owner[arc]] -= 1
                held[arc, rank] = owner[arc]
    waiting = []
    for turn in range(2 * len(arcs) + 1):
        arc = turn % len(arcs)
        while waiting and room[owner[arc]]:
            held[waiting.pop(0)] = owner[arc]
            room[owner[arc]] -= 1
        if turn < len(arcs):
            waiting += [(arc, r) for r in range(arcs[arc]) if (arc, r) not in held]
    return held


@pytest.mark.parametrize("seed", range(20))
def test_hand_out(seed):
    rng = random.Random(seed)
    shards, n = rng.randrange(1, 7), rng.randrange(1, 30)
    arcs = [rng.choice((0, rng.randrange(40))) for _ in range(n)]
    owner = list(range(shards)) + [rng.randrange(shards) for _ in range(n)]
    arcs, owner = arcs + [0] * (len(owner) - n), owner
    capacity = capacities(sum(arcs), shards, rng.choice((0.0, 0.25)))
    pieces = hand_out(arcs, owner, capacity)
    spread = {(arc, r): s for arc, a, b, s in pieces for r in range(a, b)}
    assert spread == one_by_one(arcs, owner, capacity) and len(spread) == sum(arcs)
    assert len(pieces) <= len(arcs) + 2 * shards + n


def check(rows, texts, ids, shards):
    assert Counter(r.doc_id for r in rows) == Counter(ids)
    per = Counter(r.shard for r in rows)
    assert set(per) <= set(range(shards))
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(per[s]))
    facts = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == facts
    return per


@pytest.mark.parametrize("block_rows", (250_000, 7))
def test_rows_are_at_most_one_apart(spark, block_rows):
    rng = random.Random(3)
    texts = [prose(rng, 20) for _ in range(150)] + ["copy of one text é"] * 90 + [None, "", "", "x" * 100_000]
    texts = [t for i, t in enumerate(texts) for _ in range(3 if i < 30 else 1)]
    ids = [*range(len(texts) - 2), 5, None]
    rows = assign_shards(documents(spark, texts, ids=ids).repartition(4), 7, block_rows=block_rows).collect()
    per = check(rows, texts, ids, 7)
    assert max(per.values()) - min(per.values()) <= 1
    assert 0 < sum(r.overflowed for r in rows) < len(rows) // 2
    if block_rows > 1000:
        # Only full shards part equal texts.
        where = {}
        for r in rows:
            where.setdefault(r.text_crc32, set()).add(r.shard)
        assert sum(len(where[zlib.crc32(t.encode())]) == 1 for t in texts[:90:3]) >= 24


def test_bytes_are_bounded(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(400)]
    docs = documents(spark, texts)
    rows = assign_shards(docs, 5, measure="bytes", slack=0.02).collect()
    check(rows, texts, range(400), 5)
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    largest = max(r.size for r in rows)
    assert max(load.values()) <= sum(load.values()) / 5 * 1.02 + 20 * largest


def test_few_rows_move_to_a_new_shard():
    old, new = ring(8), ring(9)
    moved = [place for place, shard in new if (place, shard) not in old]
    assert {shard for place, shard in new if place in moved} == {8}


def test_odd_tables(spark):
    assert assign_shards(documents(spark, []), 4).count() == 0
    docs = documents(spark, ["a", None]).withColumns({"slot": F.lit(1), "cell": F.lit(2), "block": F.lit(3)})
    assert len(check(assign_shards(docs, 4).collect(), ["a", None], [0, 1], 4)) == 2


def test_query(spark):
    source = read(spark, SF, "documents").collect()
    rows = QUERIES["op4_bounded_ring"](spark, SF).collect()
    per = check(rows, [r.text for r in source], [r.doc_id for r in source], 40)
    assert max(per.values()) - min(per.values()) <= 1
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
