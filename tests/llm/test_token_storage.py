import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm.files import Reader
from citeweave.llm.queries import QUERIES
from citeweave.llm.subwords import END_OF_TEXT, encode, encoder
from citeweave.llm.tables import read
from citeweave.llm.token_files import count_tokens_in_files, list_blocks, write_token_files
from citeweave.llm.training_order import materialise_order, permuted, read_back, read_from

from .cases import documents, prose

SF = "/root/testdata/sf0.001"


def texts():
    rng = random.Random(6)
    return [None, "", "", "a", "<|endoftext|>", "é 漢字\n\n  x"] + [prose(rng, rng.randrange(0, 300)) for _ in range(80)] + [prose(rng, 9_000)]


@pytest.mark.parametrize("block_bytes, file_bytes", [(8 << 20, 256 << 20), (14, 3_000), (64, 1), (1 << 12, 20_000)])
def test_scan_finds_every_text(spark, block_bytes, file_bytes):
    docs = documents(spark, texts()).repartition(3)
    folder, manifest = write_token_files(docs, file_bytes=file_bytes)
    blocks = list_blocks(spark, folder, manifest.select("file").distinct(), block_bytes)
    counted = count_tokens_in_files(folder, blocks)
    rows = counted.join(manifest, ["file", "nth"]).collect()
    assert len(rows) == counted.count() == len(texts()) and all(r.closed for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(encode(t or "")) for i, t in enumerate(texts())}
    reader = Reader(folder)
    for r in rows:
        ids = np.frombuffer(reader.read(r.file, 2 * r.start, 2 * r.n_tokens), "<u2")
        assert encoder().decode(ids.tolist()) == (texts()[r.doc_id] or "")
    # The folder alone is enough.
    assert list_blocks(spark, folder, None, block_bytes).exceptAll(blocks).count() == 0


def test_rest_of_a_file_without_an_end(spark, tmp_path):
    end = END_OF_TEXT
    for name, ids in {"a": [1, 2, end, 3, 4, 5, 6, 7], "b": [8] * 9, "c": [end, end], "d": []}.items():
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, "<u2").tobytes())
    for size in (2, 4, 6, 100):
        got = count_tokens_in_files(str(tmp_path), list_blocks(spark, str(tmp_path), None, size)).collect()
        want = [("a", 0, 0, 2, True), ("a", 1, 3, 5, False), ("b", 0, 0, 9, False), ("c", 0, 0, 0, True), ("c", 1, 1, 0, True)]
        assert sorted((r.file[:-4], r.nth, r.start, r.n_tokens, r.closed) for r in got) == want


def test_empty_and_clashing(spark):
    folder, manifest = write_token_files(documents(spark, []))
    assert count_tokens_in_files(folder, list_blocks(spark, folder, manifest.select("file").distinct())).count() == 0
    docs = documents(spark, ["x", "x", None], ids=[1, 1, None]).withColumns({"file": F.lit(0), "nth": F.lit(0)})
    assert write_token_files(docs)[1].count() == 3


@pytest.mark.parametrize("total", (1, 2, 3, 17, 64, 1000))
def test_permutation(spark, total):
    def slots_of(key):
        numbers = spark.range(total)
        return [r.slot for r in numbers.select("id", permuted(numbers, "id", total, key).alias("slot")).orderBy("id").collect()]

    slots = slots_of(5)
    assert sorted(slots) == list(range(total))
    if total == 1000:
        other = slots_of(6)
        assert slots != other and sum(abs(a - b) > 1 for a, b in zip(slots, slots[1:])) > 950


def test_order_round_trip(spark):
    docs = documents(spark, texts()).repartition(3)
    order = materialise_order(docs, length=64, per_shard=9)
    rows = sorted(order.sequences.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(order.total)) == sorted(r.slot for r in rows)
    assert all((r.shard, r.place) == divmod(r.slot, 9) for r in rows) and len({r.file for r in rows}) == -(-order.total // 9)
    got = read_from(order, 0, order.total)
    assert [zlib.crc32(g.tobytes()) for g in got] == [r.crc32 for r in rows]
    assert sum(r.n_tokens for r in rows) == sum(len(encode(t or "")) + 1 for t in texts()) and sum(r.n_docs for r in rows) == len(texts())
    # Every text is there, in one piece or over the sequences of its task.
    used = b"".join(g[: r.n_tokens].tobytes() for g, r in zip(got, rows))
    assert len(used) == 2 * sum(len(encode(t or "")) + 1 for t in texts())
    short = encode(texts()[5]).tobytes()
    assert short in used
    resumed = read_from(order, 11, 20)
    assert all((a == b).all() for a, b in zip(resumed, got[11:31])) and len(resumed) == 20
    back = {r.slot: (r.crc32, r.n_ends) for r in read_back(order).collect()}
    assert back == {r.slot: (r.crc32, int((g == END_OF_TEXT).sum())) for r, g in zip(rows, got)}


def test_order_of_odd_tables(spark):
    order = materialise_order(documents(spark, []))
    assert order.total == 0 and order.sequences.count() == 0 and read_from(order, 0, 5) == []
    docs = documents(spark, ["a", "a", None], ids=[1, 1, None]).withColumns({"part": F.lit("x"), "slot": F.lit(1), "nth": F.lit(2)})
    order = materialise_order(docs.coalesce(1), length=8)
    (row,) = order.sequences.collect()
    assert (row.n_docs, row.n_tokens, row.slot) == (3, 5, 0)


def test_queries(spark):
    want = {r.doc_id: len(encode(r.text or "")) for r in read(spark, SF, "documents").collect()}
    counted = QUERIES["op8_separator_scan"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in counted} == want and len(counted) == len(want)
    rows = QUERIES["op6_training_order"](spark, SF).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert sum(r.n_tokens for r in rows) == sum(want.values()) + len(want) and sum(r.n_docs for r in rows) == len(want)


def test_sequences_are_stored_more_closely_at_their_level(spark, monkeypatch):
    from citeweave.llm import training_order

    stored, real = [], training_order.packed
    monkeypatch.setattr(training_order, "packed", lambda df, *options: stored.append((df, real(df, *options))) or stored[-1][1])
    docs = spark.range(400, numPartitions=1).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 300), i -> "
        "concat('w', hash(id % 40, i) % 5000, ' is')), id) AS text")
    training_order.materialise_order(docs)
    (made, written), = stored

    def size(df):
        return sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())

    assert size(written) < 0.98 * size(real(made, "default"))
