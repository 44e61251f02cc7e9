import dataclasses
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.llm.files import Reader
from citeweave.llm.queries import ORACLES, QUERIES
from citeweave.llm.warc import _write_directory, all_captures, capture_key, captures_of, find_captures, read_captures, write_archive

from ..oracle import differences, duck

SF = "/root/testdata/sf0.001"
PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.com/A?b=1#c", "com,example,www)/A?b=1"),
        ("https://user@a.b:80", "b,a)/"),
        ("http://a.b/é x\n", "b,a)/%C3%A9%20x%0A"),
        ("not an address", "not%20an%20address"),
        ("", ""),
        (None, ""),
    ],
)
def test_keys(url, key):
    assert capture_key(url) == key


def rows():
    rng = random.Random(7)
    out = [(i, f"http://h{rng.randrange(6)}.example.org/p/{i}?q=é {i}", f"<p>page {i} ü</p>" * rng.randrange(1, 60)) for i in range(300)]
    out += [(300 + i, "http://copies.org/x", "the same long page " * 20) for i in range(150)]
    out += [(500, None, None), (501, "http://e.org/", ""), (502, "http://e.org/", "short"), (503, "http://e.org/", "short")]
    return out + [(None, "http://n.org/", "the same long page " * 20), (600, "http://big.org/", "x" * 3_000_000)]


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame(rows(), PAGES).repartition(5).withColumns({"digest": F.lit(1), "first": F.lit("x")})
    return write_archive(pages, archive_bytes=20_000, block_lines=7)


def test_round_trip(spark, archive):
    got = read_captures(archive, all_captures(archive), payloads=True).collect()
    source = {i: (u, h or "") for i, u, h in rows()}
    assert len(got) == len(source)
    for r in got:
        url, html = source[r.page_id]
        assert r.key == capture_key(url)
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        copy = r.page_id is None or 300 < r.page_id < 450
        assert (r.record_type, r.refers_to) == (("revisit", 300) if copy else ("response", None))
        assert r.payload == (None if copy else html)


def test_directory_is_sorted_and_sparse(archive):
    blocks = sorted(archive.directory.collect(), key=lambda r: (r.first_key, r.last_key))
    assert sum(b.lines for b in blocks) == len(rows()) and all(b.lines <= 7 for b in blocks)
    assert all(a.last_key <= b.first_key for a, b in zip(blocks, blocks[1:]))
    assert len({r.file for r in all_captures(archive).collect()}) > 5


def test_lookup(archive):
    urls = ["http://copies.org/x", rows()[17][1], "http://nowhere.org/", "http://e.org"]
    found = read_captures(archive, find_captures(archive, urls), payloads=True).collect()
    want = {i for i, u, _ in rows() if u and capture_key(u) in {capture_key(x) for x in urls}}
    assert {r.page_id for r in found} == want and len(found) == len(want)
    assert find_captures(archive, []).count() == 0


def test_record_is_plain_warc(archive):
    capture = find_captures(archive, [rows()[3][1]]).first()
    import gzip

    text = gzip.decompress(Reader(archive.folder).read(capture.file, capture.offset, capture.length))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\n")


def test_odd_tables(spark):
    empty = write_archive(spark.createDataFrame([], PAGES))
    assert read_captures(empty, all_captures(empty)).count() == 0
    pages = [(1, "http://a.b/", "y" * 200), (1, "http://a.b/", "y" * 200), (None, None, "z" * 200), (None, None, "z" * 200)]
    twice = write_archive(spark.createDataFrame(pages, PAGES))
    assert [r.record_type for r in read_captures(twice, all_captures(twice)).collect()] == ["response"] * 4


def test_query_equals_sql(spark):
    assert differences(QUERIES["op7_capture_index"](spark, SF), ORACLES["op7_capture_index"], duck(SF)) == []


def asked(spark, urls, name="url"):
    return spark.createDataFrame([(u, 1) for u in urls], f"{name} string, key int")


def test_a_table_of_addresses(spark, archive):
    urls = [u for _, u, _ in rows()]
    every = captures_of(archive, asked(spark, urls * 2).repartition(4)).collect()
    assert sorted(map(str, every)) == sorted(map(str, all_captures(archive).collect()))
    some = [u for _, u, _ in rows()[::9]] + ["http://nowhere.org/", None, None]
    found = captures_of(archive, asked(spark, some)).collect()
    keys = {capture_key(u) for u in some}
    assert sorted(str(r.page_id) for r in found) == sorted(str(i) for i, u, _ in rows() if capture_key(u) in keys)
    assert captures_of(archive, asked(spark, [])).count() == 0


def test_rows_come_through_the_search(spark, archive, tmp_path):
    shuffled = str(tmp_path / "directory")
    archive.directory.coalesce(1).orderBy(F.xxhash64("offset", "file")).coalesce(1).write.parquet(shuffled)
    wrong = dataclasses.replace(archive, directory_folder=shuffled)
    urls = asked(spark, [u for _, u, _ in rows()])
    assert captures_of(wrong, urls).count() < captures_of(archive, urls).count() == len(rows())


def test_directory_over_several_files(spark, archive, monkeypatch):
    monkeypatch.setattr("citeweave.llm.warc.DIRECTORY_ROWS", 10)
    _, folder = _write_directory(archive.directory)
    more = dataclasses.replace(archive, directory_folder=folder)
    urls = asked(spark, [u for _, u, _ in rows()])
    assert captures_of(more, urls).count() == len(rows())
