"""WARC archives of pages, and a two-level index of their captures.

A capture's key is its address with the host's labels reversed, so a site's pages are neighbours. The sorted index lines
are written as compressed blocks; a sparse directory holds the first and last key of each
block. A lookup searches the directory, then one block, and reads one range of one archive.

Of captures with equal payloads the one with the smallest page_id is stored, the others refer to it.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import dataset
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_path
from .files import NewFile, Reader, store
from .tables import materialise

LEAST_SHARED = 100  # payloads of fewer bytes are stored each time
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1_000
MAX_BROADCAST_PAYLOADS = 100_000
DIRECTORY_ROWS, DIRECTORY_GROUP = 2_000_000, 1 << 20  # blocks of a directory's file, bytes of its row groups
SEARCHED_ROWS = 8_192
READ_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ADDRESS = re.compile(r"^([a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:\d*)?(.*)$", re.I | re.S)


@dataclass(frozen=True)
class Archive:
    folder: str
    index: str
    directory: DataFrame  # a row per block of the index, in the order of their keys
    directory_folder: str  # where tasks search it


def capture_key(url: str | None) -> str:
    """Reversed host, then the rest of the address: `com,example,www)/path?query`. No scheme, user or port; NULL is ""."""
    found = _ADDRESS.match(url or "")
    if not found:
        return quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")
    host = ",".join(reversed(found[2].lower().split(".")))
    return quote(f"{host}){found[4].split('#')[0] or '/'}", safe="%/:=&?~+!$,;'@()*[]")


def _record(kind: str, row: dict, payload: bytes, date: str) -> bytes:
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{_number(row['page_id'])}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(row['url'] or '', safe='%/:=&?~#+!$,;@()*[]')}", f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"X-Payload-Length: {row['bytes']}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{_number(row['first'])}>"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(value) -> str:
    return "" if value is None else str(value)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields in lower case, and the payload after the HTTP header."""
    head, _, rest = zlib.decompress(data, wbits=31).partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        fields[name.lower()] = value
    return fields, rest[: int(fields["content-length"])].partition(b"\r\n\r\n")[2]


def _page_id(text: str | None):
    number = text and text.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def _write_archives(pages: DataFrame, folder: str, date: str, archive_bytes: int) -> DataFrame:
    ddl = "key string, page_id long, file string, offset long, length long"

    def run(batches: Iterator[pa.RecordBatch]):
        file = None
        for batch in batches:
            out = ([], [], [], [], [])
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(("page_id", "url", "digest", "bytes", "first"))}
                kind = "response" if row["first"] is None or row["first"] == row["page_id"] else "revisit"
                payload = (batch.column(5)[i].as_py() or "").encode() if kind == "response" else b""
                packed = gzip.compress(_record(kind, row, payload, date), 6, mtime=0)
                if file is None or file.size >= archive_bytes:
                    if file is not None:
                        file.close()
                    file = NewFile(folder, "pages", ".warc.gz")
                at = file.write(packed)
                for column, value in zip(out, (capture_key(row["url"]), row["page_id"], file.name, at, len(packed))):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["key", "page_id", "file", "offset", "length"])
        if file is not None:
            file.close()

    return pages.select("page_id", "url", "digest", "bytes", "first", "html").mapInArrow(run, ddl)


def _write_index(captures: DataFrame, index: str, block_lines: int) -> DataFrame:
    """Index files of compressed blocks; a row of the directory per block."""
    ddl = "first_key string, last_key string, file string, offset long, length long, lines int"

    def run(batches):
        file, rows = None, []

        def block(lines):
            nonlocal file
            if file is None:
                file = NewFile(index, "captures", ".cdx.gz")
            packed = gzip.compress("".join(f"{key} {json.dumps(line)}\n" for key, line in lines).encode(), 6, mtime=0)
            at = file.write(packed)
            rows.append((lines[0][0], lines[-1][0], file.name, at, len(packed), len(lines)))

        waiting = []
        for batch in batches:
            for row in batch.to_pylist():
                waiting.append((row.pop("key"), row))
                if len(waiting) == block_lines:
                    block(waiting)
                    waiting = []
        if waiting:
            block(waiting)
        if file is not None:
            file.close()
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["first_key", "last_key", "file", "offset", "length", "lines"]
            )

    # Bytes of UTF-8 sort as code points do, so Spark's order is that of the search.
    dealt = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return dealt.mapInArrow(run, ddl)


def write_archive(
    pages: DataFrame, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES, block_lines: int = BLOCK_LINES
) -> Archive:
    """Store pages `(page_id, url, html)` as WARC files with their index in the shared folder.

    A NULL html is an empty payload, a NULL url has the key "". Payloads of `LEAST_SHARED` bytes or more are stored
    once, with the smallest page_id; a NULL page_id counts as none: such a row refers to a numbered one,
    and stores its own payload if there is none. Repeated rows with one page_id are stored each.
    Other columns are left out.
    """
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(
        "page_id", "url", "html", F.octet_length(html).cast("long").alias("bytes"), F.sha2(html.cast("binary"), 256).alias("digest")
    )
    shared = (
        pages.filter(F.col("bytes") >= LEAST_SHARED).groupBy(F.col("digest").alias("same"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("same", "first")
    )
    shared = materialise(shared, "payloads")
    if shared.limit(MAX_BROADCAST_PAYLOADS + 1).count() <= MAX_BROADCAST_PAYLOADS:
        shared = F.broadcast(shared)
    joined = pages.join(shared, F.col("digest") == F.col("same"), "left")
    folder, index = new_path(spark, "warc"), new_path(spark, "cdx")
    captures = materialise(_write_archives(joined, folder, date, archive_bytes), "captures")
    blocks = materialise(_write_index(captures, index, block_lines), "blocks")
    return Archive(folder, index, *_write_directory(blocks))


def _write_directory(blocks: DataFrame) -> tuple[DataFrame, str]:
    """The directory, sorted over few files and in small row groups, so that a task reads no more of it than its keys span."""
    path = new_path(blocks.sparkSession, "directory")
    order = ("first_key", "last_key", "file", "offset")
    files = blocks.count() // DIRECTORY_ROWS + 1
    dealt = blocks.repartitionByRange(files, *order).sortWithinPartitions(*order)
    dealt.write.option("parquet.block.size", DIRECTORY_GROUP).parquet(path)
    return blocks.sparkSession.read.schema(blocks.schema).parquet(path), path


def _lines(reader: Reader, name: str, offset: int, length: int) -> list[tuple[str, dict]]:
    text = gzip.decompress(reader.read(name, offset, length)).decode()
    split = (line.partition(" ") for line in text.splitlines())
    return [(key, json.loads(rest)) for key, _, rest in split]


_CAPTURE = "key string, page_id long, file string, offset long, length long"
_RESULT = "key string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"


def _captures_batch(found: list[tuple[str, dict]]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64()}
    columns = [pa.array([k for k, _ in found], pa.string())]
    columns += [pa.array([line[n] for _, line in found], kind) for n, kind in kinds.items()]
    return pa.RecordBatch.from_arrays(columns, names=["key", *kinds])


def all_captures(archive: Archive) -> DataFrame:
    """Every line of the index, block by block."""
    index = archive.index

    def run(batches):
        reader = Reader(index)
        for batch in batches:
            for row in batch.to_pylist():
                yield _captures_batch(_lines(reader, row["file"], row["offset"], row["length"]))
        reader.close()

    return archive.directory.repartition(F.xxhash64("file", "offset")).mapInArrow(run, _CAPTURE)


def _search(archive: Archive, keys: DataFrame) -> DataFrame:
    """`(key, file, offset, length)`: the blocks that may hold each of the distinct keys.

    Keys are dealt by range and sorted. A task goes through the part of the directory its keys span, a few thousand rows
    at a time, and bisects them for each key in their range. The directory must be sorted.
    """
    folder = archive.directory_folder

    def run(batches):
        source = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if source is None:
                files, path = store(folder)
                source = dataset.dataset(path, filesystem=files, format="parquet")
            keys = batch.column(0).to_pylist()
            spanned = (dataset.field("last_key") >= keys[0]) & (dataset.field("first_key") <= keys[-1])
            for part in source.to_batches(filter=spanned, batch_size=SEARCHED_ROWS):
                if not part.num_rows:
                    continue
                firsts, lasts = (part.column(n).to_pylist() for n in ("first_key", "last_key"))
                found, places = [], []
                for key in keys[bisect.bisect_left(keys, firsts[0]) : bisect.bisect_right(keys, lasts[-1])]:
                    at = bisect.bisect_left(lasts, key)
                    while at < len(lasts) and firsts[at] <= key:
                        found.append(key)
                        places.append(at)
                        at += 1
                taken = part.select(["file", "offset", "length"]).take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *taken.columns], names=["key", "file", "offset", "length"])

    dealt = keys.repartitionByRange("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "key string, file string, offset long, length long")


def captures_of(archive: Archive, addresses: DataFrame) -> DataFrame:
    """Captures of all addresses in the column `url`, each capture once however often its address is asked for.

    The directory is searched for each key, then the blocks it names, each read once. A key's blocks are read by
    many tasks, as one address may hold a large share of all captures. A NULL address has the key "", like an empty
    one; an address without captures gives no row; other columns are not read.
    """
    index = archive.index

    def keyed(batches):
        for batch in batches:
            keys = {capture_key(url.as_py()) for url in batch.column(0)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.string())], names=["key"])

    def run(batches):
        reader, block, lines, names = Reader(index), None, [], []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if (row["file"], row["offset"]) != block:
                    block = row["file"], row["offset"]
                    lines = _lines(reader, *block, row["length"])
                    names = [key for key, _ in lines]
                found += lines[bisect.bisect_left(names, row["key"]) : bisect.bisect_right(names, row["key"])]
                if len(found) >= 10_000:
                    yield _captures_batch(found)
                    found = []
            if found:
                yield _captures_batch(found)
        reader.close()

    keys = addresses.select("url").mapInArrow(keyed, "key string").distinct()
    blocks = _search(archive, keys).repartition("file", "offset").sortWithinPartitions("file", "offset", "key")
    return blocks.mapInArrow(run, _CAPTURE)


def find_captures(archive: Archive, urls: list[str]) -> DataFrame:
    """Captures of some addresses: binary search of the directory, then of the blocks that may hold them."""
    keys, index = sorted({capture_key(u) for u in urls}), archive.index

    def run(batches):
        reader = Reader(index)
        for batch in batches:
            rows = sorted(batch.to_pylist(), key=lambda r: (r["first_key"], r["last_key"]))
            lasts = [r["last_key"] for r in rows]
            for key in keys:
                at = bisect.bisect_left(lasts, key)
                while at < len(rows) and rows[at]["first_key"] <= key:
                    lines = _lines(reader, rows[at]["file"], rows[at]["offset"], rows[at]["length"])
                    names = [k for k, _ in lines]
                    found = lines[bisect.bisect_left(names, key) : bisect.bisect_right(names, key)]
                    if found:
                        yield _captures_batch(found)
                    at += 1
        reader.close()

    wanted = F.lit(False)
    if keys:
        wanted = (F.col("last_key") >= keys[0]) & (F.col("first_key") <= keys[-1])  # pushed down to the directory's files
    return archive.directory.filter(wanted).mapInArrow(run, _CAPTURE)


def read_captures(archive: Archive, captures: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of captures: type, size and digest of the payload, what a revisit refers to, and the payload if wanted.

    Size and digest of a response are worked out from what is stored; a revisit states those of the
    payload it refers to. Captures that follow each other in an archive are read in one go.
    """
    folder = archive.folder

    def run(batches):
        reader = Reader(folder)
        for batch in batches:
            out = ([], [], [], [], [], [], [])
            rows = batch.to_pylist()
            start, data, file = 0, b"", None
            for k, row in enumerate(rows):
                if row["file"] != file or row["offset"] < start or row["offset"] + row["length"] > start + len(data):
                    file, start, end = row["file"], row["offset"], row["offset"] + row["length"]
                    for later in rows[k + 1 :]:
                        if later["file"] != file or later["offset"] != end or end + later["length"] - start > READ_BYTES:
                            break
                        end += later["length"]
                    data = reader.read(file, start, end - start)
                at = row["offset"] - start
                fields, payload = parse_record(data[at : at + row["length"]])
                kind = fields["warc-type"]
                if kind == "response":
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                else:
                    size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
                values = (
                    row["key"], _page_id(fields["warc-record-id"]), kind, size, digest, _page_id(fields.get("warc-refers-to")),
                    payload.decode() if payloads and kind == "response" else None,
                )
                for column, value in zip(out, values):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
            names = ["key", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
        reader.close()

    dealt = captures.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, _RESULT)
