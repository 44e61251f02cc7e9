"""Flat token files and their token counts without an index: a scan for the end-of-text id.

A file is nothing but 16-bit ids, texts end to end, each followed by the end id. To count, tasks read blocks of bytes and
search them for that id; a text that crosses blocks is put together by a prefix scan over the blocks' last ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_path
from .files import NewFile, Reader, store
from .subwords import END_OF_TEXT, VOCABULARY, encode
from .tables import materialise

FILE_BYTES = 256 << 20
BLOCK_BYTES = 8 << 20
WIDTH = 2  # bytes of an id, little-endian


def write_token_files(docs: DataFrame, vocabulary: str = VOCABULARY, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """`(folder, manifest)`: the files, and which document is the how-manieth text of which file.

    A NULL or empty text is its end alone. Each file is closed at the first text past `file_bytes`.
    Repeated rows are written each. The manifest `(file, nth, doc_id)` only names what the scan finds.
    """
    folder = new_path(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]):
        file, nth = None, 0
        end = np.array([END_OF_TEXT], "<u2").tobytes()
        for batch in batches:
            names, places = [], []
            for text in batch.column(1):
                if file is None or file.size >= file_bytes:
                    if file is not None:
                        file.close()
                    file, nth = NewFile(folder, "tokens", ".bin"), 0
                file.write(encode(text.as_py() or "", vocabulary).astype("<u2").tobytes() + end)
                names.append(file.name)
                places.append(nth)
                nth += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(places, pa.int64()), batch.column(0)], names=["file", "nth", "doc_id"]
            )
        if file is not None:
            file.close()

    written = docs.select("doc_id", "text").mapInArrow(run, "file string, nth long, doc_id long")
    return folder, materialise(written, "manifest")


def list_blocks(spark: SparkSession, folder: str, names: DataFrame | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`(file, start, length)` in ids for every block of the files, of those in `names (file)` if given."""
    if names is None:
        files, path = store(folder)
        from pyarrow import fs

        found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        names = spark.createDataFrame([(f.base_name,) for f in found if f.base_name.endswith(".bin")], "file string")

    def run(batches):
        files, path = store(folder)
        for batch in batches:
            sizes = [files.get_file_info(f"{path}/{name}").size // WIDTH for name in batch.column(0).to_pylist()]
            step, out = max(1, block_bytes // WIDTH), ([], [], [])
            for name, size in zip(batch.column(0).to_pylist(), sizes):
                for start in range(0, size, step):
                    for column, value in zip(out, (name, start, min(step, size - start))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], names=["file", "start", "length"]
            )

    return names.select("file").mapInArrow(run, "file string, start long, length long")


def scan_blocks(folder: str, blocks: DataFrame, end: int = END_OF_TEXT) -> DataFrame:
    """Per block, the places of its ends in its file; blocks are dealt evenly, one read each."""

    def run(batches):
        reader = Reader(folder)
        for batch in batches:
            for name, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(reader.read(name, start * WIDTH, length * WIDTH), "<u2")
                ends = np.flatnonzero(ids == end) + start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]), pa.array([start], pa.int64()), pa.array([length], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends, pa.int64())),
                    ],
                    names=["file", "start", "length", "ends"],
                )
        reader.close()

    dealt = blocks.repartition(F.xxhash64("file", "start"))
    return dealt.mapInArrow(run, "file string, start long, length long, ends array<long>")


def count_tokens_in_files(folder: str, blocks: DataFrame, end: int = END_OF_TEXT) -> DataFrame:
    """`(file, nth, start, n_tokens, closed)` of every text in the files; the end itself is not counted.

    What follows a file's last end is a text that was never closed, told by `closed`; an empty rest is none.
    """
    found = materialise(scan_blocks(folder, blocks, end), "ends")
    # The prefix scan: one narrow row per block.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "file", "start", F.size("ends").cast("long").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last")
    ).select(
        "file", "start",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("texts_before"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("last_before"),
    )
    texts = found.join(stitched, ["file", "start"]).select(
        "file", "texts_before", "last_before", "ends", F.posexplode("ends").alias("i", "at")
    )
    previous = F.when(F.col("i") == 0, F.col("last_before")).otherwise(F.get("ends", F.col("i") - 1))
    closed = texts.select(
        "file", (F.col("texts_before") + F.col("i")).alias("nth"), (previous + 1).alias("start"),
        (F.col("at") - previous - 1).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    files = found.groupBy("file").agg(
        F.sum(F.size("ends")).alias("nth"), F.max(F.try_element_at("ends", F.lit(-1))).alias("last"), F.max(F.col("start") + F.col("length")).alias("size")
    )
    start = F.coalesce("last", F.lit(-1)) + 1
    rest = files.filter(start < F.col("size")).select(
        "file", F.col("nth").cast("long"), start.alias("start"), (F.col("size") - start).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(rest)
