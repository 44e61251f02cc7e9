"""Words of whole texts as numpy arrays, straight from Arrow's UTF-8 buffers.

Word classes are sets of bytes: every byte of a character beyond ASCII belongs to a word, so
splitting bytes equals splitting characters. A word is known by a 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts are worked on in slices of about this size
_SPACES = [0x20, *range(0x09, 0x0E)]

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[_SPACES] = False
ALNUM = np.zeros(256, bool)  # ASCII letters, digits, and everything beyond ASCII
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_a:_b] = True

_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of an odd base modulo 2^64, at least `n` of them."""
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        factors = np.full(size, _BASE, np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """A slice of rows: the bytes of their texts after one another; `bounds` has a start per row and the end."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self):
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of a slice: byte ranges, hashes, and for each row the range of its words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self):
        return np.diff(self.bounds)

    @property
    def row(self):
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def texts_of(column: pa.Array) -> Texts:
    """A NULL text has no bytes."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Rows in pieces of about `size` bytes of text, one row at least; a longer text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        all_texts = texts_of(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(all_texts.bounds, all_texts.bounds[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            lo, hi = all_texts.bounds[at], all_texts.bounds[to]
            yield batch.slice(at, to - at), Texts(all_texts.data[lo:hi], all_texts.bounds[at : to + 1] - lo)
            at = to


def word_ranges(texts: Texts, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and the row bounds of the words made of `member` bytes."""
    size = len(texts.data)
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = member[texts.data]
    cut = np.zeros(size + 1, bool)
    cut[texts.bounds] = True
    here, before = inside[1:], inside[:-1]
    start = np.flatnonzero(here & (cut | ~before))
    end = np.flatnonzero(before & (cut | ~here))
    return start, end, np.searchsorted(start, texts.bounds)


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each byte range; A-Z count as a-z if `lower`. Ranges do not overlap."""
    table = _BYTE_LOWER if lower else _BYTE
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + SLICE_BYTES)))
        s, e = start[at:to] - start[at], end[at:to] - start[at]
        part = data[start[at] : end[to - 1]]
        gaps = np.diff(np.append(s, len(part)))
        place = np.arange(len(part)) - np.repeat(s, gaps)
        longest = int((e - s).max())
        np.minimum(place, longest, out=place)
        terms = table[part] * powers(longest + 1)[place]
        edges = np.empty(2 * len(s), np.int64)
        edges[0::2], edges[1::2] = s, e
        out[at:to] = np.add.reduceat(terms, edges[:-1])[0::2]
        at = to
    return mix(out + (end - start).astype(np.uint64))


def words_of(texts: Texts, member: np.ndarray, lower: bool = True) -> Words:
    start, end, bounds = word_ranges(texts, member)
    return Words(start, end, hash_ranges(texts.data, start, end, lower), bounds)


_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of `size` words and, per row, the bounds of its runs; none in a shorter row."""
    total = len(words.hash) - size + 1
    counts = np.maximum(words.counts - size + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if total <= 0 or not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    value = np.zeros(total, np.uint64)
    for k in range(size):
        value += words.hash[k : k + total] * _PLACE[k]
    first = np.repeat(words.bounds[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
    return mix(value[first]), bounds
