"""License notices: exact phrases, and short notices found although a few characters are wrong.

A notice of n characters may differ from the text by k = n // `CHARACTERS_AN_EDIT` inserted, deleted or replaced characters.
Cut into k + 1 pieces, every such place still holds one piece unchanged, wherever the edits fall (pigeonhole). One
automaton finds all pieces of all notices in a single pass over the text; the text around a hit is a candidate, and the
regex library's bounded-error matching decides it and gives the span and its edits. What is searched is the sequence of words, in lower case and
parted by one space, so line breaks and punctuation inside a notice cost no edit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from ahocorasick import Automaton
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import ALNUM, Texts, Words, slices, words_of

CHARACTERS_AN_EDIT = 12

# Phrases counted exactly, word by word, and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Opening words of common notices, with their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a creative commons attribution", "cc"),
    ("creative commons attribution noncommercial", "cc-nc"),
    ("licensed under cc by nc 4 0", "cc-nc"),
    ("licensed under cc by sa 4 0", "cc-sa"),
    ("spdx license identifier", "spdx"),
    ("all rights reserved", "reserved"),
)

SPAN = "struct<label:string,notice:string,edits:int,first_word:long,last_word:long,start:long,end:long>"
_SPACE = 0x20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def allowed_edits(notice: str) -> int:
    return len(notice) // CHARACTERS_AN_EDIT


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """`edits` + 1 pieces of about the same length, with the places they begin at."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@cache
def _searcher(notices: tuple) -> tuple[Automaton, list]:
    """The automaton of all pieces, and a pattern per notice; built once per worker process."""
    held: dict[str, list] = {}
    patterns = []
    for n, (notice, _) in enumerate(notices):
        edits = allowed_edits(notice)
        # A match begins and ends with whole words: the spaces around it are not open to edits.
        patterns.append(regex.compile(rf"(?e) (?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}(?= )"))
        for at, piece in pieces(notice, edits):
            held.setdefault(piece, []).append((n, at))
    automaton = Automaton()
    for piece, places in held.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton, patterns


def plain(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in lower case, each after a space, with one more space behind a row's last word.

    Returns the bytes, where each word begins in them, and the bounds of the rows.
    """
    sizes = words.end - words.start + 1
    last = words.bounds[1:][words.counts > 0] - 1
    sizes[last] += 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    held = np.ones(at[-1], bool)
    held[at[:-1]] = False
    held[at[last + 1] - 1] = False
    out = np.full(at[-1], _SPACE, np.uint8)
    out[held] = _LOWER[texts.data[ALNUM[texts.data]]]
    return out, at[:-1] + 1, at[words.bounds]


def find_spans(text: str, bounds: np.ndarray, notices: tuple) -> list[tuple[int, int, int, int]]:
    """`(notice, start, end, edits)` in `text` as `plain` makes it, read as one character a byte.

    Candidates of one notice that touch are searched as one stretch, so a text costs its length however often it repeats a notice.
    """
    automaton, patterns = _searcher(notices)
    found = []
    for last, (size, places) in automaton.iter(text):
        for n, at in places:
            start = last + 1 - size - at
            slack = allowed_edits(notices[n][0]) + 1  # and the space around
            found.append((n, start - slack, start + len(notices[n][0]) + slack, last))
    if not found:
        return []
    n, low, high, at = np.array(found, np.int64).T
    # An edit must not reach into another row.
    row = np.searchsorted(bounds, at, "right") - 1
    low, high = np.maximum(low, bounds[row]), np.minimum(high, bounds[row + 1])
    order = np.lexsort((low, row, n))
    stretches: list[list[int]] = []
    for k, r, a, b in zip(*(x[order].tolist() for x in (n, row, low, high))):
        if stretches and stretches[-1][:2] == [k, r] and a <= stretches[-1][3]:
            stretches[-1][3] = max(stretches[-1][3], b)
        else:
            stretches.append([k, r, a, b])
    out = []
    for k, _, a, b in stretches:
        for match in patterns[k].finditer(text, a, b):
            out.append((k, match.start() + 1, match.end(), sum(match.fuzzy_counts)))
    return closest(out)


def closest(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The spans that no span with fewer edits overlaps: one place is named by what it is closest to."""
    if not spans:
        return []
    _, start, end, edits = np.array(spans, np.int64).T
    kept = np.ones(len(spans), bool)
    for e in np.unique(edits)[1:].tolist():
        # Places of fewer edits, united: those that begin before a span ends must end before it begins.
        fewer = np.flatnonzero(edits < e)
        fewer = fewer[np.argsort(start[fewer], kind="stable")]
        reach = np.maximum.accumulate(end[fewer])
        mine = np.flatnonzero(edits == e)
        before = np.searchsorted(start[fewer], end[mine])
        kept[mine] = (before == 0) | (reach[before - 1] <= start[mine])
    return [span for span, keep in zip(spans, kept.tolist()) if keep]


def phrase_places(texts: Texts, words: Words, phrase: str) -> np.ndarray:
    """Numbers of the words at which the words of `phrase` stand in a row, within one text; overlaps count."""
    parts = [p.encode() for p in phrase.split(" ")]
    known = words_of(Texts(np.frombuffer(b" ".join(parts), np.uint8), np.array([0, len(phrase.encode())])), ALNUM)
    n = len(words.hash) - len(parts) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = np.ones(n, bool)
    for k, value in enumerate(known.hash):
        hit &= words.hash[k : k + n] == value
    at = np.flatnonzero(hit)
    row = np.searchsorted(words.bounds, at, "right") - 1
    at = at[at + len(parts) <= words.bounds[row + 1]]

    def same(i: int) -> bool:
        return all(_LOWER[texts.data[words.start[i + k] : words.end[i + k]]].tobytes() == p for k, p in enumerate(parts))

    return at[[same(i) for i in at.tolist()]] if len(at) else at


def _scan(texts: Texts, phrases: tuple, notices: tuple) -> dict[str, list]:
    words = words_of(texts, ALNUM)
    rows = len(texts)
    first, last, n_base = [None] * rows, [None] * rows, [0] * rows
    base: list[set] = [set() for _ in range(rows)]
    labels: list[set] = [set() for _ in range(rows)]
    score, spans = [0.0] * rows, [[] for _ in range(rows)]
    for phrase, label in phrases:
        for at in phrase_places(texts, words, phrase).tolist():
            r = int(np.searchsorted(words.bounds, at, "right")) - 1
            place = at - int(words.bounds[r])
            first[r] = place if first[r] is None else min(first[r], place)
            last[r] = place if last[r] is None else max(last[r], place)
            n_base[r] += 1
            base[r].add(label)
            labels[r].add(label)
            score[r] = 1.0
    flat, begins, bounds = plain(texts, words)
    for k, start, end, edits in find_spans(flat.tobytes().decode("latin-1"), bounds, notices):
        notice, label = notices[k]
        a, b = (int(np.searchsorted(begins, x, "right")) - 1 for x in (start, end - 1))
        r = int(np.searchsorted(words.bounds, a, "right")) - 1
        labels[r].add(label)
        score[r] = max(score[r], 1 - edits / len(notice))
        zero, byte = int(words.bounds[r]), int(texts.bounds[r])
        spans[r].append(
            {"label": label, "notice": notice, "edits": edits, "first_word": a - zero, "last_word": b - zero,
             "start": int(words.start[a]) - byte, "end": int(words.end[b]) - byte}
        )
    for each in spans:
        each.sort(key=lambda s: (s["start"], s["end"], s["notice"]))
    join = lambda sets: [",".join(sorted(s)) for s in sets]
    return {
        "n_words": words.counts.tolist(), "n_base": n_base, "first_word": first, "last_word": last,
        "base_labels": join(base), "labels": join(labels), "score": score, "spans": spans,
    }


def find_notices(
    docs: DataFrame, text: str = "text", phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[tuple[str, str]] = NOTICES
) -> DataFrame:
    """`docs` with the notices of every whole text; one pass, nothing is shuffled.

    Added: n_words; of the exact phrases n_base (all places, overlaps too), first_word and last_word (their smallest and largest
    first word, from 0, else NULL) and base_labels; `spans`, one per notice found within its edits: label, notice, edits, its
    first and last word, and its bytes (start, end) in the text; `labels` of both; and `score`, the closest place's share of
    unedited characters, 1 for a phrase and 0 for none. Labels are distinct, sorted and joined by commas.

    Where places overlap, those of the fewest edits count; equally close ones of different notices all do. A NULL or empty text has no words and no labels. Repeated rows give
    the same result each, an empty table an empty one, and a column already named like an added one is replaced.
    """
    phrases, notices = tuple(map(tuple, phrases)), tuple(map(tuple, notices))
    added = T._parse_datatype_string(
        f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<{SPAN}>"
    )
    docs = docs.select([c for c in docs.columns if c.lower() not in added.names])
    schema = T.StructType([*docs.schema.fields, *added.fields])
    spans_type = pa.list_(
        pa.struct([("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()), *((n, pa.int64()) for n in ("first_word", "last_word", "start", "end"))])
    )
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), spans_type]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch, texts in slices(batches, text):
            columns = _scan(texts, phrases, notices)
            arrays = [pa.array(values, kind) for values, kind in zip(columns.values(), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *added.names])

    return docs.mapInArrow(run, schema)
