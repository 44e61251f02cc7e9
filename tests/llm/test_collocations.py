"""Collocations against plain counting, and their graph's parts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from citeweave.llm import collocations as module
from citeweave.llm.collocations import _heads, _paths, _tasks, collocations, compact
from citeweave.llm.queries import ORACLES, QUERIES
from tests.oracle import differences, duck

SMALL = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, longest, least, top):
    """`rows` of (text, lang)."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    found = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}

    def absorbed(lang, run, a):
        return any(
            o == lang and len(other) > len(run) and f >= a and any(other[i : i + len(run)] == run for i in range(len(other) - len(run) + 1))
            for (o, other), f in found.items()
        )

    out = []
    for (lang, run), a in found.items():
        if absorbed(lang, run, a):
            continue
        cuts = []
        for k in range(1, len(run)):
            l, r = counts[lang, run[:k]], counts[lang, run[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(run), a, l, r, totals[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    seen, ranked = Counter(), []
    for row in out:
        seen[row[0]] += 1
        if seen[row[0]] <= top:
            ranked.append((row[0], seen[row[0]], *row[1:]))
    return ranked


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "c", "é", "D\xa0d", "\x1f", "x-y", "the", "THE"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.2:
            text += "one two three four five six seven eight"
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), ("a a a a a a a a a a a a", "en"), (" \t\n.", None)]


def frame(spark, rows):
    return spark.createDataFrame([(t, g, "x") for t, g in rows], "text string, lang string, phrase string")


@pytest.mark.parametrize("seed, longest, least, bits", [(1, 5, 4, 20), (2, 5, 4, 6), (3, 3, 6, 16), (4, 2, 5, 16), (5, 5, 300, 10)])
def test_against_counting(spark, seed, longest, least, bits):
    rows = texts(seed)
    found = collocations(frame(spark, rows).repartition(3), longest=longest, least=least, top=40, bits=bits)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows, longest, least, 40))


def test_empty_table(spark):
    assert collocations(frame(spark, []), bits=10).collect() == []


def test_scores_beyond_64_bits(spark):
    # 1000 a n passes 2^64 only in figures, so the arithmetic is tested on them alone.
    wide = "cast({} as decimal({},0))".format
    a, n, part = 10**12, 10**16, 10**13
    row = spark.sql(f"SELECT ({wide(1000, 4)} * {wide(a, 14)} * {wide(n, 18)}) div ({wide(part, 18)} * {wide(part + 1, 18)}) AS score").first()
    assert row.score == 1000 * a * n // (part * (part + 1))


def test_paths_hold_each_edge_once():
    rng = np.random.default_rng(5)
    for alphabet in (2, 4, 40):
        word = rng.integers(1, 1 << 60, alphabet).astype(np.uint64)
        edges = np.unique(word[rng.integers(0, alphabet, (60, 4))], axis=0)
        weights = rng.integers(1, 3, len(edges))
        words, bounds, each = compact(edges, weights)
        found = Counter()
        for a, b, n in zip(bounds, bounds[1:], each):
            for i in range(a, b - 3):
                found[tuple(words[i : i + 4].tolist())] += int(n)
        assert found == Counter({tuple(e.tolist()): int(n) for e, n in zip(edges, weights)})


def test_one_path_for_a_chain_and_none_for_a_ring():
    line = np.arange(1, 12, dtype=np.uint64)
    edges = np.stack([line[i : i + 5] for i in range(7)])
    words, bounds, weights = compact(edges, np.full(7, 9))
    assert words.tolist() == line.tolist() and bounds.tolist() == [0, 11] and weights.tolist() == [9]
    head, steps = _heads(np.array([1, 2, 0, -1, 3]))
    assert head.tolist() == [0, 1, 2, 3, 3] and steps.tolist() == [0, 0, 0, 0, 1]


def test_runs_are_sent_once_a_task_of_several_splits(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    splits = 8 * cores
    docs = frame(spark, [("one two three, four five", "en")] * (20 * splits)).repartition(splits)
    monkeypatch.setattr(module, "SLICE", 100)  # several slices a task,
    monkeypatch.setattr(module, "HELD_WORDS", 16)  # and runs put together after each few
    table = np.full((1 << 10) // 8, 255, np.uint8)
    sent = _paths(docs, "text", "lang", table, 10, 5).collect()
    # "one two three", "two three" and "four five"
    assert len(sent) <= 3 * splits / 4
    assert sum(r.n for r in sent) == 3 * 20 * splits
    # Runs with a word that is not frequent are not sent, whatever the table of runs says.
    assert _paths(docs, "text", "lang", table, 10, 5, np.zeros(1 << 14, np.uint64)).count() == 0


def test_tasks_fill_the_cores():
    assert [_tasks(splits, 6) for splits in (0, 1, 6, 7, 23, 24, 32, 47, 48, 480)] == [0, 1, 6, 6, 6, 6, 6, 6, 12, 120]


def test_query_against_sql(spark):
    assert differences(QUERIES["op11_de_bruijn"](spark, SMALL), ORACLES["op11_de_bruijn"], duck(SMALL)) == []


def test_long_text_and_repeated_rows(spark):
    rows = [("one two three, " * 20_000, "en")] + [("one two", "en")] * 7
    found = collocations(frame(spark, rows), bits=12).collect()
    # "two three" lies in "one two three", which occurs as often.
    assert {(r.phrase, r.a, r.n) for r in found} == {("one two", 20_007, 60_014), ("one two three", 20_000, 60_014)}
