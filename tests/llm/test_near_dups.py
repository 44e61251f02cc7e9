import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import near_dups
from citeweave.llm.components import components
from citeweave.llm.near_dups import near_duplicates, table_keys
from citeweave.llm.queries import QUERIES
from citeweave.llm.tables import read

from .cases import documents, prose

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """doc_id -> (n_shingles, component_id), every pair compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)):
                if 100 * len(x & y) >= 85 * len(x | y):
                    parent[root(a)] = root(b)
    smallest = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            smallest[root(k)] = min(i, smallest.get(root(k), i))
    return [(i, len(s), smallest.get(root(k))) for k, (i, s) in enumerate(sets)]


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def group_texts():
    rng = random.Random(9)
    base = [prose(rng, n, 5000) for n in (40, 120, 400, 800)]
    texts = [None, "", " \n", "one two", "One  TWO", "one two three", "a b c d e", "A b\tc d e", None, "one two"]
    for text in base:
        texts += [text, text.upper().replace("W", "w"), text] + [edited(rng, text, k) for k in (1, 1, 2, 3, 5, 8)]
    hub = prose(rng, 600, 9000)
    texts += [edited(rng, hub, rng.choice((2, 5, 8, 9))) for _ in range(60)]
    return texts + [prose(rng, rng.randrange(5, 300), 5000) for _ in range(30)]


def result(df):
    return sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())))


def test_same_components_as_all_pairs(spark):
    texts = group_texts()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    found = near_duplicates(documents(spark, texts, ids=ids).repartition(5))
    assert result(found) == sorted(map(repr, brute(list(zip(ids, texts)))))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    df = QUERIES["op3_tensored_minhash"](spark, SF)
    got = df.collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_nulls_repeats_and_empty(spark):
    text = "the same five words and more of them"
    docs = documents(spark, [text, text, text, None, "", "other words here entirely now ok"], ids=[7, 7, None, None, 3, None])
    rows = near_duplicates(docs.withColumn("kept", F.lit("x")).withColumn("hi", F.lit(1))).collect()
    assert len(rows) == 6 and sum(r.kept for r in rows if r.component_id == 7) == 1
    assert sum(r.kept for r in rows) == 4
    assert near_duplicates(documents(spark, [])).count() == 0
    assert near_duplicates(documents(spark, [None, ""])).count() == 2


def test_keys_are_pairs_of_bands():
    mins = np.random.default_rng(0).integers(0, 2**32, (3, 12), dtype=np.uint32)
    mins[1, :2], mins[1, 6:8] = mins[0, :2], mins[0, 6:8]  # one band of each collection
    keys = table_keys(mins, bands=3, band_rows=2)
    assert keys.shape == (3, 9) and (keys[0] == keys[1]).sum() == 1 and keys[0][0] == keys[1][0]
    assert not (keys[0] == keys[2]).any()


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    edges += [(900, i) for i in range(901, 960)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {x: root(x) for x in linked} and len(got) == len(linked)


def test_agreeing_minhashes_asked_for_follow_the_threshold():
    assert near_dups.least_agreeing(85, 60) == 0.55  # under 33: 6 in 10^9
    assert near_dups.least_agreeing(80, 60) == 28 / 60  # under 28: 2 in 10^9, under 33: 3 in 10^6


def large_group(n, words=150, seed=4):
    """Copies of one text with edits of their own: most pairs are just below the threshold, many links go over others."""
    rng = random.Random(seed)
    base = prose(rng, words, 9000)
    return [edited(rng, base, rng.choice((1, 2, 3, 3, 4, 4, 5))) for _ in range(n)]


def components_by_overlaps(texts):
    """The smallest position of each text's component, from the overlaps of all pairs."""
    sets = [shingles(t) for t in texts]
    held = {}
    for i, s in enumerate(sets):
        for x in s:
            held.setdefault(x, []).append(i)
    common = [rows for rows in held.values() if len(rows) > 1]
    matrix = np.zeros((len(sets), len(common)), np.float32)
    for k, rows in enumerate(common):
        matrix[rows, k] = 1
    both = matrix @ matrix.T
    size = np.array([len(s) for s in sets])
    linked = 100 * both >= 85 * (size[:, None] + size[None] - both)
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        new = np.array([label[row].min() for row in linked])
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize("n", [300, 3000])
def test_large_group_just_below_the_threshold(spark, monkeypatch, n):
    texts = large_group(n)
    joined = []
    plain = near_dups._agreeing

    def counted(pairs, nodes, least):
        joined.append(pairs.count())
        return plain(pairs, nodes, least)

    monkeypatch.setattr(near_dups, "_agreeing", counted)
    found = near_duplicates(documents(spark, texts).repartition(7)).collect()
    labels = components_by_overlaps(texts)
    assert len(set(labels)) > n / 20 and max(map(labels.count, set(labels))) > n / 20
    assert sorted((r.doc_id, r.component_id) for r in found) == list(enumerate(labels))
    assert joined[0] < n * n / 2 / 10


def test_links_joined_do_not_grow_with_the_square_of_a_dense_group(spark, monkeypatch):
    """Copies of one text with 2 to 6 edits, of which two with up to 6 together are linked: about a quarter of all pairs."""
    plain, figures = near_dups._confirmed, []

    def counted(pairs, sets, percent):
        found = plain(pairs, sets, percent)
        figures[-1] += found.count()
        return found

    monkeypatch.setattr(near_dups, "_confirmed", counted)
    for n in (200, 800):
        rng = random.Random(6)
        base = prose(rng, 400, 90000)
        texts = [edited(rng, base, rng.choice((2, 3, 4, 5, 6))) for _ in range(n)]
        figures.append(0)
        found = near_duplicates(documents(spark, texts).repartition(4)).collect()
        assert sorted((r.doc_id, r.component_id) for r in found) == list(enumerate(components_by_overlaps(texts)))
    few, many = figures
    assert many < 8 * few and many < 8 * 800


def test_differences_find_every_pair_of_a_centre(spark):
    """Without buckets: all members of one centre, each a component of its own."""
    texts = large_group(120, words=60, seed=8) + ["one two three four five six"]
    sets = [np.array(sorted({hash(x) & (2**63 - 1) for x in shingles(t)}), np.uint64) for t in texts]
    held = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, set binary")
    members = spark.createDataFrame(
        [(0, i % 3, i, len(s), i) for i, s in enumerate(sets) if i], "centre long, part long, node long, n_shingles long, component long"
    )
    links, pairs = near_dups._around_centres(members, held, 85)

    def linked(i, j):
        common = len(np.intersect1d(sets[i], sets[j]))
        return 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common)

    near = {r.u for r in links.collect()}
    assert near == {i for i in range(1, len(sets)) if linked(0, i)}
    found = {(r.a, r.b) for r in pairs.collect()}
    wanted = {(i, j) for j in range(1, len(sets)) for i in range(1, j) if linked(i, j) and not (i in near and j in near)}
    assert wanted and wanted <= found
