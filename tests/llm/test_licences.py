"""License notices against plain word search and a full edit-distance search."""

import random
import re

import pytest

from citeweave.llm.licences import NOTICES, PHRASES, allowed_edits, closest, find_notices, pieces
from citeweave.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    own, at, labels = words(text), [], set()
    for phrase, label in PHRASES:
        p = phrase.split(" ")
        hits = [i for i in range(len(own)) if own[i : i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(own), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def fewest_edits(notice, text):
    """Of the stretches of whole words in `text`, the least edit distance to `notice`."""
    far = 10**6
    data = " ".join(words(text)) + " "
    # cost[j]: of what is read of the notice, against some stretch that ends before data[j].
    cost = [0 if j == 0 or data[j - 1] == " " else far for j in range(len(data))]
    for c in notice:
        now = [cost[0] + 1]
        for j in range(1, len(data)):
            now.append(min(cost[j] + 1, now[j - 1] + 1, cost[j - 1] + (data[j - 1] != c)))
        cost = now
    return min(n for n, c in zip(cost, data) if c == " ")


def texts(seed, n=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text = " ".join(rng.choices(["the", "license", "under", "mit", "gnu", "general", "public", "x9", "é", "Apache"], k=rng.randint(0, 20)))
        for _ in range(rng.randint(0, 2)):
            notice = list(rng.choice(NOTICES)[0])
            for _ in range(rng.randint(0, allowed_edits("".join(notice)) + 1)):
                k, how = rng.randrange(len(notice)), rng.random()
                if how < 0.4:
                    notice[k] = rng.choice("abcxyz")
                elif how < 0.7:
                    notice.insert(k, rng.choice("abc"))
                else:
                    del notice[k]
            text += rng.choice([" ", "\n", ". "]) + "".join(notice).replace(" ", rng.choice([" ", "  ", "\n", " - "])).title() + rng.choice(["", ".", " tail"])
        out.append(text)
    return [*out, None, "", "MIT License MIT license", "permit license", "mit licenses", "general public\nLICENSE"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_edit_distance(spark, seed):
    rows = list(enumerate(texts(seed)))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, Labels string, other int").repartition(2)
    found = {r.doc_id: r for r in find_notices(docs).collect()}
    assert len(found) == len(rows)
    for id, text in rows:
        r = found[id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        least = {n: fewest_edits(n, text) for n, _ in NOTICES}
        held = {n for n, e in least.items() if e <= allowed_edits(n)}
        spans = {s.notice for s in r.spans}
        assert spans <= held
        # What is missing lies where a closer notice was found.
        for notice in held - spans:
            assert any(s.edits < least[notice] for s in r.spans), (notice, text)
        labels = {s.label for s in r.spans} | set(filter(None, r.base_labels.split(",")))
        assert r.labels == ",".join(sorted(labels)) and r.other == 1
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_spans_hold_the_notice(spark):
    text = "é Intro.\nLicensed under  the Apache-License, Version 2.0! All right reserved"
    row = find_notices(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    cut = [(s.label, s.edits, text.encode()[s.start : s.end].decode(), words(text)[s.first_word : s.last_word + 1]) for s in row.spans]
    assert cut == [
        ("apache", 0, "Licensed under  the Apache-License, Version 2.0", "licensed under the apache license version 2 0".split()),
        ("reserved", 1, "All right reserved", "all right reserved".split()),
    ]
    assert row.labels == "apache,reserved" and row.score == 1.0 and row.n_base == 1


def test_pieces_cover_the_notice():
    for notice, _ in NOTICES:
        cut = pieces(notice, allowed_edits(notice))
        assert "".join(p for _, p in cut) == notice and all(notice[at:].startswith(p) and p for at, p in cut)


def test_closest_places_count():
    assert closest([(0, 0, 10, 1), (1, 5, 12, 0), (2, 20, 30, 2), (3, 11, 15, 3)]) == [(1, 5, 12, 0), (2, 20, 30, 2)]


def test_many_notices_in_one_long_text_and_empty_table(spark):
    text = "Released under the MIT License. " * 5_000 + "word " * 50_000
    row = find_notices(spark.createDataFrame([(text,)], "text string")).first()
    assert len(row.spans) == 5_000 and row.n_base == 5_000 and row.first_word == 3
    assert find_notices(spark.createDataFrame([], "text string")).collect() == []


def test_query_on_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_notices"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
