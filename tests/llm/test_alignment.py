"""Token alignment against the tokenizers' own ids and a plain walk along both sides."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from citeweave.llm.alignment import VOCABULARY_A, VOCABULARY_B, align, align_documents, align_tokens
from citeweave.llm.queries import QUERIES
from citeweave.llm.vocabularies import Pair, load, units

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    a = tokenizers.Tokenizer.from_file(VOCABULARY_A)
    a.encode_special_tokens = True
    letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
    b = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY_B)

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def encode(text):
        """Both sides as (id, bytes), or nothing."""
        if not text:
            return [], []
        left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, piece(i)) for i in b.encode(text)]
        same = all(b"".join(t for _, t in side) == (" " + text).encode() for side in (left, right))
        return (left, right) if same else ([], [])

    return encode


def walk(left, right):
    """Groups and links of one text, token by token."""
    groups, links, i, j, end_a, end_b, open_a, open_b = [], [], 0, 0, 0, 0, [], []
    end_a = len(left[0][1]) if left else 0
    end_b = len(right[0][1]) if right else 0
    while i < len(left):
        links.append((left[i][0], right[j][0]))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a:
            open_a.append(left[i][0])
            i += 1
        if step_b:
            open_b.append(right[j][0])
            j += 1
        if step_a and step_b:
            groups.append((open_a, open_b))
            open_a, open_b = [], []
        if step_a and i < len(left):
            end_a += len(left[i][1])
        if step_b and j < len(right):
            end_b += len(right[j][1])
    return groups, links


def brute(rows, encode):
    done = [(id, *sides, *walk(*sides)) for id, text in rows for sides in [encode(text)]]
    counts = Counter(link for *_, links in done for link in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for id, left, right, groups, links in done:
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (id, len(left), len(right), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(said.encode()).hexdigest() if groups else "")
        )
    return sorted(out, key=repr)


def texts(seed, n=60):
    rng = random.Random(seed)
    letters = [*" \n\t  \r ab.A1é'  世界😀\x1c\xa0　", "<|endoftext|>", "</s>", "<0x41>", "'s", "the ", "ation", " license"]
    out = ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(n)]
    return [*out, *out[:5], None, "", " ", "  ", "\n", "a ", "a▁b", "x" * 3_000, "word " * 2_000, "\x00"]


@pytest.mark.parametrize("seed, parts, block_links", [(1, 4, 1), (2, 256, 1 << 20), (3, 1, 500)])
def test_against_a_plain_walk(spark, plain, seed, parts, block_links):
    rows = [*enumerate(texts(seed)), (None, "no id"), (3, "again")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n_a int, block string").repartition(3)
    found = align_tokens(docs, parts=parts, block_links=block_links)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, plain)


def test_empty_table(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_groups_of_documents(spark, plain):
    rows = [*enumerate(texts(7))]
    found = {r.doc_id: r for r in align_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for id, text in rows:
        left, right = plain(text)
        row = found[id]
        assert row.a_ids == [i for i, _ in left] and row.b_ids == [i for i, _ in right]
        cut = lambda ids, ends: [ids[a:b] for a, b in zip([0, *ends], ends)]
        assert list(zip(cut(row.a_ids, row.a_ends), cut(row.b_ids, row.b_ends))) == walk(left, right)[0]


@pytest.mark.parametrize("tokens", [1, 3, 64])
def test_ends_against_sets(tokens):
    rng = np.random.default_rng(3)
    for density in (0.05, 0.5, 0.99):
        for _ in range(20):
            n = int(rng.integers(1, 400))
            a, b = (np.union1d(np.flatnonzero(rng.random(n) < density), [n]) for _ in range(2))
            found = align(a, b, tokens)
            common, all_ends = np.intersect1d(a, b), np.union1d(a, b)
            assert np.array_equal(a[found.closes_a], common) and np.array_equal(b[found.closes_b], common)
            assert np.array_equal(found.link_a, np.searchsorted(a, all_ends)) and np.array_equal(found.link_b, np.searchsorted(b, all_ends))


def test_units_are_the_text():
    for text in texts(9):
        if text:
            assert "".join(" " + u for u in units(text)) == " " + text


def test_kept_units_are_bounded(plain):
    with open(VOCABULARY_A, "rb") as a, open(VOCABULARY_B, "rb") as b:
        both = Pair(load(a.read()), load(b.read()))
    both.MOST_KEPT = 100
    for text in filter(None, texts(11)):
        a, _, b, _ = both.encode([text])
        assert (a.tolist(), b.tolist()) == tuple([i for i, _ in side] for side in plain(text))
        assert both.weight <= 100 + 64 * 41 + len(text) * 65


def test_query_on_the_whole_table(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_run_skipping"](spark, SMALL).collect()), key=repr) == brute(rows, plain)
