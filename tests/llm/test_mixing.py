import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from citeweave.llm.mixing import SEED, find_temperature, mixture, realised
from citeweave.llm.queries import QUERIES
from citeweave.llm.tables import read

from .cases import documents, prose

SF = "/root/testdata/sf0.001"


def weights(tokens, exponent):
    total = sum(tokens)
    powers = [(t / total) ** exponent for t in tokens]
    return [p / sum(powers) for p in powers]


def entropy(w):
    return -sum(x * math.log(x) for x in w)


@pytest.mark.parametrize("share, limit", [(0.9, math.inf), (0.97, math.inf), (1.0, 3.0), (0.95, 1.5), (0.5, 2.0)])
def test_exponent_meets_entropy_or_limit(spark, share, limit):
    tokens = [90_000, 5_000, 4_000, 900, 100]
    found = find_temperature(spark.createDataFrame([(t,) for t in tokens], "tokens long"), share, limit)
    w = weights(tokens, found.exponent)
    budget = max(t / x for t, x in zip(tokens, w))
    assert found.budget == pytest.approx(budget, rel=1e-9)
    repeats = max(budget * x / t for t, x in zip(tokens, w))
    assert repeats <= limit * 1.0001
    near = entropy(w) / math.log(5)
    assert near == pytest.approx(share, abs=1e-4) or repeats == pytest.approx(limit, rel=1e-3) or (found.exponent == 1.0 and near >= share)


def mix_of(spark, block_rows):
    rng = random.Random(2)
    sources = ["a"] * 200 + ["b"] * 40 + ["c"] * 9 + [None] * 20 + ["void"] * 3
    texts = [prose(rng, rng.randrange(0, 60)) for _ in sources[:-3]] + [None, "", " "]
    texts[3] = prose(rng, 60_000)
    docs = documents(spark, texts, sources)
    return docs, *mixture(docs, 0.97, 8.0, block_rows=block_rows)


@pytest.mark.parametrize("block_rows", (50_000, 16))
def test_copies_are_the_cut_of_the_permutation(spark, block_rows):
    docs, used, sources, found = mix_of(spark, block_rows)
    lines = {r.source: r for r in sources.collect()}
    rows = used.withColumn("place", F.xxhash64(F.lit(SEED), "doc_id", "text")).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    assert len(rows) == 272 and set(by) == {"a", "b", "c", None, "void"}
    assert {r.copies for r in by["void"]} == {1}
    for source in ("a", "b", "c", None):
        mine, line = by[source], lines[source]
        count = {r.doc_id: len((r.text or "").split()) for r in mine}
        assert line.tokens == sum(count.values()) and line.quota == pytest.approx(line.weight * found.budget, abs=2)
        blocks = -(-len(mine) // block_rows)
        keys = {b: spark.range(1).select(F.xxhash64(F.lit(SEED + 1), F.lit(source).cast("string"), F.lit(b).cast("long"))).first()[0] for b in range(blocks)}
        order = sorted(mine, key=lambda r: (keys[r.place % blocks], r.place))
        left, more = line.quota - line.passes * line.tokens, set()
        for r in order:
            if count[r.doc_id] > left:
                break
            left -= count[r.doc_id]
            more.add(r.doc_id)
        assert {r.doc_id: r.copies for r in mine} == {r.doc_id: line.passes + (r.doc_id in more) for r in mine}
        assert line.passes >= 1  # the default budget uses every document


def test_realised_rows(spark):
    docs, used, *_ = mix_of(spark, 50_000)
    out = realised(used)
    assert out.columns == docs.columns and out.count() == used.agg(F.sum("copies")).first()[0]


def test_small_budget_leaves_rows_out(spark):
    docs = documents(spark, ["one two three four"] * 50, ["x"] * 50)
    used, *_ = mixture(docs, budget=40.0)
    assert sorted(r.copies for r in used.collect()) == [0] * 40 + [1] * 10


def test_odd_tables(spark):
    used, _, found = mixture(documents(spark, []))
    assert used.count() == 0 and found.budget == 0
    docs = documents(spark, ["a b", "a b", None], ["s", "s", None], ids=[1, 1, None])
    docs = docs.withColumns({"copies": F.lit("x"), "passes": F.lit(1), "rest": F.lit(2), "place": F.lit(3), "_blocks": F.lit(0)})
    rows = mixture(docs)[0].collect()
    assert [r.copies for r in rows] == [1, 1, 1] and rows[0].passes == 1


def test_query(spark):
    rows = QUERIES["op2_temperature"](spark, SF).collect()
    counts = {r.doc_id: (r.source, len((r.text or "").split())) for r in read(spark, SF, "documents").collect()}
    assert {r.doc_id: (r.source, r.n_tokens) for r in rows} == counts and len(rows) == len(counts)
    assert all(1 <= r.copies <= 3 for r in rows)
