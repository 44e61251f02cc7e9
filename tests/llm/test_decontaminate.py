import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.llm.decontaminate import SPAN, RUN, contamination, winnow
from citeweave.llm.queries import ORACLES, QUERIES

from ..oracle import differences, duck
from .cases import documents, prose

SF = "/root/testdata/sf0.001"
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    out = []
    cut = [(i, split(t)) for i, t in items]
    for text in texts:
        words, hit, found = split(text), set(), set()
        for i, item in cut:
            n = min(len(item), SPAN)
            wanted = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in wanted:
                    hit.update(range(k, k + n))
                    found.add(i)
        out.append((len(words), len(hit), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def case(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice((13, 14, 20, 40, 60)), 60)) for i in range(8)]
    items += [(20, "alpha beta gamma"), (21, "w1"), (22, prose(rng, 6, 3)), (23, prose(rng, 12, 4)), (24, None), (25, " ,. "), (26, "a " * 30)]
    items += [(None, prose(rng, 15, 50)), (9, items[2][1]), (2, items[3][1])]
    texts = [None, "", "--", "W1", "Alpha-Beta, gamma alpha", "a " * 13, "a " * 12, "é ü " * 20]
    for _ in range(60):
        parts = [prose(rng, rng.randrange(0, 200), 60)]
        for _ in range(rng.randrange(0, 4)):
            words = split(rng.choice(items)[1])
            at = rng.randrange(0, max(1, len(words) - 5))
            parts += [", ".join(words[at : at + rng.choice((5, 12, 13, 14, 30))]).upper(), prose(rng, rng.randrange(0, 30), 60)]
        texts.append(" ".join(parts))
    return texts, items


@pytest.mark.parametrize("seed", range(2))
def test_same_words_as_brute_force(spark, seed):
    texts, items = case(seed)
    found, spans, _ = contamination(documents(spark, texts), spark.createDataFrame(items, ITEMS))
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in found.collect()}
    want = brute(texts, items)
    assert [got[i] for i in range(len(texts))] == want
    assert spans.count() > 0


def test_every_shared_span_has_a_common_fingerprint():
    rng = np.random.default_rng(1)
    for _ in range(50):
        shared = rng.integers(1, 1 << 60, SPAN - RUN + 1, dtype=np.uint64)
        sides = []
        for _ in range(2):
            a, b = (rng.integers(1, 1 << 60, rng.integers(0, 30), dtype=np.uint64) for _ in range(2))
            hashes = np.concatenate([a, shared, b])
            picked = winnow(hashes, np.array([0, len(hashes)]), SPAN - RUN + 1)
            sides.append({int(p) - len(a) for p in picked} & set(range(len(shared))))
        assert sides[0] & sides[1]


def test_odd_tables(spark):
    items = spark.createDataFrame([(1, "one two three")], ITEMS)
    docs = documents(spark, ["so one two three", "so one two three", None], ids=[4, 4, None])
    rows = contamination(docs.withColumn("n_hit", F.lit(0)).withColumn("key", F.lit(0)), items.withColumn("n", F.lit(1)))[0].collect()
    assert [(r.doc_id, r.n_hit) for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id))] == [(4, 3), (4, 3), (None, 0)]
    assert contamination(documents(spark, []), items)[0].count() == 0
    none = contamination(docs, spark.createDataFrame([], ITEMS))[0].collect()
    assert len(none) == 3 and not any(r.contaminated or r.n_items for r in none)


def test_query_equals_sql(spark):
    con = duck(SF)
    assert differences(QUERIES["op1_winnowing"](spark, SF), ORACLES["op1_winnowing"], con) == []
