import random
import re
from collections import Counter

import numpy as np
import pytest

from citeweave.llm.quality import RULES, judge, measure, name_rules, order_rules, quality_cascade, Features
from citeweave.llm.queries import ORACLES, QUERIES
from citeweave.llm.words import texts_of
import pyarrow as pa

from ..oracle import differences, duck
from .cases import documents, prose

SF = "/root/testdata/sf0.001"


def figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if times[run] > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def texts():
    rng = random.Random(4)
    awkward = [None, "", " \n\t ", "one", "é" * 50, "a\n\na\nb\n a\na", "Ünï cödé " * 40, "x y z u v " * 9, "A B C D E F G H I J K L"]
    awkward += ["line of words here\n" * 8, "##" * 30 + " w" * 20, "a\r\nb\r\na\r\nb", "z" * 300_000 + " tail words"]
    return awkward + [prose(rng, rng.randrange(1, 400), 6 if i % 3 else 300) for i in range(60)] + ["long " + prose(rng, 120_000, 30_000)]


def test_profile_matches_brute_force(spark):
    docs = documents(spark, texts())
    got = {r.doc_id: r.asDict() for r in quality_cascade(docs, profile=True).collect()}
    assert len(got) == len(texts())
    for i, text in enumerate(texts()):
        want = figures(text)
        assert {k: got[i][k] for k in want} == want, i
        n = want["n_words"]
        if n < 10 or 100 * want["n_repeat_words"] > 20 * n:
            assert got[i]["rejected_by"]


@pytest.mark.parametrize("seed", range(4))
def test_order_never_changes_the_verdict(seed):
    shuffled = random.Random(seed).sample(RULES, len(RULES))
    features = Features(texts_of(pa.array(texts())))
    assert ((judge(features, RULES) < 0) == (judge(features, shuffled) < 0)).all()


def test_rules_are_ordered_by_rejections_per_second(spark):
    docs = documents(spark, texts())
    by = {f["rule"]: f for f in measure(docs)}
    assert set(by) == {r.name for r in RULES} and by["few_words"]["rejected"] > 0
    made = [{"rule": r.name, "rejected": i, "seconds": 1.0} for i, r in enumerate(RULES)]
    assert [r.name for r in order_rules(RULES, made)] == [r.name for r in reversed(RULES)]


def test_empty_repeated_and_clashing(spark):
    assert quality_cascade(documents(spark, [])).count() == 0
    docs = documents(spark, ["same text " * 3, "same text " * 3, None], ids=[1, 1, None]).withColumnRenamed("lang", "rejected_by")
    rows = quality_cascade(docs).collect()
    assert len(rows) == 3 and all(r.rejected_by == "few_words" for r in rows)


def test_query_equals_sql(spark):
    con = duck(SF)
    assert differences(QUERIES["op5_quality_cascade"](spark, SF), ORACLES["op5_quality_cascade"], con) == []


@pytest.mark.parametrize("seed", range(6))
def test_the_rule_named_is_the_first_of_the_list(seed):
    shuffled = random.Random(seed).sample(RULES, len(RULES))
    features = Features(texts_of(pa.array(texts())))
    found = name_rules(features, judge(features, shuffled), shuffled, RULES)
    flags = [rule.rejects(Features(texts_of(pa.array(texts())))) for rule in RULES]
    want = [next((k for k in range(len(RULES)) if flags[k][i]), -1) for i in range(len(features))]
    assert found.tolist() == want and len(set(want)) > 4


def test_rows_taken_again_and_again_keep_their_features():
    whole, rng = Features(texts_of(pa.array(texts()))), random.Random(8)
    want = [figures(t) for t in texts()]
    left = list(range(len(want)))
    for _ in range(5):
        if rng.random() < 0.7:
            whole.ranges
        if rng.random() < 0.5:
            whole.lines
        keep = [rng.random() < 0.8 for _ in left]
        whole, left = whole.take(np.array(keep)), [i for i, k in zip(left, keep) if k]
        assert len(whole) == len(left)
    got = zip(whole.n_words, whole.word_chars, whole.n_symbols, whole.lines[1], whole.n_repeat_words)
    assert [tuple(map(int, row)) for row in got] == [tuple(want[i].values()) for i in left]


def test_every_partition_is_measured(spark):
    docs = documents(spark, ["few words"] * 200).repartition(9)
    by = {f["rule"]: f for f in measure(docs, sample_rows=5)}
    assert by["few_words"]["rows"] == by["few_words"]["rejected"] == 45
