import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citeweave.llm.near_dups import without_near_duplicates
from citeweave.llm.tables import materialise, read

from .cases import documents, prose
from .test_decontaminate import brute as contaminated
from .test_near_dups import brute as components
from .test_quality import figures

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and what comes out of the last."""
    docs, out = read(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = materialise(stage(spark, docs, SF), name)
    return out + [docs]


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_columns(stages):
    assert all(df.columns == COLUMNS for df in stages[:5])


def test_quality_stage(stages):
    before, after = rows(stages[0]), rows(stages[1])
    for i, text in before.items():
        f = figures(text)
        bad = f["n_words"] < 10 or 100 * f["n_repeat_words"] > 20 * f["n_words"] or 10 * f["n_symbols"] > f["n_words"]
        bad = bad or sum("A" <= c <= "Z" for c in text) > sum("a" <= c <= "z" for c in text)
        assert (i not in after) == bad


def test_near_duplicate_stage(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert set(after) == {i for i, _, c in components(sorted(before.items())) if i == c}


def test_decontamination_stage(spark, stages):
    before, after = rows(stages[2]), rows(stages[3])
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    verdict = dict(zip(before, contaminated(before.values(), items)))
    assert set(after) == {i for i, v in verdict.items() if not v[3]} and set(before) - set(after)


def test_mixing_stage(stages):
    before, after = rows(stages[3]), stages[4].collect()
    copies = Counter(r.doc_id for r in after)
    assert set(copies) == set(before) and max(copies.values()) <= 3 and {r.doc_id: r.text for r in after} == before


def test_sharding_stage(stages):
    placed, before = stages[5].collect(), Counter(r.doc_id for r in stages[4].collect())
    assert Counter(r.doc_id for r in placed) == before
    per = Counter(r.shard for r in placed)
    assert max(per.values()) - min(per[s] for s in range(corpus_pipeline.SHARDS)) <= 1


def test_run_is_the_stages(spark, stages):
    again = corpus_pipeline.run(spark, SF)
    assert again.columns == stages[5].columns and again.count() == stages[5].count()


def test_one_of_equal_rows_stays(spark):
    rng = random.Random(1)
    a, b = prose(rng, 40), prose(rng, 40)
    docs = documents(spark, [a, a, b, b, None, ""], ids=[1, 1, 2, None, None, None]).withColumns({"_kept": F.lit(1), "kept": F.lit("x")})
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted([(1, a), (2, b), (0, ""), (0, "")])


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
