"""Documents to a sharded training corpus: each stage is stored as Parquet before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.decontaminate import without_contaminated
from citeweave.llm.mixing import mixture, realised
from citeweave.llm.near_dups import without_near_duplicates
from citeweave.llm.quality import quality_cascade
from citeweave.llm.sharding import shard_table
from citeweave.llm.tables import materialise, read

SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality_cascade(docs).filter(F.col("rejected_by").isNull()).drop("rejected_by")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's passages make up less than a twentieth of."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, each at least once."""
    return realised(mixture(docs)[0])


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes."""
    return shard_table(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# MinHash, and a permutation by Spark's hash, are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
