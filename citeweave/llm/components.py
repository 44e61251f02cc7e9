"""Connected components by alternating large and small stars, each round stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise


def _to_smallest(pairs: DataFrame, own: bool) -> DataFrame:
    """Link each `v` of a node `u` to the smallest of them; with `own`, the node itself counts as one of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if own:
        least = least.select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_smallest(both, own=True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    linked = _to_smallest(edges, own=False)
    spread = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return spread.unionByName(linked.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """`(node, component)` for every node of `edges (u, v)`; the component is its smallest node.

    Loops, repeated and turned edges do no harm; NULL ends are left out. Each round is written
    to the shared folder, so a lost executor costs one round at most.
    """
    current = materialise(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        figures = tuple(current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if figures == before or not figures[0]:
            break
        before = figures
        current = materialise(_small_star(_large_star(current).distinct()).distinct(), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
