"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root): each node that is not the smallest of its component, with the smallest.

    ``edges`` has two long columns ``a`` and ``b``. Large and small stars in turn: every round hangs a
    node's larger neighbours, then its smaller ones, on the smallest, until nothing changes. A node with
    many neighbours is reduced to its minimum on the map side; the joins are of written tables, whose hot
    keys adaptive execution can split.
    """
    pair = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = scratch.keep(edges.where("a != b").select(*pair).distinct(), f"{name}-0")
    seen, step = None, 0
    while seen != (seen := tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())) and seen[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = scratch.keep(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{name}-{step}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").where("b != m").select("b", "m").union(least.select("a", "m")).toDF("a", "b")
        now = scratch.keep(hung.distinct(), f"{name}-{step + 1}")
        scratch.drop(f"{name}-{step}", f"{name}-{step}-large")
        step += 1
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
