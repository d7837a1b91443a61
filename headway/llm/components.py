"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import keep


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node of the edges (a, b).

    Alternates two moves until nothing changes: every node links its larger neighbours to the smallest of its
    neighbourhood, then its smaller ones. Paths shrink by halves, so even a long chain takes few rounds. A
    round is two counts per node, combined before the exchange, and equi-joins on nodes, whose hot ones AQE
    splits; no neighbourhood is ever gathered. Each round is stored. Loops and repeated edges do no harm.
    """
    edges = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
                 .where("a <> b").distinct())
        large = keep(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
                 .unionByName(least.select("a", F.col("root").alias("b"))).where("a <> b").distinct())
        edges = keep(small, "small-star")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
