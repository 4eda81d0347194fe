"""Connected components of an undirected graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of hashes over them: the same for the same set of edges."""
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); root is the smallest node it reaches.

    Works on distributed edges alone; each round is written out, so a lost executor costs one
    round.  Repeated links and loops do no harm; no link gives an empty table.
    """
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above a node move to the least of its neighbourhood
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: so do a node and its neighbours below it
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                               F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = saved(small.where("u <> v").distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:  # stars: every edge leads to a root
            break
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
