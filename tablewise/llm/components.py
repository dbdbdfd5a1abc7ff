"""Connected components of a link table by alternating large-star and small-star steps.

Each step is one aggregation and one join on the node; a node with very many neighbours is
pre-aggregated before the shuffle and its rows are split by the adaptive skew join.  The edge
table is written to the shared folder after each round, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewise.llm.common import cut


def _print(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links(a, b)`` -> ``(node, component)``: the smallest node reachable, for every node
    that has a link to another one."""
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                             F.least("a", "b").alias("v")).distinct(), name)
    state = _print(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"),
                                                           F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"),
                                                    F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        edges = cut(small, name)
        now = _print(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


__all__ = ["components"]
