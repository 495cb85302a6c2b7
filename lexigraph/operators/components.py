"""Connected components of an edge table of any size.

Alternates two steps until the edges no longer change: in the large step every node's larger neighbours move to its smallest
neighbour, in the small step its smaller ones do. The result is a star around each component's smallest node. Minima are
pre-aggregated before the shuffle and joined back, so that a node with very many edges is no single task's group (adaptive
execution can split such a join), and each step is written to the shared folder, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import cut, drop_cut


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    # edges hold the larger node in u
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v")))


def connected(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Edges with a null end and edges from a node to itself link nothing, and a node with no other edge has no row. Repeated
    edges count once.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = cut(edges.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        after = cut(_small(_large(now).filter("u != v").distinct()).filter("u != v").distinct(), "edges")
        drop_cut(now)
        now = after
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(got) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = tuple(got)
    raise RuntimeError("components did not settle")
