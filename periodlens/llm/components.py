"""Connected components of a graph of links by alternating large-star and small-star steps.

Each step hooks the neighbours of a node to the least of them; the links end up as stars around the
least node of each component.  A step takes the minimum a node (aggregated before the shuffle) and
joins it back; the joined side has one row a node, so a node with very many links is split by
Spark's skew handling, never gathered.  Every round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link to another; component is its least node.

    Links to itself, repeated links and null ends are dropped; an empty table gives an empty one.
    """
    edges = (links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    edges = stored(edges, "links")
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("low")).withColumn("low", F.least("low", "v"))
        # large star: every greater neighbour of v is hooked to v's least neighbour
        large = (both.where("m > v").join(least, "v").select(F.col("m").alias("v"), F.col("low").alias("m"))
                 .where("v <> m").distinct())
        # small star: v and its lesser neighbours are hooked to the least of them
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = (large.join(low, "v")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("v"), F.col("low").alias("m")),
                                           F.struct(F.col("m").alias("v"), F.col("low").alias("m")))).alias("e"))
                 .select("e.v", "e.m").where("v <> m").distinct())
        edges = stored(small, "links")
        # done when every node has one hook and no hook is itself hooked
        roots = edges.select(F.col("m").alias("v")).distinct().withColumn("root", F.lit(1))
        state = (edges.groupBy("v").agg(F.count("*").alias("n")).join(roots, "v", "left")
                 .agg(F.max("n").alias("n"), F.max("root").alias("root")).first())
        if (state["n"] or 1) == 1 and not state["root"]:
            break
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    return edges.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(
        edges.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct())
