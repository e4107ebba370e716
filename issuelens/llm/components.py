"""Connected components by alternating large stars and small stars (Kiveris et al.)."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from issuelens.llm.common import staged


def _star(pairs: DataFrame, grown: bool) -> DataFrame:
    """``pairs`` are (u, v); each u's neighbours are hung on the least of u and them."""
    # read back from files, so that the join below is of two plain shuffles, which Spark splits at a hot u
    least = staged(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    if grown:  # large star: neighbours above u
        return pairs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # small star: u itself and its neighbours, all below u
    hung = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v; long): the least node it is connected to.

    The number of rounds grows with the logarithm of a component's size; edges
    never grow beyond their first number and the nodes.  A node with very many
    edges is aggregated before it is shuffled and its join is one that Spark
    splits.  An empty table has no components.
    """
    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_star(both, True))
        edges = staged(_star(large, False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return hung.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
