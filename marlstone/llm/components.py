"""Connected components of a table of links, by alternating stars (Kiveris et al., Connected components in MapReduce)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import Scratch

MOST_ROUNDS = 60


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component (the smallest node reachable) of every node in links(a, b).

    Each round links every node's larger neighbours, then its smaller ones, to the smallest of them, by a grouped
    minimum and an equi-join; links stay as many as nodes. Nothing is collected but the number of rows that changed.
    """
    edges = scratch.cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = scratch.cut(small)
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("u")).first()
        # a star forest: every node has one link, to its root, and no root has one
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return scratch.cut(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots))
