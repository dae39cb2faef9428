"""Connected components by alternating large-star and small-star rounds.

Every round is a distributed join and two aggregates; its edges are written to
the shared folder, so a lost executor costs one round at most, and only two
numbers (edge count, checksum) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlens.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # edges point from the larger to the smaller node
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(low, "u")
    return (joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) links -> (node, root): root is the smallest node of the component.
    Nodes without a link are absent."""
    down = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    cur, step, seen = scratch.table(down, "cc_0"), 0, None
    while True:
        nxt = scratch.table(_small_star(_large_star(cur)), f"cc_{step + 1}")
        state = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        scratch.drop(f"cc_{step}")
        cur, step = nxt, step + 1
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
