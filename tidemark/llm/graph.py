"""Connected components of an edge table, distributed, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected edges (u > v). Each node's neighbours move to the smallest of them.

    The minimum of a node is a partial aggregate; the join with it is a plain equi-join, whose hot nodes
    adaptive execution splits.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    moved = both.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(ws: Workspace, edges: DataFrame, name: str = "cc") -> DataFrame:
    """(id, component) for every node that has an edge; component is the smallest id it can reach.

    ``edges`` has longs ``a`` and ``b``; self-loops, repeats and nulls are ignored. Runs until no edge moves;
    each round is written to the shared folder, so that lost executors cost one round at most.
    """
    cur = ws.put(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}0",
    )
    old, i = None, 0  # a round never has more edges than the one before
    while True:
        stat = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if stat == old or stat[0] == 0:
            break
        old, i = stat, i + 1
        cur = ws.put(_star(_star(cur, True), False), f"{name}{i}", 2 * stat[0])
        ws.drop(f"{name}{i - 1}")
    roots = cur.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
