"""Connected components of an undirected edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.staging import stage


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b): component is the smallest id reachable.

    Alternates two star steps: every node hangs its larger neighbours below its smallest one, then its smaller
    neighbours. The edge table never grows and is written once a round, so a lost executor repeats one round at
    most; the number of rounds follows the logarithm of the longest path. Hubs are met by partial aggregates and
    joins whose skewed partitions Spark can split, never by collecting a neighbour list.
    """
    def smallest(e: DataFrame, larger_only: bool) -> DataFrame:
        near = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if larger_only:
            near = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        if larger_only:  # small star: smaller neighbours and the node itself go below the smallest
            linked = near.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            linked = linked.union(low.select("a", F.col("m").alias("b")))
        else:  # large star: larger neighbours go below the smallest
            linked = near.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return linked.filter("a <> b").distinct()

    current = stage(edges.select("a", "b").filter("a <> b").distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        current = stage(smallest(smallest(current, False), True), "cc")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.sum("b")).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    members = current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    roots = current.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return members.union(roots)
