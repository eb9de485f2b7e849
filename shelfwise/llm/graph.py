"""Connected components of an edge table, by alternating stars on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint"))).first())


def _to_least(edges: DataFrame, among_larger: bool) -> DataFrame:
    """Each node's neighbours (only the larger, or only the smaller ones) linked to its least neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if among_larger else edges
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    linked = both.join(least, "a")
    if among_larger:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        own = least.select("a", F.col("least").alias("b"))
        out = linked.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link to another one; a component is named by its least node.

    ``edges`` has columns a and b of one orderable type. Each round is written to the shared folder. No node's
    neighbours are gathered in a row: minima are aggregated before the shuffle, and the join back is
    one to many, which adaptive execution may split.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    now = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(now)
    while state[0]:
        now = stored(_to_least(_to_least(now, True), False), "links")
        before, state = state, _state(now)
        if state == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component")).distinct()
