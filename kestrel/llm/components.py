"""Connected components by alternating large-star / small-star rounds.

Every round is two shuffles of the edge list and nothing else; no node's
neighbourhood is gathered anywhere: the minimum neighbour is a partial
aggregate, and joining it back is an equi-join that adaptive execution can
split for a hub.  Rounds grow with the logarithm of the longest chain.  Each
round's edges are written to the shared checkpoint folder, and the table of
the round before is dropped once its successor stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.store import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the smallest one.  ``large``: every strictly larger
    neighbour of u goes to min(N(u), u); else the smaller ones, and u itself."""
    if large:
        pairs = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = pairs.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any orderable type -> ``(node, component)`` with the smallest
    reachable node, for every node of an edge between two different nodes.

    Nulls, self-loops and repeated or reversed edges carry no information and are
    dropped; without edges the result is empty.
    """
    scratch = Scratch(edges.sparkSession)
    clean = (edges.where("a is not null and b is not null and a != b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now, mark = scratch.write(clean), None
    while True:
        # Equal count and checksum of the (distinct) star edges: nothing moved.
        state = now.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == mark:
            break
        mark = (state["n"], state["h"])
        after = scratch.write(_star(_star(now, True), False))
        scratch.drop(now)
        now = after
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
