"""Connected components of an edge table, without collecting edges or nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any comparable type -> ``(node, root)`` for every node
    that has an edge to another one; ``root`` is the smallest node it reaches.

    Alternates large-star and small-star steps, each an aggregation and a join,
    until the edges no longer change: then every node points at its root.  Every
    round is checkpointed, so a lost executor costs at most one round.  The joins
    are merge joins: no round broadcasts rows, which would pass the driver.  Self
    loops, nulls and repeated edges are ignored.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    state = (edges.where(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .distinct().checkpoint())
    seen = _digest(state)
    while seen[0]:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low.hint("merge"), "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low.hint("merge"), "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where(F.col("u") != F.col("v")).distinct())
        state = small.checkpoint()
        now = _digest(state)
        if now == seen:
            break
        seen = now
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _digest(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum of their hashes."""
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]
