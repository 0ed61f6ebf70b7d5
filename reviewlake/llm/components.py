"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlake.operators.placement import stage


def _least(directed: DataFrame) -> DataFrame:
    """(u, least): the smallest of each node's neighbours, by an aggregate with map-side reduction."""
    return directed.groupBy("u").agg(F.min("v").alias("least"))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round. Large: greater neighbours move to the node's minimum. Small: the node and its smaller neighbours do.

    ``links`` holds (u, v) with u > v.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = stage(_least(both).select("u", F.least("u", "least").alias("least")), "star_least")
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        least = stage(_least(links), "star_least")
        moved = (
            links.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(least.select("u", F.col("least").alias("v")))
        )
    return moved.where("u > v").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component: the smallest node reachable.

    Each round is written to the shared folder, so a lost executor costs one round. The rounds end when
    every node points at a node that points nowhere, which an anti-join decides; nothing but counts
    reaches the driver. A NULL in a link is ignored; a table without links gives no rows.
    """
    current = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a <> b").distinct()
    current = stage(current, "links")
    for _ in range(most_rounds):
        chained = current.select(F.col("u").alias("v")).distinct()
        forked = current.groupBy("u").count().where("count > 1")
        if current.join(chained, "v", "left_semi").isEmpty() and forked.isEmpty():
            break
        current = stage(_star(stage(_star(current, large=True), "large_star"), large=False), "small_star")
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    own = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
