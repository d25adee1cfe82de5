"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.storage import fresh_path, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the component's smallest node.

    Each round points neighbours at the smallest node they know of, first those above a node, then
    those below. Rounds grow with the logarithm of a component's width. A round's edges are a table
    in the shared folder, so a lost executor costs one round's tasks. Nulls, loops and repeated
    edges are dropped; no edges give no rows.
    """
    spark = edges.sparkSession
    links = edges.filter("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    links = stage(links, fresh_path(spark, "links"))
    seen = None
    # stops when a round changes nothing, at once without edges
    while (state := _state(links)) not in (seen, (0, None)):
        seen = state
        links = stage(_pull_below(_pull_above(links)), fresh_path(spark, "links"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.selectExpr("u AS node", "v AS root").unionByName(roots)


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _pull_above(links: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the smallest node around it."""
    both = links.unionByName(links.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").selectExpr("v AS u", "m AS v").filter("u <> v").distinct()
    )


def _pull_below(links: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, go to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").selectExpr("v AS u", "m AS v")
    return moved.unionByName(least.selectExpr("u", "m AS v")).distinct()
