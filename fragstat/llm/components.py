"""Connected components of a link table, by alternating star contractions.

Each round joins every node's links with the smallest node among them (large
star), then does the same towards smaller nodes only (small star).  Paths
shrink geometrically, and no node's links ever come together in one task: a
node's minimum is a partial aggregation, and the links meet it by a join that
may be split when a node has very many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(links: DataFrame) -> DataFrame:
    """(u, v) links, u > v, to (v, smallest neighbour of u, or u) for each."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = _star(both).select("u", "v", F.least("u", "m").alias("m"))
    return starred.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    starred = _star(links)  # every u > v
    kept = starred.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(starred.select("u", F.col("m").alias("v")))


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link; the root is the smallest
    node of the component.  Nodes may be of any type that orders; links to
    itself, repeated links and null nodes are ignored."""
    at_first = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint()
    links, last = at_first, None
    while True:
        now = _print(links)
        if now == last or not now[0]:
            break
        last = now
        links = _small_star(_large_star(links).distinct()).where("u != v").distinct().checkpoint()
    # Stars now: every node that is no root has one link, to its root.
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
