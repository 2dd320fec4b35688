"""Connected components of a graph of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import stored


#: Links that one task of a round takes at least; fewer tasks make fewer and larger files.
TASK_LINKS = 100_000


def _packed(edges: DataFrame, count: int) -> DataFrame:
    return edges.coalesce(max(1, count // TASK_LINKS))


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node that has a link; the component is its smallest node.

    ``links`` has two columns of one ordered type, one row per link in either direction. Null ends
    and links of a node to itself are ignored. Alternating large-star and small-star rounds: a hub
    is met only as the key of a minimum, which is combined before the shuffle, and of a join that
    adaptive execution can split. The number of rounds grows with the logarithm of the diameter.
    """
    a, b = links.columns[:2]
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = stored(edges.where("u <> v").distinct(), "links")
    seen = None
    while (now := _checksum(edges)) != seen:
        seen = now
        edges = stored(_packed(_small_star(_large_star(edges).distinct()), now[0]), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
