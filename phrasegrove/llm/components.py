"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.sources.shared import cut_lineage


def _stars(links: DataFrame) -> bool:
    """Whether every ``u`` has one smaller neighbour ``v``, and that has none: ``v`` is the smallest."""
    up, down = links.select(F.col("u").alias("x"), F.lit(1).alias("up")), links.select(F.col("v").alias("x"), F.lit(0).alias("up"))
    seen = up.union(down).groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node each linked node can reach: rows ``(node, component)``.

    Alternates two steps until only stars are left: every node sends its larger neighbours to
    its smallest one, then every node sends its smaller neighbours and itself there. Both
    keep the components and shorten the paths, so the rounds grow with the logarithm of the
    longest path. Rows of an earlier answer are links as well: with further links they give the
    new answer in few rounds. A round groups by node and aggregates a minimum before it joins, so a node
    with very many links is spread by the skew join. Nulls and loops are ignored; without
    links the result is empty.
    """
    nodes = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    links = cut_lineage(nodes.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _stars(links):
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.where("u <> v").distinct())
        # Small star: u and its smaller neighbours go to the smallest of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u <> v")
        links = cut_lineage(small.distinct())
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
