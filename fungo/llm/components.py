"""Connected components of a table of links, by alternating large and small stars.

Each step joins links with the least neighbour of a node, found by a partial aggregation; a node with
many links is split by the join and never gathered. Links do not grow in number beyond those given, and
the steps grow with the logarithm of the longest chain, not with its length. Every step is
written to the shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fungo.session import materialize


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the least of the node and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
    least = _least(both).select("w", F.least("w", "m").alias("m"))
    tied = both.join(least, F.col("u") == F.col("w")).where(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the least of these."""
    least = _least(links)
    tied = links.join(least, F.col("u") == F.col("w"))
    moved = tied.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    """The same for equal sets of links, and almost surely only for these."""
    row = links.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.bit_xor(F.xxhash64("v", "u")),
    ).first()
    return tuple(row)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``root`` for every node of a link; the root is the least node of its component.

    Links may repeat and point either way; links with a null or from a node to itself are ignored.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    links = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = materialize(links, "links")
    before = _state(links)
    while True:
        links = materialize(_small_star(_large_star(links)), "stars")
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
