"""Connected components of a link table, by alternating stars.

Each round links every larger neighbour of a node to the smallest node around
it (large star) and then every smaller neighbour to the smallest one (small
star); components shrink to stars in a logarithmic number of rounds.  Minima
are taken by an aggregate, which combines map-side, and joined back by joins
that shuffle both sides, so a node with very many links is split over tasks.
The links of a round are written to the shared folder, so a lost executor
repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.common import stored


def _stars(links: DataFrame) -> DataFrame:
    """One round over links (u, v) with u > v."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("__u")).agg(F.least(F.min("v"), F.min("u")).alias("__m"))
    large = both.filter("v > u").join(least, F.col("u") == F.col("__u"), "inner")
    large = large.select(F.col("v").alias("u"), F.col("__m").alias("v")).distinct()
    low = large.groupBy(F.col("u").alias("__u")).agg(F.min("v").alias("__m"))
    small = large.join(low, F.col("u") == F.col("__u"), "inner")
    small = small.select(F.col("v").alias("u"), F.col("__m").alias("v")).filter("u <> v")
    return small.unionByName(low.select(F.col("__u").alias("u"), F.col("__m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "links")
    mark = None
    while True:
        # Order-free digest of the link set: unchanged means all stars.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = stored(_stars(edges), "stars")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
