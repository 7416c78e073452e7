"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a long, b long); component is its smallest node.

    Each round hangs larger neighbours of a node on its smallest neighbour (large star), then smaller
    ones too (small star). Both keep connectivity, and the links shrink to stars in a number of rounds
    that grows with the logarithm of the data. Every round is written to the shared folder; it ends when number and checksum of the links stay. Links
    from a node to itself and null ends are ignored; no links give no rows.
    """

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
