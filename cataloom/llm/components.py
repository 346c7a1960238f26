"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``links`` (``u``, ``v`` long).

    Alternates two steps until nothing changes: each node hands its larger neighbours to its smallest
    one, then its smaller ones. The number of rounds grows with the logarithm of the longest chain. Every
    round is written to the shared folder, so no lineage builds up. Links with a null or to the node itself
    say nothing; no links give no rows.
    """
    edges = stage(_oriented(links.where("u is not null and v is not null")))
    before = _mark(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)))
        after = _mark(edges)
        if after == before:
            break
        before = after
    # a forest of stars: every edge leads from a node to the smallest of its component
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _oriented(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    met = edges.join(least, "u")
    return _oriented(met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", "m")))
