"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialise


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    large = (
        both.join(least, "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return (
        small.filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", "m"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node that has an edge to another; the label is its component's smallest node.

    ``edges`` has two columns of one sortable type. Every round is written to the work
    folder, so lineage stays short, and only a count and a checksum reach the driver. The
    number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns
    edges = edges.select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).filter("a <> b")
    edges, before = materialise(edges.distinct(), "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            break
        edges, before = materialise(_stars(edges), "edges"), now
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        .union(edges.select("b", "b").distinct())
    )
