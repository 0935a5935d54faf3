"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import cut


def _stars(edges: DataFrame, lowest: DataFrame, centre: str, leaf: str) -> DataFrame:
    return edges.join(lowest, centre).select(F.col(leaf).alias("a"), F.col("m").alias("b")).where("a != b")


def components(links: DataFrame) -> DataFrame:
    """Components of an undirected graph given as links (``a``, ``b``).

    Returns (``node``, ``root``): every node that can reach a smaller one, with
    the smallest it can reach.  In each round every node hangs its larger
    neighbours on its smallest one, and then its smaller ones; the rounds grow
    with the logarithm of a component's width.  Only minima are gathered, never
    a node's neighbours, and each round's links are written to the shared
    checkpoint folder.  No links give an empty table."""
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "links")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "low")
        large = cut(_stars(both.where("b > a"), low, "a", "b").distinct(), "large")
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = _stars(large, low, "a", "b").unionAll(low.select("a", F.col("m").alias("b")))
        edges = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new
