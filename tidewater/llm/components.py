"""Connected components by alternating stars, with joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (`large`: those above it, else those up to it) move to the smallest node near it."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(least, "a")
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (a, b: long): root is the smallest node of its component.

    Nodes with edges only. Ends when no edge moves any more: a number of rounds that grows with the
    logarithm of the largest component. Each round is written, so that plans stay short.
    """
    edges = staged(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct())
    state = None
    while True:
        # Edges run from the larger to the smaller node, so that stars are known as such from the first.
        new = edges.agg(F.count("*"), F.sum(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(38,0)"))).head()
        if tuple(new) == state:
            break
        state = tuple(new)
        edges = staged(_stars(_stars(edges, large=True), large=False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
