"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import checkpointed


def _stars(links: DataFrame) -> DataFrame:
    """One round over links ``a > b``: every node hangs its neighbours on the least node it knows."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    large = both.join(least, F.col("a") == F.col("u")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    lower = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    small = large.join(lower, F.col("a") == F.col("u"))
    hung = small.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(lower.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the root is the least node of its component.

    The links of a round are checkpointed, so that the lineage stays short.  The number of rounds grows
    with the logarithm of the longest path; it ends when a round leaves the links as they are.
    """
    links = checkpointed(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        links = checkpointed(_stars(links))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b"), F.col("b")).distinct())
