"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mattone.llm.scratch import written


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of ``links(a, b)``; component is the smallest id reachable.

    Each round points every node's larger neighbours, then its smaller ones, at the
    smallest one; a path shrinks by a constant factor per round.  Only the two numbers
    that tell whether a round changed anything come to the driver.
    """
    stars = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    before = _state(stars)
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a")
        stars = written(
            small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(small.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "stars"
        )
        after = _state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).union(stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
