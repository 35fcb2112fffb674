"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.scratch import stage


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to its smallest neighbour."""
    both = _both(links)
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    joined = both.where("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them.

    Takes and returns links whose ``a`` is the larger end.
    """
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b != least").select(F.col("b").alias("a"), "least")
    return moved.union(least.select("a", "least")).distinct().toDF("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, component): for each end of a link, the smallest vertex it reaches.

    ``links`` has the columns a and b, both long. Alternating large and small
    stars ends after few rounds, each a handful of aggregations and joins
    whose hot vertices combine on the map side or are split by AQE. The links
    of a round are stored, so lineage stays short.
    """
    links = (
        links.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    links, before = stage(links, "links"), None
    while True:
        links = stage(_small_star(_large_star(links)), "links")
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
