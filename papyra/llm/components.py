"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.stored import stored


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(id, component)`` for each end of a link: the smallest id it reaches.

    The published large-star and small-star steps, repeated until nothing changes: each id passes
    the least id it knows of on to its larger, then to its smaller neighbours, until every
    component is a star around its least id. Steps are stored tables and their number grows with
    the logarithm of the size. Minima are formed before rows are shuffled, so an id with a third of
    all links is no burden.
    """
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges, before = stored(ends.distinct(), "links"), None
    while before != (state := _state(edges)):
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        large = stored(large.distinct(), "links")
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        least = least.select("high", F.col("m").alias("low"))
        edges, before = stored(least.union(small).distinct(), "links"), state
    stars = edges.select(F.col("high").alias("id"), F.col("low").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())


def _state(edges: DataFrame) -> tuple:
    """What two equal tables of links have in common."""
    mixed = F.bit_xor(F.xxhash64("high", "low"))
    return tuple(edges.agg(F.count("*"), mixed).first())
