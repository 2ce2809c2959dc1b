"""Connected components of a graph whose links may outgrow any one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfares.settings import keep


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`(id, component_id)` of every id in a link: the smallest id its links lead to.

    Alternates the large-star and small-star steps, which replace links and never add any, until
    nothing changes. Only sums of the link table reach the driver. A hub's links are aggregated
    before they are shuffled, and the joins on them are left to the adaptive skew join. Links with
    a null end, and links of an id to itself, say nothing and are dropped.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = keep(links.where("u > v").distinct(), "links")
    before = _digest(links)
    while True:
        links = keep(_small_star(_large_star(links)), "links")
        after = _digest(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionAll(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    # A node without smaller neighbours is its own smallest.
    moved = links.join(smallest.select(F.col("u").alias("v"), "m"), "v", "left")
    return moved.select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(smallest.select("u", F.col("m").alias("v"))).distinct()


def _digest(links: DataFrame) -> tuple:
    # The high halves of the hashes, so that their sum cannot overflow.
    total = F.sum(F.shiftright(F.xxhash64("u", "v"), 32))
    return tuple(links.agg(F.count("*"), total).first())
