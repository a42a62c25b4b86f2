"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import drop_stored, stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of them and itself."""
    both = _both_ways(links)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of the links ``u, v``; the root is the smallest node.

    Each round shuffles the links and keeps one smallest neighbour per node; a node with many
    links is an aggregate, not a list. The number of rounds grows with the logarithm of the
    longest path.
    """
    now = stored(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        following = stored(_small_star(_large_star(now)).where("u != v").distinct())
        drop_stored(now)
        now, before, state = following, state, _state(following)
        if state == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(links: DataFrame) -> tuple:
    """Changes if any link does."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(h)).first())
