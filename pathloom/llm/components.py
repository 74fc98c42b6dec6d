"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.storage import freeze


def _least(links: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest node among itself and its neighbours ``v``. Combined before
    the shuffle, so a node with very many links stays one small row per task."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def star_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``, except the roots themselves:
    root is the smallest node of the component.

    Every round is an aggregation by node and a join with it, whose hot sides adaptive
    execution can split; nothing is gathered per node or on the driver. Rounds end when the
    links no longer change: about the logarithm of the longest chain.
    """
    links = freeze(links.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct())
    before = _state(links)
    while before[0]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = freeze(large.where("u <> v").distinct())  # every link points to a smaller node
        least = _least(large)
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        links = freeze(small.where("a <> b").distinct())
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
