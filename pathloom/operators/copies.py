"""Copies of whole tracks.

A recording that was merged in many times shows the same track under many ids. All copies
are near each other all the time, so comparing them pair by pair is quadratic, and
useless: what holds for one of them holds for all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.config import NO_HOT_ROWS
from pathloom.storage import freeze

PERSON = ["dataset", "split", "pedestrian"]


def copies(tracks: DataFrame, most: int) -> DataFrame | None:
    """The pedestrians (``dataset, split, pedestrian``) of groups of more than ``most`` equal
    tracks, with the first of the group as ``leader``; None if there is no such group.

    Number of rows and two 64-bit hash sums, which combine on the map side, tell which tracks may be equal, and only one row
    per pedestrian is moved for that. The members found are then compared with their leader row by row.
    """
    if most >= NO_HOT_ROWS:
        return None
    total = lambda *columns: F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))
    prints = tracks.groupBy(*PERSON).agg(F.count("*").alias("_n"), total("frame", "x", "y").alias("_a"),
                                         total(F.lit(1), "y", "x", "frame").alias("_b"))
    same = ["dataset", "split", "_n", "_a", "_b"]
    groups = (prints.groupBy(*same).agg(F.count("*").alias("_size"), F.min("pedestrian").alias("leader"))
              .where(F.col("_size") > most).drop("_size"))
    if groups.isEmpty():
        return None
    return _alike(tracks, freeze(prints.join(groups, same).select(*PERSON, "leader")))


def _alike(tracks: DataFrame, members: DataFrame) -> DataFrame:
    """The members whose rows are those of their leader. As both have equally many, none may be missing there."""
    place = ["dataset", "split", "leader", "frame", "x", "y"]
    rows = tracks.join(members, PERSON).groupBy(*place, "pedestrian").agg(F.count("*").alias("_n"))
    own = rows.where(F.col("pedestrian") == F.col("leader")).select(*place, F.col("_n").alias("_own"))
    equal = rows.join(own, place, "left").groupBy(*PERSON, "leader").agg(F.bool_and(F.coalesce(F.col("_n") == F.col("_own"), F.lit(False))).alias("_equal"))
    return equal.where("_equal").drop("_equal")


def without_followers(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of everybody but the copies that are not the first of their group."""
    return rows.join(members.where(F.col("pedestrian") != F.col("leader")), PERSON, "left_anti")
