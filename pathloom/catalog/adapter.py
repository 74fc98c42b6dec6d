"""Inputs of the registered queries, derived from the given tables.

The given tables hold no positions, so each user becomes a pedestrian that moves one
step per event. Everything is summed in whole centimetres, so the values do not depend
on the order of additions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.operators.ordered import running_totals
from pathloom.storage import freeze


def make_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, pedestrian, frame, xc, yc), positions in centimetres."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("user_id").alias("pedestrian"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    event, user, k = F.col("event_id"), F.col("pedestrian"), F.col("k")
    steps = running_totals(events, ["pedestrian"], "at", {
        "rn": F.lit(1),
        "pauses": F.when(event % 40 == 0, 1).otherwise(0),
        "dx": 2 * (k - 45) + 20 * (user % 5 - 2),
        "dy": 7 * (event % 11) - 35,
    }, ["event_id"], block_bits=32)
    return steps.select(
        "event_id", "pedestrian",
        (10 * ((user * 37) % 500 + F.col("rn") - 1) + 30 * F.col("pauses")).cast("bigint").alias("frame"),
        ((user % 16) * 1000 + F.col("dx")).cast("bigint").alias("xc"),
        (F.floor(user / 16) % 8 * 1000 + F.col("dy")).cast("bigint").alias("yc"))


# Track positions are the walk's divided by this: a denser crowd than whole metres give.
UNITS = 400.0


def tracks_of(walked: DataFrame, recordings: int = 2, units: float = UNITS) -> DataFrame:
    """The walk as a track table over one or two recordings (the second has two thirds)."""
    third = F.when(F.col("pedestrian") % 3 == 0, "plaza").otherwise("street")
    return walked.select(
        (third if recordings == 2 else F.lit("plaza")).alias("dataset"), "frame", "pedestrian",
        (F.col("xc").cast("double") / units).alias("x"), (F.col("yc").cast("double") / units).alias("y"))


_stored: dict[tuple, DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table several queries read, written once per session and input files."""
    files = spark.read.format("binaryFile").load(f"{sf_dir}/events.parquet").select("path", "modificationTime", "length")
    key = (spark.sparkContext.applicationId, name, tuple(sorted(tuple(f) for f in files.collect())))
    if key not in _stored:
        _stored[key] = freeze(build())
    return _stored[key]


def walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "walk", lambda: make_walk(spark, sf_dir))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "tracks", lambda: tracks_of(walk(spark, sf_dir)))
