"""Checks and clean-up of simulated crowds.

Rows are (dataset, scene, pedestrian, step, x, y); ``pedestrian`` counts from 0 in each
scene and ``step`` 0 is the starting point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.config import HOT_ROWS, SEGMENT_ROWS
from pathloom.functions.geometry import dist2, turns_back
from pathloom.operators.ordered import piece_window, running_totals, segments
from pathloom.operators.pairs import nearby

# A goal counts as reached within this distance; simulation steps per
# kept row (100 per second down to 2.5); closest starts of a scene in the two set-ups.
END_RANGE = 1.0
SAMPLING_RATE = 40
START_DISTANCE, START_DISTANCE_SMALL = 2.0, 0.8

SCENE = ["dataset", "scene"]
AGENT = ["dataset", "scene", "pedestrian"]


def smooth_scenes(rows: DataFrame, check_last: bool = False, hot_rows: int = HOT_ROWS, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Per scene, ``smooth``: no angle below 90 degrees at an inner point. The last triple
    of a path is only looked at with ``check_last``. A repeated point has no angle."""
    pieces = segments(rows, AGENT, "step", after=3, hot_rows=hot_rows, segment_rows=segment_rows)
    w = piece_window(AGENT, "step")
    ahead = {k: F.lead(F.struct("x", "y"), k).over(w) for k in (1, 2, 3)}
    triples = pieces.select(*AGENT, "own", "x", "y", *[c.alias(f"p{k}") for k, c in ahead.items()])
    inner = F.col("p2").isNotNull() if check_last else F.col("p3").isNotNull()
    sharp = turns_back((F.col("x"), F.col("y")), (F.col("p1.x"), F.col("p1.y")), (F.col("p2.x"), F.col("p2.y")))
    return triples.groupBy(*SCENE).agg((~F.coalesce(F.bool_or(F.col("own") & inner & sharp), F.lit(False))).alias("smooth"))


def with_goal_range(rows: DataFrame, goals: DataFrame, end_range: float = END_RANGE) -> DataFrame:
    """Add ``reached``: the row is within ``end_range`` of the pedestrian's goal."""
    near = dist2(F.col("x"), F.col("y"), F.col("gx"), F.col("gy")) < F.lit(end_range * end_range)
    return rows.join(goals.select(*AGENT, "gx", "gy"), AGENT).select(*rows.columns, near.alias("reached"))


def trim_at_goal(rows: DataFrame, goals: DataFrame, end_range: float = END_RANGE) -> DataFrame:
    """Rows of a pedestrian up to the one that first reaches its goal; where it starts does not
    count. To be applied to full-rate rows. The first such step is a plain minimum, so no
    window is needed."""
    near = with_goal_range(rows, goals, end_range)
    first = near.where("reached AND step > 0").groupBy(*AGENT).agg(F.min("step").alias("_first"))
    return (rows.join(first, AGENT, "left").where(F.col("_first").isNull() | (F.col("step") <= F.col("_first")))
            .select(*rows.columns))


def done_scenes(rows: DataFrame, goals: DataFrame, end_range: float = END_RANGE) -> DataFrame:
    """Per scene, ``done``: at some step all its pedestrians are at their goals together."""
    near = with_goal_range(rows, goals, end_range).where(F.col("step") > 0)
    # A step with all of them there has one reached row per pedestrian.
    by_step = near.groupBy(*SCENE, "step").agg(F.count_if("reached").alias("_there"))
    most = by_step.groupBy(*SCENE).agg(F.max("_there").alias("_there"))
    # One row per pedestrian first, so that nothing is counted distinct in one task.
    crowd = rows.select(*AGENT).distinct().groupBy(*SCENE).agg(F.count("*").alias("_all"))
    return crowd.join(most, SCENE, "left").select(
        *SCENE, F.coalesce(F.col("_there") == F.col("_all"), F.lit(False)).alias("done"))


def downsample(rows: DataFrame, rate: int = SAMPLING_RATE, phase: int = 1) -> DataFrame:
    """Drop the starting point and keep every ``rate``-th step, counted from ``phase``: 1 for
    tracks, 0 for forecasts."""
    return rows.where((F.col("step") > 0) & (F.pmod(F.col("step") - phase, F.lit(rate)) == 0))


def valid_scenes(rows: DataFrame, goals: DataFrame, check_last: bool = False, rate: int = SAMPLING_RATE, **sizes) -> DataFrame:
    """Scenes that are done and whose kept paths are smooth."""
    kept = downsample(trim_at_goal(rows, goals), rate)
    smooth = smooth_scenes(kept, check_last, **sizes).where("smooth").select(*SCENE)
    return done_scenes(rows, goals).where("done").select(*SCENE).join(smooth, SCENE, "left_semi")


def scene_offsets(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per scene, the number of pedestrians in all earlier scenes of its dataset."""
    sizes = rows.select(*AGENT).distinct().groupBy(*SCENE).agg(F.count("*").alias("_peds"))
    upto = running_totals(sizes, ["dataset"], "scene", {"_upto": F.col("_peds")}, hot_rows=hot_rows)
    return upto.select(*SCENE, (F.col("_upto") - F.col("_peds")).alias("offset"))


def offset_ids(rows: DataFrame, all_rows: DataFrame, frame: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Make ids unique across scenes. Every scene of ``all_rows`` uses up ids, also one
    that did not make it into ``rows``; frames count from ``frame`` in each scene."""
    offsets = scene_offsets(all_rows, hot_rows)
    return rows.join(offsets, SCENE).select(
        *SCENE, (F.col("step") + F.lit(frame)).alias("frame"), (F.col("pedestrian") + F.col("offset")).alias("pedestrian"), "x", "y")


def start_clashes(starts: DataFrame, min_dist: float = START_DISTANCE) -> DataFrame:
    """Pairs of a scene where the later pedestrian starts too near the earlier one's start or
    goal. ``starts`` is (dataset, scene, pedestrian, x, y, gx, gy)."""
    own = starts.select(*AGENT, "x", "y")
    goal = starts.select(*AGENT, F.col("gx").alias("x"), F.col("gy").alias("y"))
    near = nearby(own, own.unionByName(goal), min_dist, SCENE)
    return (near.where((F.col("other") < F.col("pedestrian")) & (F.col("d2") < F.lit(min_dist * min_dist)))
            .select(*AGENT, "other").distinct())
