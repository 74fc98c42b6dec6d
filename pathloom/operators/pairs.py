"""Scenes against the other pedestrians around them.

A busy frame can hold a large share of all rows, and pairing everybody in it would be
quadratic. Wherever only near pedestrians matter, the pairs come from an equi-join on
frame and grid cell, so distant ones never meet; a crowded cell is left to the
skew-join splitting of adaptive execution. Where all pairs are the result, the join is
dealt to tasks by the pairs it makes (``meet``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.config import SceneConfig
from pathloom.functions.draws import jitter, key_text
from pathloom.functions.geometry import dist2, grid_cell
from pathloom.storage import broadcast_if_small, freeze

SCENE = ("dataset", "split", "scene", "pedestrian")
FRAME = ("dataset", "split", "frame")

# Pairs that one task may make, as far as the number of tasks below allows.
TASK_PAIRS = 250_000
MOST_TASKS = 2_000

# Pairs of one frame or cell above which it is dealt to several tasks.
SHARE_PAIRS = 20_000_000


def frames_of(scenes: DataFrame) -> Column:
    """The frames of a scene, which a typed one has instead of its path."""
    return F.col("frames" if "frames" in scenes.columns else "path.frame")


def scene_steps(scenes: DataFrame, first: int, last: int, more: Sequence[str] = ()) -> DataFrame:
    """One row per scene and place ``first`` <= i < ``last``: the position of the primary
    and, as ``pframe, px, py``, the one before (NULL at place 0). ``more`` columns are kept."""
    at, before = F.get("path", F.col("i")), F.get("path", F.col("i") - 1)
    return (scenes.select(*SCENE, *more, "path", F.explode(F.sequence(F.lit(first), F.lit(last - 1))).alias("i"))
            .select(*SCENE, *more, "i", at["frame"].alias("frame"), at["x"].alias("x"), at["y"].alias("y"),
                    before["frame"].alias("pframe"), before["x"].alias("px"), before["y"].alias("py")))


def scene_paths(scenes: DataFrame, tracks: DataFrame, radius: float | None = None) -> DataFrame:
    """Rows of a scene in long form: the pedestrians seen at one of the frames of the
    primary, with ``t``, the place of that frame, and ``is_primary``.

    Without a ``radius`` that is everybody in the frame, so the result is scenes times
    crowd: a form to export a few scenes in. With one it is the rows that near to the
    primary, from a grid join.
    """
    steps = scenes.select(*SCENE, F.posexplode("path").alias("t", "p")).select(
        *SCENE, "t", F.col("p.frame").alias("frame"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    columns = ("dataset", "split", "scene", "pedestrian", "is_primary", "t", "frame", "x", "y")
    own = steps.withColumn("is_primary", F.lit(True)).select(*columns)
    if radius is None:
        others = (meet(steps.drop("x", "y").withColumnRenamed("pedestrian", "_primary"), tracks.select(*FRAME, "pedestrian", "x", "y"), FRAME)
                  .where(F.col("pedestrian") != F.col("_primary")))
    else:
        others = near_steps(steps, tracks, radius).select(
            "dataset", "split", "scene", F.col("other").alias("pedestrian"), "t", "frame", F.col("ox").alias("x"), F.col("oy").alias("y"))
    return own.unionByName(others.withColumn("is_primary", F.lit(False)).select(*columns))


def noisy_observations(scenes: DataFrame, tracks: DataFrame, config: SceneConfig, iterations: int = 5, thresh: float = 0.005,
                       radius: float | None = None) -> DataFrame:
    """What a re-simulation starts from: the observed rows of a scene (``scene_paths`` of its
    first ``obs_len`` places) once per iteration, both axes moved by at most ``thresh``. The
    draws hash dataset, scene, pedestrian, place, iteration and axis."""
    seen = scene_paths(scenes.withColumn("path", F.slice("path", 1, config.obs_len)), tracks, radius)
    # What the draws of a pair have in common is put together once.
    keyed = seen.withColumn("_key", key_text(config.seed, *[F.col(c) for c in ("dataset", "scene", "pedestrian", "t")]))
    each = F.array(*[F.struct(F.lit(i).alias("iter"), key_text(F.col("_key"), i).alias("key")) for i in range(iterations)])
    rows = keyed.withColumn("_draw", F.explode(each))
    moved = {axis: jitter(F.col(axis), thresh, F.col("_draw.key"), axis).alias(axis) for axis in ("x", "y")}
    return rows.select("dataset", "split", "scene", "pedestrian", "_draw.iter", "t", "frame", moved["x"], moved["y"])


def group_sizes(steps: DataFrame, others: DataFrame, on: Sequence[str]) -> DataFrame:
    """The groups that hold steps and people, with the number of both and of their pairs."""
    return (steps.groupBy(*on).agg(F.count("*").alias("_steps")).join(others.groupBy(*on).agg(F.count("*").alias("_others")), list(on))
            .withColumn("_pairs", F.col("_steps").cast("double") * F.col("_others")))


def meet(steps: DataFrame, others: DataFrame, on: Sequence[str], task_pairs: int = TASK_PAIRS, share_pairs: int = SHARE_PAIRS,
         by: str = "scene", least: int = 1, counted: DataFrame | None = None) -> DataFrame:
    """The join of the steps of scenes with people on the keys ``on``, for work that is all these pairs.

    Their number is no matter of the bytes of either side, so it is counted from the sizes of the
    groups, and tells the number of tasks, ``least`` at least. A group of more than ``share_pairs`` pairs is dealt to several
    tasks, by scene (or another column of the steps); each gets the people, but no more copies of them are made than there are steps.
    ``counted`` is a cheaper table with about as many people per group.
    """
    on = list(on)
    sizes = group_sizes(steps, others if counted is None else counted, on).withColumn(
        "_shares", F.least(F.ceil(F.col("_pairs") / share_pairs), F.ceil(F.col("_steps") / F.col("_others"))))
    pairs, shares = sizes.agg(F.sum("_pairs"), F.max("_shares")).first()
    if shares is not None and shares > 1:
        hot = freeze(sizes.where("_shares > 1").select(*on, "_shares"))
        of_group = F.coalesce(F.col("_shares"), F.lit(1).cast("bigint"))
        steps = steps.join(broadcast_if_small(hot), on, "left").withColumn("_share", F.pmod(F.xxhash64(by), of_group)).drop("_shares")
        others = others.join(broadcast_if_small(hot), on, "left").withColumn("_share", F.explode(F.sequence(F.lit(0).cast("bigint"), of_group - 1))).drop("_shares")
        return meet_in(steps, others, [*on, "_share"], pairs, task_pairs, least).drop("_share")
    return meet_in(steps, others, on, pairs, task_pairs, least)


def meet_in(steps: DataFrame, others: DataFrame, on: list[str], pairs: float | None, task_pairs: int, least: int = 1) -> DataFrame:
    tasks = max(least, min(MOST_TASKS, math.ceil((pairs or 0) / task_pairs)))
    return steps.repartition(tasks, *on).join(others.repartition(tasks, *on), on)


def near_steps(steps: DataFrame, tracks: DataFrame, radius: float) -> DataFrame:
    """``nearby`` for the steps of scenes, all pairs of which are the result. A row of a track is a step of many
    overlapping scenes, so here it is the tracks that are copied to the cells in reach."""
    size, reach = 2.0 * radius, F.lit(radius * (1 + 1e-9) + 1e-9)
    cells = lambda c: F.explode(F.sequence(grid_cell(F.col(c) - reach, size), grid_cell(F.col(c) + reach, size)))
    there = (tracks.select(*FRAME, F.col("pedestrian").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
             .withColumn("_gx", cells("ox")).withColumn("_gy", cells("oy")))
    here = steps.withColumn("_gx", grid_cell(F.col("x"), size)).withColumn("_gy", grid_cell(F.col("y"), size))
    return within(meet(here, there, (*FRAME, "_gx", "_gy")), radius)


def within(pairs: DataFrame, radius: float) -> DataFrame:
    """Those of the pairs that are two pedestrians at most ``radius`` apart, with their squared distance ``d2``."""
    return (pairs.where(F.col("other") != F.col("pedestrian"))
            .withColumn("d2", dist2(F.col("x"), F.col("y"), F.col("ox"), F.col("oy")))
            .where(F.col("d2") <= F.lit(float(radius) * float(radius)))
            .drop("_gx", "_gy"))


def nearby(steps: DataFrame, others: DataFrame, radius: float, on: Sequence[str] = FRAME, more: Sequence[str] = ()) -> DataFrame:
    """Pairs of a step and another pedestrian at most ``radius`` away in the same frame.

    Cells are two radii wide, so a step is copied to at most four of them. The result has
    all columns of the step plus ``other, ox, oy, d2`` and the columns ``more`` of the other.
    """
    on, size, reach = list(on), 2.0 * radius, F.lit(radius * (1 + 1e-9) + 1e-9)
    cells = lambda c: F.sequence(grid_cell(F.col(c) - reach, size), grid_cell(F.col(c) + reach, size))
    here = steps.withColumn("_gx", F.explode(cells("x"))).withColumn("_gy", F.explode(cells("y")))
    there = others.select(*on, *more, F.col("pedestrian").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"),
                          grid_cell(F.col("x"), size).alias("_gx"), grid_cell(F.col("y"), size).alias("_gy"))
    return within(here.join(there, [*on, "_gx", "_gy"]), radius)


def neighbors(scenes: DataFrame, tracks: DataFrame, radius: float, first: int, last: int) -> DataFrame:
    """Neighbours of the primaries within ``radius`` over the given places."""
    return near_steps(scene_steps(scenes, first, last), tracks, radius)


def frame_links(steps: DataFrame, tracks: DataFrame) -> DataFrame:
    """Moves of all pedestrians between the frame pairs (``pframe``, ``frame``) that the
    scenes step over: rows with both positions. The distinct pairs are few, so this is
    linear in the tracks, whatever the number of scenes."""
    pairs = steps.where(F.col("pframe").isNotNull()).select("dataset", "split", "pframe", "frame").distinct()
    after = tracks.select(*FRAME, "pedestrian", "x", "y")
    before = tracks.select("dataset", "split", F.col("frame").alias("pframe"), "pedestrian",
                           F.col("x").alias("px"), F.col("y").alias("py"))
    return after.join(pairs, list(FRAME)).join(before, ["dataset", "split", "pframe", "pedestrian"])
