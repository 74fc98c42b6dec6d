"""From simulated crowds to a track table with goals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.config import SceneConfig
from pathloom.operators.synth import SAMPLING_RATE, SCENE, downsample, offset_ids, scene_offsets, trim_at_goal, valid_scenes

# The settings recommended for simulated crowds.
SYNTHETIC = SceneConfig(linear_threshold=0.3, acceptance=(0.0, 0.0, 1.0, 0.0))


def crowd_tracks(rows: DataFrame, goals: DataFrame, frame: int = 0, rate: int = SAMPLING_RATE) -> tuple[DataFrame, DataFrame]:
    """Tracks and goals of the valid scenes, both with ids unique over all scenes.

    ``rows`` is (dataset, scene, pedestrian, step, x, y) at full rate, of which every
    ``rate``-th step is kept; ``goals`` is
    (dataset, scene, pedestrian, gx, gy).
    """
    valid = valid_scenes(rows, goals, rate=rate)
    kept = downsample(trim_at_goal(rows, goals), rate).join(valid, SCENE, "left_semi")
    # Kept steps are numbered again from 0.
    kept = kept.withColumn("step", F.floor((F.col("step") - 1) / rate))
    tracks = offset_ids(kept, rows, frame).select("dataset", "frame", "pedestrian", "x", "y")
    aims = (goals.join(valid, SCENE, "left_semi").join(scene_offsets(rows), SCENE)
            .select("dataset", (F.col("pedestrian") + F.col("offset")).alias("pedestrian"), "gx", "gy"))
    return tracks, aims
