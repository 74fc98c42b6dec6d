"""Re-creating a first-generation set: fixed fans of frames and the first rows of each path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.operators.scenes import first_rows, long_tracks

# Rows per path, and the frame step of the recording.
PATH_ROWS, FRAME_STEP = 20, 10


def long_starts(tracks: DataFrame, rows: int = PATH_ROWS) -> DataFrame:
    """First frame of every pedestrian with at least ``rows`` rows."""
    return (tracks.groupBy("dataset", "pedestrian").agg(F.count("*").alias("n_rows"), F.min("frame").alias("start"))
            .where(F.col("n_rows") >= rows))


def frame_fan(starts: DataFrame, rows: int = PATH_ROWS, step: int = FRAME_STEP) -> DataFrame:
    """Distinct frames start, start + step, … over one path length from every start."""
    fan = F.sequence(F.col("start"), F.col("start") + F.lit((rows - 1) * step), F.lit(step).cast("bigint"))
    return starts.select("dataset", "start").distinct().select("dataset", F.explode(fan).alias("frame")).distinct()


def originals(tracks: DataFrame, rows: int = PATH_ROWS, step: int = FRAME_STEP) -> DataFrame:
    """The first ``rows`` rows, on fan frames, of the pedestrians with that many of them."""
    good = tracks.join(frame_fan(long_starts(tracks, rows), rows, step), ["dataset", "frame"], "left_semi").select(tracks.columns)
    return first_rows(long_tracks(good, rows), rows)
