"""Cutting tracks into scenes: fixed-length row windows of one primary pedestrian."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathloom.config import HOT_ROWS, SEGMENT_ROWS, SceneConfig
from pathloom.functions.geometry import dist2
from pathloom.operators.frames import frame_keys, frame_stats, split_place
from pathloom.operators.ordered import hot_groups, piece_window, segments, totals_in_order
from pathloom.operators.pairs import frames_of
from pathloom.storage import broadcast_if_small, freeze


def is_continuous(frames: Column, tolerance: float) -> Column:
    """The upper median of the frame steps, times the tolerance, exceeds every step."""
    size = F.size(frames)
    steps = F.sort_array(F.zip_with(
        F.slice(frames, F.lit(2), size - 1), F.slice(frames, F.lit(1), size - 1), lambda after, at: after - at))
    return F.get(steps, F.floor((size - 1) / 2).cast("int")) * F.lit(float(tolerance)) > F.try_element_at(steps, F.lit(-1))


def long_tracks(tracks: DataFrame, least: int) -> DataFrame:
    """Rows of the pedestrians that have at least ``least`` rows."""
    keys = [*[k for k in frame_keys(tracks) if k != "frame"], "pedestrian"]
    enough = tracks.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return tracks.join(enough, keys, "left_semi")


def path_windows(tracks: DataFrame, size: int, stride: int, hot_rows: int = HOT_ROWS,
                 segment_rows: int = SEGMENT_ROWS, sizes_from: DataFrame | None = None) -> DataFrame:
    """Windows of ``size`` consecutive rows that start at every ``stride``-th row of a
    pedestrian, as ``path``, an array of (frame, x, y), with the row's number and the piece
    ``seg`` it was found in. Where the tracks carry frame statistics, also their total (``n_rows``) and whether one row was ``close``.

    One shuffle and one sort, by pedestrian and frame; a pedestrian with fewer rows
    simply has no full window.
    """
    keys = [k for k in frame_keys(tracks) if k != "frame"]
    group, ties = [*keys, "pedestrian"], ["x", "y"]
    stats = [c for c in ("n_rows", "close") if c in tracks.columns]
    rows = segments(tracks, group, "frame", ties, after=size - 1, share=[c for c in stats if c == "close"],
                    sizes_from=sizes_from, hot_rows=hot_rows, segment_rows=segment_rows)
    ahead = piece_window(group, "frame", ties).rowsBetween(0, size - 1)
    total = {"n_rows": F.sum, "close": F.max}
    return (rows.select(*group, "seg", "row_no", "own", *[total[c](c).over(ahead).alias(c) for c in stats],
                        F.collect_list(F.struct("frame", "x", "y")).over(ahead).alias("path"))
            .where(F.col("own") & (F.size("path") == size) & ((F.col("row_no") - 1) % stride == 0))
            .drop("own"))


def moved(config: SceneConfig) -> Column:
    """The squared distance from first to last row exceeds ``min_length``."""
    first, last = F.get("path", F.lit(0)), F.get("path", F.lit(config.chunk_size - 1))
    return dist2(first["x"], first["y"], last["x"], last["y"]) > F.lit(float(config.min_length))


def active(config: SceneConfig) -> Column:
    """The frames of the window hold enough rows in total."""
    return F.col("n_rows") >= F.lit(config.activity * config.chunk_size)


def continuous(config: SceneConfig) -> Column:
    return is_continuous(F.col("path.frame"), config.gap_tolerance)


def candidate_windows(tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """All windows with the inputs of the four scene filters. Two shuffles of the tracks:
    by frame for the statistics, by pedestrian for the windows."""
    rows = frame_stats(tracks, config.cell_size, config.hot_rows)
    return path_windows(rows, config.chunk_size, config.chunk_stride, config.hot_rows, config.segment_rows, tracks)


def cut_scenes(tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Windows that pass all four filters, the cheap ones first; ``seg`` and ``row_no`` order
    those of a pedestrian."""
    return (candidate_windows(tracks, config)
            .where(F.col("close") & active(config) & moved(config))
            .where(continuous(config))
            .drop("n_rows", "close"))


def scene_rows(scenes: DataFrame, config: SceneConfig) -> DataFrame:
    """Scenes with consecutive ids per dataset that run on from train to val to test,
    in order of pedestrian and start.

    The paths stay where their window was: a scene's place among those of its pedestrian's
    piece needs no other shuffle, and only the pieces' sizes are put in order.
    """
    keyed = scenes.withColumn("start", F.col("path")[0]["frame"]).withColumn("end", F.element_at("path", -1)["frame"])
    piece = ["dataset", "split", "pedestrian", "seg"]
    ranked = freeze(keyed.withColumn("_rank", F.row_number().over(Window.partitionBy(*piece).orderBy("row_no"))).drop("row_no"))
    sizes = ranked.groupBy(*piece).agg(F.count("*").alias("_size")).withColumn("_place", split_place(F.col("split")))
    before = totals_in_order(sizes, ["dataset"], ["_place", "pedestrian", "seg"], "_size", "_before").select(*piece, "_before")
    numbered = ranked.join(broadcast_if_small(before), piece).withColumn("scene", F.col("_before") + F.col("_rank") - 1)
    return (numbered.drop("seg", "_rank", "_before")
        .withColumn("fps", F.lit(float(config.fps)))
        .withColumn("tag", F.lit(0))
        .withColumn("sub_tags", F.lit(None).cast("array<int>")))


def with_paths(scenes: DataFrame, tracks: DataFrame, size: int = SceneConfig().chunk_size, hot_rows: int = HOT_ROWS,
               segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Give stored scenes their ``path`` again: the primary's rows from the one at ``start`` on, ``size`` of them at most and none after ``end``,
    in order of frame and position. ``scenes`` has dataset, split, pedestrian, start and end, as written and read again; a scene without
    a row at its start is left out.

    Starts are marked in the rows by an equi-join, and one window of consecutive rows gives the paths, so the work grows with the rows
    and the scenes, however many scenes a pedestrian has. Over tracks in buckets (``write_buckets``), and inside
    ``storage.co_partitioned``, the tracks are not shuffled.
    """
    person = ["dataset", "split", "pedestrian"]
    starts = scenes.select(*person, F.col("start").alias("frame")).distinct().withColumn("_starts", F.lit(True))
    rows = tracks.select(*person, "frame", "x", "y").join(starts, [*person, "frame"], "left")
    pieces = segments(rows, person, "frame", ["x", "y"], before=1, after=size - 1, sizes_from=tracks, hot_rows=hot_rows, segment_rows=segment_rows)
    w = piece_window(person, "frame", ["x", "y"])
    first = F.coalesce(F.lag("frame").over(w) != F.col("frame"), F.lit(True))
    path = F.collect_list(F.struct("frame", "x", "y")).over(w.rowsBetween(0, size - 1))
    found = (pieces.select(*person, F.col("frame").alias("start"), "own", "_starts", first.alias("_first"), path.alias("path"))
             .where("own AND _starts AND _first").select(*person, "start", "path"))
    return scenes.drop("path").join(found, [*person, "start"]).withColumn("path", F.filter("path", lambda p: p["frame"] <= F.col("end")))


def with_public_test(scenes: DataFrame) -> DataFrame:
    """The test scenes twice: as ``test_private`` and, with the same ids and no tag, as the
    public ``test``. One pass; the scenes are not computed again."""
    names = F.when(F.col("split") == "test", F.array(F.lit("test_private"), F.lit("test"))).otherwise(F.array("split"))
    twice = scenes.withColumn("split", F.explode(names))
    public = F.col("split") == "test"
    return twice.withColumn("tag", F.when(public, 0).otherwise(F.col("tag"))).withColumn(
        "sub_tags", F.when(~public, F.col("sub_tags")))


def shown_frames(scenes: DataFrame, config: SceneConfig) -> Column:
    """The frames a scene shows: all of them, but only the observed ones in public test."""
    frames = frames_of(scenes)
    return F.when(F.col("split") == "test", F.slice(frames, 1, config.obs_len)).otherwise(frames)


def kept_frames(scenes: DataFrame, config: SceneConfig) -> DataFrame:
    """Distinct frames shown by at least one scene, per dataset and split."""
    return scenes.select("dataset", "split", F.explode(shown_frames(scenes, config)).alias("frame")).distinct()


def tracks_of_frames(tracks: DataFrame, frames: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows of the tracks, of any pedestrian, whose frame is kept; for a split tracks
    table also once for each of the twin test sets that keeps it.

    A hot frame would put its rows into one task of a plain semi join, so hot frames go
    through a broadcast list, whose length is bounded.
    """
    keys = frame_keys(tracks)
    if "split" in keys:
        names = F.when(F.col("split") == "test", F.array(F.lit("test_private"), F.lit("test"))).otherwise(F.array("split"))
        tracks = tracks.withColumn("split", F.explode(names))
    hot = hot_groups(tracks, keys, hot_rows)
    if hot is None:
        return tracks.join(frames, keys, "left_semi")
    hot_kept = broadcast_if_small(frames.join(hot, keys, "left_semi"))
    calm = tracks.join(hot, keys, "left_anti").join(frames, keys, "left_semi")
    return calm.unionByName(tracks.join(hot_kept, keys, "left_semi"))


def visible_frames(scenes: DataFrame, obs_len: int) -> DataFrame:
    """The first ``obs_len`` frames of each scene."""
    return scenes.withColumn("frames", F.slice(F.col("path.frame"), 1, obs_len))


def first_rows(tracks: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows of each pedestrian. Spark drops later rows before the
    shuffle, so a hot pedestrian sends only ``count`` rows from each task."""
    keys = [*[k for k in frame_keys(tracks) if k != "frame"], "pedestrian"]
    w = Window.partitionBy(*keys).orderBy("frame", "x", "y")
    return tracks.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= count).drop("_n")
