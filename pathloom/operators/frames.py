"""Per-frame statistics, thinning and the split by frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathloom.config import HOT_ROWS, SceneConfig
from pathloom.functions.geometry import grid_cell
from pathloom.operators.ordered import hot_groups, running_totals
from pathloom.storage import broadcast_if_small, freeze

# The two sessions of a two-session recording lie this far apart.
SESSION_FRAMES = 100_000

SPLIT_ORDER = ("train", "val", "test")


def stride_frame(tracks: DataFrame, step: int) -> DataFrame:
    """Thin a recording to the frames that are a multiple of ``step``."""
    return tracks.where(F.pmod("frame", F.lit(step)) == 0)


def frame_keys(tracks: DataFrame) -> list[str]:
    return [c for c in ("dataset", "split") if c in tracks.columns] + ["frame"]


def frame_stats(tracks: DataFrame, cell_size: float = 10.0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``n_rows`` (rows in the frame) and ``close`` (the row shares its grid cell).

    One shuffle by frame. Rows of a hot frame are spread by cell: their count is already
    known from finding the frame. Rows of a hot cell are spread further: such a cell is
    certainly shared.
    """
    keys = frame_keys(tracks)
    rows = tracks.withColumn("_cx", grid_cell(F.col("x"), cell_size)).withColumn("_cy", grid_cell(F.col("y"), cell_size))
    cell = [*keys, "_cx", "_cy"]
    # Ordered by cell over the whole frame, so that one sort serves both windows.
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    in_frame = Window.partitionBy(*keys).orderBy("_cx", "_cy").rowsBetween(*everything)
    in_cell = Window.partitionBy(*cell)
    hot_frames = hot_groups(tracks, keys, hot_rows)
    if hot_frames is None:
        return rows.select(*tracks.columns, (F.count("*").over(in_cell) > 1).alias("close"),
                           F.count("*").over(in_frame).alias("n_rows"))
    hot_cells = hot_groups(rows.join(hot_frames, keys, "left_semi"), cell, hot_rows)
    rows = rows.join(hot_frames, keys, "left")
    spread = F.when(F.col("_size").isNotNull(), F.pmod(F.xxhash64("_cx", "_cy"), F.lit(65536))).otherwise(F.lit(0))
    crowded = F.lit(False)
    if hot_cells is not None:
        rows = rows.join(hot_cells.select(*cell, F.lit(True).alias("_crowded")), cell, "left")
        spread = F.when(F.col("_crowded"), F.pmod(F.xxhash64("pedestrian"), F.lit(65536))).otherwise(spread)
        crowded = F.coalesce("_crowded", F.lit(False))
    rows = rows.withColumn("_slot", spread)
    in_frame = Window.partitionBy(*keys, "_slot").orderBy("_cx", "_cy").rowsBetween(*everything)
    in_cell = Window.partitionBy(*keys, "_slot", "_cx", "_cy")
    return rows.select(
        *tracks.columns, (crowded | (F.count("*").over(in_cell) > 1)).alias("close"),
        F.coalesce("_size", F.count("*").over(in_frame)).alias("n_rows"))


def frame_counts(tracks: DataFrame) -> DataFrame:
    """Rows per frame."""
    return tracks.groupBy(*frame_keys(tracks)).agg(F.count("*").alias("n_rows"))


def close_pedestrians(tracks: DataFrame, cell_size: float = 10.0) -> DataFrame:
    """Per frame, the pedestrians that share a grid cell with another row.

    Counts combine on the map side; a cell carries its pedestrians only through a join,
    so a crowded cell is never gathered.
    """
    keys = frame_keys(tracks)
    rows = tracks.select(*keys, "pedestrian", grid_cell(F.col("x"), cell_size).alias("_cx"), grid_cell(F.col("y"), cell_size).alias("_cy"))
    shared = rows.groupBy(*keys, "_cx", "_cy").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return rows.join(shared, [*keys, "_cx", "_cy"], "left_semi").select(*keys, "pedestrian").distinct()


def frame_order(config: SceneConfig, frame: Column | None = None) -> Column:
    """Integer that sorts like the frames do: by the frame itself, or by its place in its
    session and then by session."""
    frame = F.col("frame") if frame is None else frame
    if not config.order_frames:
        return frame
    return F.pmod(frame, F.lit(SESSION_FRAMES)) * F.lit(1 << 40) + frame


def ordered_frames(tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Distinct frames with their zero-based rank in frame order."""
    keys = [k for k in frame_keys(tracks) if k != "frame"]
    frames = tracks.select(*keys, "frame").distinct().withColumn("_order", frame_order(config))
    ranked = running_totals(frames, keys, "_order", {"rank": F.lit(1)}, hot_rows=config.hot_rows, block_bits=16)
    return ranked.select(*keys, "frame", (F.col("rank") - 1).alias("rank"))


def split_borders(tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Per dataset, the order value of the first frame that is no longer train, and of the
    first that is no longer val (NULL where there is none)."""
    ranked = ordered_frames(tracks, config)
    total = ranked.groupBy("dataset").agg(F.count("*").alias("_total"))
    train = F.floor(F.col("_total") * F.lit(float(config.train_fraction)))
    val = F.floor(F.col("_total") * F.lit(float(config.val_fraction)))
    return (ranked.join(total, "dataset")
            .groupBy("dataset")
            .agg(F.min(F.when(F.col("rank") >= train, frame_order(config))).alias("_train_end"),
                 F.min(F.when(F.col("rank") >= train + val, frame_order(config))).alias("_val_end")))


def split_frames(tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Add ``split``: the first frames are train, the next val, the rest test.

    Each part is a range in frame order, so rows are compared with two borders of their
    dataset; no join by frame is needed.
    """
    order = frame_order(config)
    # Two numbers per dataset that every later step needs again, so they are stored.
    borders = broadcast_if_small(freeze(split_borders(tracks, config)))
    return tracks.join(borders, "dataset").select(
        *tracks.columns,
        F.when(F.col("_train_end").isNull() | (order < F.col("_train_end")), "train")
        .when(F.col("_val_end").isNull() | (order < F.col("_val_end")), "val")
        .otherwise("test").alias("split"))


def split_place(split: Column) -> Column:
    """0, 1, 2 for train, val and test."""
    return F.array_position(F.lit(list(SPLIT_ORDER)), split) - 1
