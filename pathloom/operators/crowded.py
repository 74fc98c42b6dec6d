"""Whether somebody is there, in cells too crowded to list everybody.

In a crowd of n in one place, n moves look at n others. Whether a cone holds anybody needs no
list of them. Cells of the crowd carry how many distinct places they hold and whose the least
and the greatest id is; a move asks the cells that its cone touches. A cell with somebody in
it that lies inside the cone answers at once, and the question is dropped. One on the edge is
asked in its halves again, by both axes and, for questions on the heading of the others, by
direction. Where few places are left they are looked at themselves. So a question costs a few
cells along the edge of its cone, not the crowd.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.config import NO_HOT_ROWS, SceneConfig
from pathloom.functions.geometry import dist2, grid_cell, within_angle
from pathloom.storage import broadcast_if_small, freeze, new_folder

FRAME = ["dataset", "split", "frame"]
PAIR = ["dataset", "split", "pframe", "frame"]
MOVE = ["dataset", "split", "pedestrian", "pframe", "frame"]
CELL = ["cx", "cy", "cs"]

# What is asked of a move: anybody in the cone, and one that heads the same or the opposite way.
CONE, LEADER, AVOIDANCE = "cone", "leader", "avoidance"

FEW = 16  # places that are looked at one by one
SECTORS = 12  # of all directions, on the first level
DEEPEST = 40  # halvings; what is left then is told apart by rounding only
MARGIN = 1e-6  # metres, and radians; cells are inside, or outside, by more than that
NO_SECTOR = -1


def crowded_cells(tracks: DataFrame, size: float, most: int) -> DataFrame | None:
    """Grid cells ``(dataset, split, frame, _gx, _gy)`` that hold more than ``most`` rows; None if there is none.
    Counted on the map side; at most (all rows / ``most``) cells qualify."""
    if most >= NO_HOT_ROWS:
        return None
    cells = tracks.select(*FRAME, grid_cell(F.col("x"), size).alias("_gx"), grid_cell(F.col("y"), size).alias("_gy"))
    found = freeze(cells.groupBy(*FRAME, "_gx", "_gy").agg(F.count("*").alias("_n")).where(F.col("_n") > most).drop("_n"))
    return None if found.isEmpty() else found


def in_cells(tracks: DataFrame, cells: DataFrame, size: float, inside: bool) -> DataFrame:
    """The rows that lie in one of the cells, or those that do not."""
    marked = tracks.withColumn("_gx", grid_cell(F.col("x"), size)).withColumn("_gy", grid_cell(F.col("y"), size))
    return marked.join(broadcast_if_small(cells), [*FRAME, "_gx", "_gy"], "left_semi" if inside else "left_anti").select(*tracks.columns)


def _turn(dx: Column, dy: Column) -> Column:
    """Direction of a vector in [0, 2 pi); null for none."""
    angle = F.atan2(dy, dx)
    angle = F.when(angle < 0, angle + 2 * math.pi).otherwise(angle)
    return F.when((dx != 0) | (dy != 0), F.when(angle < 2 * math.pi, angle).otherwise(0.0))


def _places(tracks: DataFrame, crowd: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct places of the crowd for every pair of frames, with the least and the greatest id at it: once
    without a direction, and once for each step (``nx, ny``) that leads there."""
    before = tracks.select("dataset", "split", F.col("frame").alias("pframe"), "pedestrian", F.col("x").alias("bx"), F.col("y").alias("by"))
    rows = (crowd.join(broadcast_if_small(pairs), FRAME).join(before, ["dataset", "split", "pframe", "pedestrian"], "left")
            .select(*PAIR, "pedestrian", F.col("x").alias("ox"), F.col("y").alias("oy"), (F.col("x") - F.col("bx")).alias("nx"), (F.col("y") - F.col("by")).alias("ny")))
    none = F.lit(None).cast("double")
    both = rows.withColumn("nx", none).withColumn("ny", none).unionByName(rows.where((F.col("nx") != 0) | (F.col("ny") != 0)))
    ids = both.groupBy(*PAIR, "ox", "oy", "nx", "ny").agg(F.min("pedestrian").alias("lo"), F.max("pedestrian").alias("hi"))
    return ids.withColumn("turn", _turn(F.col("nx"), F.col("ny")))


def _sector(width: float) -> Column:
    last = round(2 * math.pi / width) - 1
    return F.when(F.col("turn").isNull(), F.lit(NO_SECTOR)).otherwise(F.least(F.floor(F.col("turn") / width), F.lit(last))).cast("bigint")


def cone_cells(moves: DataFrame, size: float, config: SceneConfig, reach: float | None = None) -> DataFrame:
    """The moves with a heading, once for each grid cell ``_gx, _gy`` that their cone may touch. ``reach`` is that of the cone, if the settings
    do not tell it."""
    reach = (config.inter_dist_thresh if reach is None else reach) * (1 + 1e-9) + 1e-9
    near = lambda c: F.explode(F.sequence(grid_cell(F.col(c) - reach, size), grid_cell(F.col(c) + reach, size)))
    asked = moves.where((F.col("hx") != 0) | (F.col("hy") != 0)).withColumn("_gx", near("x")).withColumn("_gy", near("y"))
    edge, far, half = _from_cone(config, size, F.col("_gx"), F.col("_gy"))
    return asked.where((edge >= -half - MARGIN) & (far - half <= reach + MARGIN))


def _questions(moves: DataFrame, cells: DataFrame, size: float, config: SceneConfig | None = None) -> DataFrame:
    """What the moves ask of the crowded cells ``cells`` near them: for the cone of any direction, for the others
    of all directions on the first level. Without settings the cone has the usual angle and reaches half as far as a cell."""
    asked = (cone_cells(moves, size, config or SceneConfig(), size / 2 if config is None else None)
             .join(broadcast_if_small(cells), [*FRAME, "_gx", "_gy"], "left_semi"))
    way = _turn(F.col("hx"), F.col("hy"))
    kinds = F.array(F.struct(F.lit(CONE).alias("asked"), F.lit(None).cast("double").alias("way")),
                    F.struct(F.lit(LEADER).alias("asked"), way.alias("way")),
                    F.struct(F.lit(AVOIDANCE).alias("asked"), F.pmod(way + math.pi, F.lit(2 * math.pi)).alias("way")))
    rows = asked.select(*MOVE, "x", "y", "hx", "hy", F.col("_gx").alias("cx"), F.col("_gy").alias("cy"), F.explode(kinds).alias("k"))
    whole = lambda n: F.lit(n).cast("bigint")
    sectors = F.when(F.col("k.way").isNull(), F.array(whole(NO_SECTOR))).otherwise(F.sequence(whole(0), whole(SECTORS - 1)))
    return rows.select(*MOVE, "x", "y", "hx", "hy", "k.asked", "k.way", "cx", "cy", F.explode(sectors).alias("cs"))


def _from_cone(config: SceneConfig, size: float, cx: Column, cy: Column) -> tuple[Column, Column, float]:
    """Of the middle of a cell: how far inside the edges of a move's cone it is, and its distance from the move; and how far the cell's corners are from there."""
    limit = math.radians(config.inter_pos_range)
    length = F.sqrt(F.col("hx") * F.col("hx") + F.col("hy") * F.col("hy"))
    ux, uy = F.col("hx") / length, F.col("hy") / length
    qx, qy = (cx + 0.5) * size - F.col("x"), (cy + 0.5) * size - F.col("y")
    edge = math.sin(limit) * (qx * ux + qy * uy) - math.cos(limit) * F.abs(qy * ux - qx * uy)  # distance from the edges, inside positive
    return edge, F.sqrt(qx * qx + qy * qy), size * math.sqrt(0.5)


def _bounds(config: SceneConfig, size: float, width: float) -> tuple[Column, Column]:
    """Whether the cell of a question surely lies inside its cone (and the directions asked for), and whether it may touch it.
    A cell is taken as the circle around it."""
    limit = math.radians(config.inter_pos_range)
    edge, far, half = _from_cone(config, size, F.col("cx"), F.col("cy"))
    off = F.abs(F.pmod((F.col("cs") + 0.5) * width - F.col("way") + math.pi, F.lit(2 * math.pi)) - math.pi)
    any_way = F.col("way").isNull()
    inside = (edge >= half + MARGIN) & (far + half <= config.inter_dist_thresh - MARGIN) & (any_way | (off + width / 2 <= limit - MARGIN))
    touches = (edge >= -half - MARGIN) & (far - half <= config.inter_dist_thresh + MARGIN) & (any_way | (off - width / 2 <= limit + MARGIN))
    return inside, touches


def _fits(config: SceneConfig) -> Column:
    """Whether the place found answers the question: the plain rule."""
    hx, hy, nx, ny, limit = F.col("hx"), F.col("hy"), F.col("nx"), F.col("ny"), config.inter_pos_range
    there = (dist2(F.col("x"), F.col("y"), F.col("ox"), F.col("oy")) <= config.inter_dist_thresh ** 2) & within_angle(
        hx, hy, F.col("ox") - F.col("x"), F.col("oy") - F.col("y"), limit)
    return there & (F.when(F.col("asked") == LEADER, within_angle(hx, hy, nx, ny, limit))
                    .when(F.col("asked") == AVOIDANCE, within_angle(hx, hy, -nx, -ny, limit)).otherwise(True))


def answers(moves: DataFrame, tracks: DataFrame, cells: DataFrame, size: float, config: SceneConfig,
            few: int = FEW) -> DataFrame:
    """The questions ``(dataset, split, pedestrian, pframe, frame, asked)`` of the moves that the people in the crowded ``cells``
    answer with yes. ``size`` is that of the cells. Stored.
    """
    spark = tracks.sparkSession
    schema = ", ".join([*(f"{c} {moves.schema[c].dataType.simpleString()}" for c in MOVE), "asked string"])
    target = new_folder(spark, "answers")
    yes = lambda rows: rows.select(*MOVE, "asked").distinct().write.mode("append").parquet(target)
    known = lambda: spark.read.schema(schema).parquet(target)
    somebody = (F.col("lo") != F.col("pedestrian")) | (F.col("hi") != F.col("pedestrian"))
    width = 2 * math.pi / SECTORS
    places = freeze(_places(tracks, in_cells(tracks, cells, size, True), moves.select(*PAIR).distinct()))
    left = _questions(moves, cells, size, config).where(_bounds(config, size, width)[1])
    left.limit(0).select(*MOVE, "asked").write.parquet(target)
    for level in range(DEEPEST + 1):
        cell = {"cx": grid_cell(F.col("ox"), size), "cy": grid_cell(F.col("oy"), size), "cs": _sector(width)}
        held = places.select("*", *[c.alias(n) for n, c in cell.items()])
        sums = held.groupBy(*PAIR, *CELL).agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        inside = _bounds(config, size, width)[0] & somebody
        met = freeze(left.join(sums, [*PAIR, *CELL]).withColumn("inside", inside).drop("lo", "hi"))
        single = F.lit(True) if level == DEEPEST else F.col("n") <= few
        looked_at = met.where(~F.col("inside") & single).join(held, [*PAIR, *CELL]).where(somebody & _fits(config))
        yes(met.where("inside").select(*MOVE, "asked").unionByName(looked_at.select(*MOVE, "asked")))
        more = freeze(met.where(~single).join(known(), [*MOVE, "asked"], "left_anti").drop("n", "inside"))
        if more.isEmpty():
            break
        places = freeze(held.join(more.select(*PAIR, *CELL).distinct(), [*PAIR, *CELL], "left_semi").drop(*CELL))
        size, width = size / 2, width / 2
        left = _halves(more, config, size, width)
    return known()


def _halves(rows: DataFrame, config: SceneConfig, size: float, width: float) -> DataFrame:
    """The questions to the parts of their cells that they touch."""
    two = lambda c: F.explode(F.array(2 * F.col(c), 2 * F.col(c) + 1))
    parts = F.when(F.col("way").isNull(), F.array(F.lit(NO_SECTOR).cast("bigint"))).otherwise(F.array(2 * F.col("cs"), 2 * F.col("cs") + 1))
    return rows.withColumn("cx", two("cx")).withColumn("cy", two("cy")).withColumn("cs", F.explode(parts)).where(_bounds(config, size, width)[1])


def flags(found: DataFrame, names: Sequence[str] = (CONE, LEADER, AVOIDANCE)) -> DataFrame:
    """Answers per move as columns."""
    return found.groupBy(*MOVE).agg(*[F.bool_or(F.col("asked") == n).alias(n) for n in names])
