"""Motion type of a scene and the checks on its surroundings.

Types: 1 static, 2 linear, 3 interacting, 4 other. Interaction kinds of type 3:
1 leader-follower, 2 collision avoidance, 3 group, 4 none of these.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathloom.config import SceneConfig
from pathloom.functions.forecast import forecast
from pathloom.functions.geometry import dist, dist2, grid_cell, within_angle
from pathloom.operators.copies import PERSON, copies, without_followers
from pathloom.operators.crowded import FRAME, answers, cone_cells, crowded_cells, flags, in_cells
from pathloom.operators.ordered import piece_window, segments
from pathloom.operators.pairs import SCENE, SHARE_PAIRS, frame_links, frames_of, group_sizes, meet, meet_in, nearby, scene_steps
from pathloom.storage import broadcast_if_small, freeze

STATIC, LINEAR, INTERACTING, OTHER = 1, 2, 3, 4
LEADER, AVOIDANCE, GROUP, OTHERS = 1, 2, 3, 4

# Limits on the mean and the final error of a re-simulated scene.
FORECAST_ADE, FORECAST_FDE = 0.11, 0.2

ID = ("dataset", "scene")

# Scenes whose shared moves are put together at a time.
SCENE_BATCH = 64

# Pairs in cells that a task compares step by step.
WALK_PAIRS = 4_000_000

# Side of a cell that a cone is looked for in, by the reach of the cone.
CONE_CELL = 0.5

# Where one companion is enough: about so many that a scene may meet in the first round, and the parts that the others are dealt to rounds in.
FIRST_MET, ROUND_PARTS = 64, 512

# A move of a primary: from its position at ``pframe`` to the next one.
MOVE = ("dataset", "split", "pedestrian", "pframe", "frame")


def travelled(config: SceneConfig) -> Column:
    """Distance from the first to the last position of the primary."""
    first, last = F.get("path", F.lit(0)), F.get("path", F.lit(config.chunk_size - 1))
    return dist(first["x"], first["y"], last["x"], last["y"])


def forecast_error(config: SceneConfig) -> Column:
    """Distance of the constant-velocity forecast from the true last position."""
    last = F.get("path", F.lit(config.chunk_size - 1))
    ahead = lambda axis: forecast(F.col("path"), axis, config.obs_len, config.pred_len)
    return dist(ahead("x"), ahead("y"), last["x"], last["y"])


def is_static(config: SceneConfig) -> Column:
    return travelled(config) < F.lit(float(config.static_threshold))


def is_linear(config: SceneConfig) -> Column:
    return forecast_error(config) < F.lit(float(config.linear_threshold))


def path_kind(config: SceneConfig) -> Column:
    """Type 1 or 2 where the primary's own path decides it, else NULL."""
    return F.when(is_static(config), STATIC).when(is_linear(config), LINEAR)


def open_steps(scenes: DataFrame, config: SceneConfig) -> DataFrame:
    """Predicted steps of the scenes."""
    return scene_steps(scenes, config.obs_len, config.chunk_size)


def open_moves(scenes: DataFrame, config: SceneConfig) -> DataFrame:
    """Distinct predicted moves of the scenes, with the heading ``hx, hy``. Overlapping scenes share most of theirs."""
    moves = open_steps(scenes, config).select(*MOVE, "x", "y", "px", "py").distinct()
    return moves.withColumn("hx", F.col("x") - F.col("px")).withColumn("hy", F.col("y") - F.col("py")).drop("px", "py")


def ends_of_moves(moves: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of ``rows`` at the end of the frame pairs (``pframe``, ``frame``) of the moves. The distinct pairs are few, so this is linear in the rows."""
    pairs = freeze(moves.select("dataset", "split", "pframe", "frame").distinct())
    return rows.select(*FRAME, "pedestrian", "x", "y").join(broadcast_if_small(pairs), list(FRAME))


def frame_moves(ends: DataFrame, tracks: DataFrame) -> DataFrame:
    """``ends_of_moves`` with ``bx, by``, the position at ``pframe`` (NULL for those not there)."""
    before = tracks.select("dataset", "split", F.col("frame").alias("pframe"), "pedestrian", F.col("x").alias("bx"), F.col("y").alias("by"))
    return ends.join(before, ["dataset", "split", "pframe", "pedestrian"], "left")


def cones(moves: DataFrame, rows: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Moves with somebody of ``rows`` in the cone, and the flags ``leader`` and ``avoidance``. A move is sent to the small grid cells that its cone
    touches, so it is compared with few who are not in it, and a pair is settled where it meets: flags are combined before they are shuffled, and no pair ever is."""
    size, keys = config.inter_dist_thresh * CONE_CELL, ["dataset", "split", "pframe", "frame", "_gx", "_gy"]
    ends = _in_cells(ends_of_moves(moves, rows), "x", "y", size)
    others = frame_moves(ends, tracks).select(*keys, F.col("pedestrian").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), "bx", "by")
    met = meet(cone_cells(moves, size, config), others, keys, WALK_PAIRS, by="pedestrian", least=_partitions(moves), counted=ends)
    hx, hy, limit = F.col("hx"), F.col("hy"), config.inter_pos_range
    nx, ny = F.col("ox") - F.col("bx"), F.col("oy") - F.col("by")
    near = met.where(F.col("other") != F.col("pedestrian")).where(
        dist2(F.col("x"), F.col("y"), F.col("ox"), F.col("oy")) <= F.lit(float(config.inter_dist_thresh) ** 2))
    ahead = near.where(within_angle(hx, hy, F.col("ox") - F.col("x"), F.col("oy") - F.col("y"), limit))
    return ahead.groupBy(*MOVE).agg(F.bool_or(within_angle(hx, hy, nx, ny, limit)).alias("leader"),
                                    F.bool_or(within_angle(hx, hy, -nx, -ny, limit)).alias("avoidance"))


@dataclass(frozen=True)
class Contacts:
    """What the moves of some scenes meet: the flags of ``cones`` ``by_move`` from ordinary cells, and ``answers``, what crowded cells
    say about cones, None without such a cell."""

    by_move: DataFrame
    answers: DataFrame | None


def contacts(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> Contacts:
    """Neighbours in the cones, per move of a primary. Each distinct move looks for them once. Cells with more than ``config.crowded``
    rows are not joined with everybody near them but asked whether they hold anybody."""
    moves = freeze(open_moves(scenes, config))
    size = config.inter_dist_thresh * CONE_CELL
    cells = crowded_cells(tracks, size, config.crowded)
    thin = tracks if cells is None else in_cells(tracks, cells, size, False)
    found = cones(moves, thin, tracks, config)
    return Contacts(found, None if cells is None else answers(moves, tracks, cells, size, config))


def cone_flags(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Scenes with somebody in the cone, and whether such a neighbour moves the same way
    (``leader``) or the opposite way (``avoidance``)."""
    found = contacts(scenes, tracks, config)
    by_move = found.by_move if found.answers is None else found.by_move.unionByName(flags(found.answers).drop("cone"))
    return open_steps(scenes, config).select(*MOVE, "scene").join(by_move, list(MOVE)).groupBy(*ID).agg(
        F.lit(True).alias("cone"),
        F.coalesce(F.bool_or("leader"), F.lit(False)).alias("leader"),
        F.coalesce(F.bool_or("avoidance"), F.lit(False)).alias("avoidance"))


def walks(moves: DataFrame, tracks: DataFrame, near: DataFrame, config: SceneConfig) -> DataFrame:
    """Running sums of the distance between a primary and another pedestrian: ``n, s1, s2`` are their common moves and the sums of
    distances and squares up to the move's ``place``, itself included; ``n0, s10, s20`` are without it.

    ``moves`` have their place among the open ones of their primary, ``near`` are moves at which the two are near each other. A walk
    takes in every move of any scene that holds one of these: up to ``pred_len - 1`` places to both sides. Distances are whole
    nanometres, so differences of sums are exact.
    """
    pair, reach = ["dataset", "split", "pedestrian", "other"], config.pred_len - 1
    spots = near.join(moves.select(*MOVE, "place"), list(MOVE)).select(*pair, "place").distinct()
    order = Window.partitionBy(*pair).orderBy("place")
    fresh = F.coalesce(F.col("place") - F.lag("place").over(order) > 2 * reach + 1, F.lit(True))
    walk = ["dataset", "split", "pedestrian", "other", "walk"]
    marked = spots.withColumn("_fresh", fresh.cast("bigint")).withColumn("walk", F.sum("_fresh").over(order))
    runs = marked.groupBy(*walk).agg(F.min("place").alias("a"), F.max("place").alias("b"))
    places = runs.select(*walk, F.explode(F.sequence(F.col("a") - reach, F.col("b") + reach)).alias("place"))
    where = tracks.select(*FRAME, F.col("pedestrian").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    steps = (places.join(moves.select("dataset", "split", "pedestrian", "place", "frame", "x", "y"), ["dataset", "split", "pedestrian", "place"])
             .join(where, [*FRAME, "other"], "left"))
    d = F.round(dist(F.col("x"), F.col("y"), F.col("ox"), F.col("oy")) * 1e9).cast("decimal(18,0)")
    known = steps.groupBy(*walk, "place").agg(  # one row even where somebody has several in a frame
        F.count(d).alias("n1"), F.coalesce(F.sum(d), F.lit(0)).cast("decimal(38,0)").alias("d1"), F.coalesce(F.sum(d * d), F.lit(0)).cast("decimal(38,0)").alias("d2"))
    upto = Window.partitionBy(*walk).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = {"n": "n1", "s1": "d1", "s2": "d2"}
    added = known.select("*", *[F.sum(v).over(upto).alias(k) for k, v in sums.items()])
    return added.select(*walk, "place", *sums, *[(F.col(k) - F.col(v)).alias(f"{k}0") for k, v in sums.items()])


def _near_moves(scenes: DataFrame, others: DataFrame, config: SceneConfig) -> DataFrame:
    """The predicted moves of the scenes, and whom they end near enough to form a group with."""
    return nearby(open_moves(scenes, config), others, config.grp_dist_thresh).select(*MOVE, "other")


def group_pairs(scenes: DataFrame, tracks: DataFrame, config: SceneConfig, some: bool = False) -> DataFrame:
    """Neighbours that walk with the primary: mean distance and its spread stay small over
    the common predicted steps (two at least). With ``some``, not all of them, but one at least of each scene that has any.

    Of ``n`` distances none is farther from their mean than ``sqrt(n - 1)`` times their spread, so the two are near each other already
    at their first common step. They meet there, in a grid cell, and both bring their next positions along: a pair is settled where it
    meets and is never shuffled. Followed by running sums instead (``pairs_by_walks``) are those with two rows in a frame or a row
    without a position, and others whose next ``pred_len`` rows may not reach the end of a scene.
    """
    ahead = F.slice("path", config.obs_len + 1, config.pred_len)
    nowhere = lambda p: p["x"].isNull() | p["y"].isNull() | F.isnan(p["x"]) | F.isnan(p["y"])
    single = (F.size("path") == config.chunk_size) & (F.size(F.array_distinct("ahead.frame")) == config.pred_len) & ~F.exists("ahead", nowhere)
    scenes = freeze(scenes.select(*SCENE, "path", ahead.alias("ahead")).withColumn("_single", F.coalesce(single, F.lit(False))))
    plain, others = scenes.where("_single").drop("_single"), scenes.where("NOT _single").drop("_single", "ahead")
    rows = freeze(next_rows(tracks, config))
    longest = plain.groupBy("dataset", "split").agg(F.max(F.element_at("ahead", -1)["frame"] - F.element_at("ahead", 1)["frame"]).alias("_longest"))
    short = (F.size("rf") == config.pred_len) & (F.element_at("rf", -1) - F.col("frame") < F.col("_longest"))
    odd = freeze(rows.join(broadcast_if_small(longest), ["dataset", "split"]).where(F.col("twice") | nowhere(rows) | short).select(*PERSON).distinct())
    if odd.isEmpty():
        found = _pairs_on_the_spot(plain, rows, config, some)[0]
    else:
        found, left = _pairs_on_the_spot(plain, freeze(rows.join(odd, PERSON, "left_anti")), config, some)
        found.append(pairs_by_walks(left, tracks.join(odd, PERSON, "left_semi"), config))
    if not others.isEmpty():
        found.append(pairs_by_walks(others, tracks, config))
    return reduce(DataFrame.unionByName, found)


def next_rows(tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """The rows with frames and positions of the next ``pred_len`` ones of the pedestrian, itself included, as arrays ``rf, rx, ry``, and
    the frames of the ``pred_len - 1`` before it, ``bf``; ``twice`` if the next one has the same frame."""
    ties, size = ["x", "y"], config.pred_len
    pieces = segments(tracks.select(*FRAME, "pedestrian", "x", "y"), PERSON, "frame", ties, before=size - 1, after=max(size - 1, 1),
                      hot_rows=config.hot_rows, segment_rows=config.segment_rows)
    w = piece_window(PERSON, "frame", ties)
    found = pieces.select(*FRAME, "pedestrian", "x", "y", "own", F.coalesce(F.lead("frame").over(w) == F.col("frame"), F.lit(False)).alias("twice"),
                          F.collect_list(F.struct("frame", "x", "y")).over(w.rowsBetween(0, size - 1)).alias("r"),
                          F.collect_list("frame").over(w.rowsBetween(1 - size, -1)).alias("bf"))
    return found.where("own").select(*FRAME, "pedestrian", "x", "y", "twice", "bf", F.col("r.frame").alias("rf"), F.col("r.x").alias("rx"), F.col("r.y").alias("ry"))


def later_moves(scenes: DataFrame, config: SceneConfig) -> DataFrame:
    """The predicted moves of the scenes after the first step, each once with the ``scenes`` that hold it and its ``places`` there, as
    overlapping ones share most of theirs. ``af, ax, ay`` are frames and positions from it on, as far as one of the scenes goes, ``past`` the frames
    of predicted steps before: of a scene at ``place``, those are its first ``pred_len - place`` and last ``place``. Scenes are brought
    together in batches of neighbouring ids, so a move comes more than once where batches meet, and no group is large."""
    batch = [*PERSON, "_batch"]
    together = scenes.withColumn("_batch", F.floor(F.col("scene") / SCENE_BATCH)).repartition(*batch)
    place = F.col("i") - config.obs_len
    steps = scene_steps(together, config.obs_len, config.chunk_size, ("ahead", "_batch")).withColumn("place", place).where("place > 0")
    ahead, past = F.slice("ahead", F.col("place") + 1, F.lit(config.pred_len)), F.slice("ahead.frame", F.lit(1), F.col("place"))
    moves = steps.groupBy(*batch, "pframe", "frame", "x", "y").agg(
        F.collect_list(F.struct("scene", "place")).alias("held"), F.min_by(ahead, "place").alias("ahead"), F.max_by(past, "place").alias("past"))
    return moves.select("dataset", "split", "pedestrian", "pframe", "frame", "x", "y", F.col("held.scene").alias("scenes"), F.col("held.place").alias("places"),
                        "past", *[F.col(f"ahead.{c}").alias(f"a{c[0]}") for c in ("frame", "x", "y")])


def newcomers(rows: DataFrame, pairs: DataFrame, config: SceneConfig) -> DataFrame:
    """Those of ``rows`` (of ``next_rows``, one a frame) at the end of the frame pairs that were not at ``pframe``. The frames before a row tell
    that, unless the pair leaps over all of them; only such rows are looked up."""
    here = rows.join(broadcast_if_small(pairs), list(FRAME))
    told = (F.size("bf") < config.pred_len - 1) | (F.col("pframe") >= F.get("bf", F.lit(0)))
    found, open_rows = here.where(told & ~F.array_contains("bf", F.col("pframe"))), here.where(~told)
    if open_rows.isEmpty():
        return found
    there = rows.select("dataset", "split", F.col("frame").alias("pframe"), "pedestrian")
    return found.unionByName(open_rows.join(there, ["dataset", "split", "pframe", "pedestrian"], "left_anti"))


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _columns(rows: DataFrame, prefix: str, x: Column, y: Column, size: int) -> DataFrame:
    """The entries of two arrays as columns ``{prefix}x0, {prefix}y0, …``, NaN where there is none."""
    none = F.lit(float("nan"))
    return rows.select("*", x.alias("_ax"), y.alias("_ay")).select(*rows.columns, *[
        F.coalesce(F.get(f"_a{c}", F.lit(k)), none).alias(f"{prefix}{c}{k}") for k in range(size) for c in ("x", "y")])


def _at_frames(others: DataFrame, size: int) -> DataFrame:
    """``others`` with their positions at the ``frames`` asked for as columns, from their next rows ``rf, rx, ry``."""
    at = lambda c: F.when(F.col("rf") == F.col("frames"), F.col(c)).otherwise(
        F.transform("frames", lambda f: F.get(c, F.array_position("rf", f).cast("int") - 1)))
    return _columns(others, "o", at("rx"), at("ry"), size).drop("rf", "rx", "ry")


def _in_cells(rows: DataFrame, x: str, y: str, size: float, reach: float = 0.0) -> DataFrame:
    """The rows with their grid cell, or once for each cell within ``reach``."""
    if not reach:
        return rows.withColumn("_gx", grid_cell(F.col(x), size)).withColumn("_gy", grid_cell(F.col(y), size))
    near = lambda c: F.explode(F.sequence(grid_cell(F.col(c) - reach, size), grid_cell(F.col(c) + reach, size)))
    return rows.withColumn("_gx", near(x)).withColumn("_gy", near(y))


def _met(here: DataFrame, there: DataFrame, on: Sequence[str], size: int, reach: float, by: str, pairs: float | None = None) -> DataFrame:
    """Those of ``here`` and others of ``there`` that are in one cell at most ``reach`` apart, with the positions of both at the ``frames`` of ``here``
    as columns. The others are put on those frames once for each cell and list of frames, not for each pair. ``pairs`` is the number in the
    cells, if none holds so many that it has to be dealt to several tasks."""
    keys = [*on, "_gx", "_gy", "frames"]
    there = _at_frames(there.join(broadcast_if_small(freeze(here.select(*keys).distinct())), keys[:-1]), size)
    least = _partitions(here)
    met = meet(here, there, keys, WALK_PAIRS, by=by, least=least) if pairs is None else meet_in(here, there, keys, pairs, WALK_PAIRS, least)
    near = dist2(F.col("x"), F.col("y"), F.col("ox"), F.col("oy")) <= F.lit(reach * reach)
    return met.where(F.col("other") != F.col("pedestrian")).where(near)


def _pairs_on_the_spot(scenes: DataFrame, rows: DataFrame, config: SceneConfig, some: bool = False) -> tuple[list[DataFrame], DataFrame]:
    """``group_pairs`` of pedestrians with one row a frame, whose next rows cover every scene, in parts, and the scenes that are left to look at.
    ``scenes`` have their predicted rows as ``ahead``.

    At the first predicted step a scene meets everybody, at a later one only those who were at none of the steps before. With ``some`` a
    scene needs one pair only: it meets the others in a few rounds, of one in so many first, and takes no part any more once it has one.
    """
    first, size = config.obs_len, config.pred_len
    reach = (config.grp_dist_thresh + config.grp_std_thresh * math.sqrt(size - 1)) * (1 + 1e-9) + 1e-6
    cell, within = 2.0 * reach, reach * (1 + 1e-9) + 1e-9
    people = rows.withColumnRenamed("pedestrian", "other").withColumnRenamed("x", "ox").withColumnRenamed("y", "oy")
    found: list[DataFrame] = []

    def keep(met: DataFrame, left: DataFrame) -> DataFrame:
        """Store the groups among those who met; the scenes that are still looked at."""
        found.append(freeze(_groups(met, config)))
        return left.join(found[-1].select(*ID).distinct(), list(ID), "left_anti") if some else left

    def starts(left: DataFrame) -> DataFrame:
        at = F.get("ahead", F.lit(0))
        here = left.select(*SCENE, "ahead", at["frame"].alias("frame"), at["x"].alias("x"), at["y"].alias("y"), F.col("ahead.frame").alias("frames"))
        return _in_cells(_columns(here, "p", F.col("ahead.x"), F.col("ahead.y"), size).drop("ahead"), "x", "y", cell, within)

    there = _in_cells(people.drop("bf", "twice"), "ox", "oy", cell)
    met_in_all, most = group_sizes(starts(scenes).select(*FRAME, "_gx", "_gy"), there, [*FRAME, "_gx", "_gy"]).agg(F.sum("_pairs"), F.max("_pairs")).first()
    met_in_all, calm = met_in_all or 0.0, (most or 0) <= SHARE_PAIRS
    part = F.pmod(F.xxhash64("other"), F.lit(ROUND_PARTS))
    left = scenes
    for low, high in _rounds(met_in_all, scenes.count()) if some else [(0, ROUND_PARTS)]:
        met = _met(starts(left), there.where((part >= low) & (part < high)), FRAME, size, reach, "scene",
                   met_in_all * (high - low) / ROUND_PARTS if calm else None)
        left = keep(_walk_together(met, size, config, reach), left)
        left = freeze(left) if some else left

    pairs = freeze(scene_steps(left, first + 1, first + size).select("dataset", "split", "pframe", "frame").distinct())
    moves = later_moves(left, config).withColumnRenamed("af", "frames")
    moves = _in_cells(_columns(moves, "p", F.col("ax"), F.col("ay"), size - 1).drop("ax", "ay"), "x", "y", cell)
    new = newcomers(rows, pairs, config).drop("twice").withColumnRenamed("pedestrian", "other").withColumnRenamed("x", "ox").withColumnRenamed("y", "oy")
    met = _met(moves, _in_cells(new, "ox", "oy", cell, within), ("dataset", "split", "pframe", "frame"), size - 1, reach, "pedestrian")
    met = met.select("*", F.posexplode("scenes").alias("_k", "scene")).withColumn("_place", F.get("places", F.col("_k")))
    met = met.where(~F.coalesce(F.arrays_overlap("bf", F.slice("past", -F.col("_place"), F.col("_place"))), F.lit(False)))
    left = keep(_walk_together(met.withColumn("_steps", size - F.col("_place")), size - 1, config, reach, F.col("_steps")), left)
    return found, left


def _rounds(pairs: float, scenes: int) -> list[tuple[int, int]]:
    """Parts of the others that scenes meet one after the other, the smallest first: a scene meets about ``FIRST_MET`` in it, ``pairs`` in all."""
    cuts, wanted = [ROUND_PARTS], FIRST_MET * max(scenes, 1) / max(pairs, 1)
    while cuts[0] > 1 and cuts[0] > wanted * ROUND_PARTS:
        cuts.insert(0, cuts[0] // 8)
    return list(zip([0, *cuts], cuts))


def _walk_together(met: DataFrame, size: int, config: SceneConfig, reach: float, steps: Column | None = None) -> DataFrame:
    """Pairs that may form a group, few others among them, with number, sum and squares of their distances in nanometres at the common steps, from
    the columns ``px0, py0, …`` and ``ox0, oy0, …``. ``steps``, if given, tells how many of them count. Plain columns, without arrays and
    functions on them, as this is done for every pair, and in steps of little code each: the JVM does not compile a method of more than 8,000 bytes."""
    gap = lambda k: dist2(*[F.col(f"{who}{c}{k}") for who in "po" for c in "xy"])
    gone = lambda k: F.isnan(f"ox{k}") if steps is None else F.isnan(f"ox{k}") | (steps <= k)
    added = lambda c: reduce(Column.__add__, [c(k) for k in range(size)])
    # In one array of one struct: a filter on its fields is not moved below, where it would work them out again.
    once = lambda **fields: F.inline(F.array(F.struct(*[v.alias(k) for k, v in fields.items()])))
    apart = [F.when(gone(k), F.lit(0.0)).otherwise(F.sqrt(gap(k))).alias(f"r{k}") for k in range(size)]
    met = met.select(*ID, "other", added(lambda k: F.when(gone(k), 0).otherwise(1)).alias("n"), *apart)
    met = met.select("*", once(e1=added(lambda k: F.col(f"r{k}")), e2=added(lambda k: F.col(f"r{k}") * F.col(f"r{k}"))))
    # Cheap tests first, with some room for rounding; few pairs are left for the exact sums.
    scatter = F.col("e2") - F.col("e1") * F.col("e1") / F.col("n") - F.col("e2") * 1e-12
    met = met.where((F.col("n") >= 2) & (F.col("e1") <= F.col("n") * (config.grp_dist_thresh + 1e-6))
                    & (scatter <= F.col("n") * (config.grp_std_thresh + 1e-6) ** 2 + 1e-9))
    met = met.select(*ID, "other", "n", *[F.floor(F.col(f"r{k}") * 1e9 + 0.5).alias(f"d{k}") for k in range(size)])
    # Squares in two halves, as a whole one does not fit a long.
    half = 1 << 20
    total = lambda c: added(lambda k: c(F.col(f"d{k}")))
    high, low = lambda d: F.shiftright(d, 20), lambda d: d.bitwiseAND(F.lit(half - 1))
    met = met.select(*ID, "other", "n", once(s1=total(lambda d: d), hh=total(lambda d: high(d) * high(d)),
                                             hl=total(lambda d: high(d) * low(d)), ll=total(lambda d: low(d) * low(d))))
    exact = lambda c, factor: F.col(c).cast("decimal(20,0)") * F.lit(factor).cast("decimal(13,0)")
    return met.select(*ID, "other", F.col("n").cast("decimal(10,0)").alias("n"), F.col("s1").cast("decimal(19,0)").alias("s1"),
                      (exact("hh", half * half) + exact("hl", 2 * half) + exact("ll", 1)).cast("decimal(28,0)").alias("s2"))


def _groups(sums: DataFrame, config: SceneConfig) -> DataFrame:
    """Those whose mean distance and spread are small, from number, sum and squares of their distances in nanometres."""
    steps = F.col("n").cast("double")
    mean = F.col("s1").cast("double") / steps / 1e9
    spread = F.sqrt((F.col("n") * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")) / steps / 1e9
    return (sums.select(*ID, "other", mean.alias("mean_dist"), spread.alias("std_dist"), F.col("n").cast("bigint").alias("steps"))
            .where((F.col("mean_dist") < config.grp_dist_thresh) & (F.col("std_dist") < config.grp_std_thresh)))


def pairs_by_walks(scenes: DataFrame, others: DataFrame, config: SceneConfig) -> DataFrame:
    """``group_pairs`` of any scenes and others.

    A mean below the limit needs one step below it, so only pairs that come that near are followed, once for all scenes: a scene
    is the difference of two rows of running sums, at its last predicted move and before its first.
    """
    near = freeze(_near_moves(scenes, others, config))
    own = ["dataset", "split", "pedestrian"]
    scenes = scenes.join(near.select(*own).distinct(), own, "left_semi")  # only they can be in a group
    moves = open_moves(scenes, config).withColumn("place", F.row_number().over(Window.partitionBy(*own).orderBy("frame", "x", "y", "pframe")).cast("bigint"))
    sums = walks(moves, others, near, config)
    starts = (scene_steps(scenes, config.obs_len, config.obs_len + 1).select(*MOVE, "scene", "x", "y").join(moves.select(*MOVE, "x", "y", "place"), [*MOVE, "x", "y"])
              .select(*own, "scene", F.col("place").alias("first"), (F.col("place") + (config.pred_len - 1)).alias("last")))
    walk = [*own, "other", "walk"]
    before = sums.select(*walk, F.col("place").alias("first"), "n0", "s10", "s20")
    upto = sums.select(*walk, F.col("place").alias("last"), "n", "s1", "s2")
    n = (F.col("n") - F.col("n0")).cast("decimal(10,0)")
    s1, s2 = F.col("s1") - F.col("s10"), F.col("s2") - F.col("s20")
    both = starts.join(before, [*own, "first"]).join(upto, [*walk, "last"])
    both = both.select(*ID, "other", n.alias("n"), s1.cast("decimal(19,0)").alias("s1"), s2.cast("decimal(28,0)").alias("s2")).where("n >= 2")
    return _groups(both, config)


def group_flags(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    return group_pairs(scenes, tracks, config, some=True).groupBy(*ID).agg(F.lit(True).alias("grouped"))


def interactions(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """All flags of the scenes that have any."""
    none = F.lit(False)
    group = freeze(group_flags(scenes, tracks, config)).select(*ID, none.alias("cone"), none.alias("leader"), none.alias("avoidance"), "grouped")
    cone = cone_flags(scenes, tracks, config).withColumn("grouped", none)
    return cone.unionByName(group).groupBy(*ID).agg(*[F.bool_or(c).alias(c) for c in ("cone", "leader", "avoidance", "grouped")])


def all_interactions(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """``interactions``, but of the scenes of a large group of equal tracks only one for each
    path is looked at, the first among those given, and of the tracks only the first is seen.
    The other scenes with the path get its flags; as the copies walk with each other, all of
    them are grouped. A copy never lies in the cone of another one: they are at one place.
    """
    members = copies(tracks, config.hot_copies)
    if members is None:
        return interactions(scenes, tracks, config)
    members = freeze(members)
    names, same = ("cone", "leader", "avoidance"), ["dataset", "split", "first", "path"]
    owned = scenes.select(*PERSON, "scene", "path").join(members.withColumnRenamed("leader", "first"), PERSON)
    chosen = freeze(owned.groupBy(*same).agg(F.min("scene").alias("scene")))
    looked_at = scenes.join(members, PERSON, "left_anti").unionByName(scenes.join(chosen.select(*ID), list(ID), "left_semi"))
    flags = freeze(interactions(looked_at, without_followers(tracks, members), config))
    alone = flags.join(chosen.select(*ID), list(ID), "left_anti")
    walk_along = config.pred_len >= 2 and config.grp_dist_thresh > 0 and config.grp_std_thresh > 0
    of_path = chosen.join(flags.select(*ID, *names), list(ID), "left").drop("scene")
    shared = owned.join(of_path, same).select(*ID, *[F.coalesce(n, F.lit(False)).alias(n) for n in names], F.lit(walk_along).alias("grouped"))
    return alone.select(*ID, *names, "grouped").unionByName(shared)


def sub_kinds() -> Column:
    """Interaction kinds from the flags."""
    none = ~(F.col("leader") | F.col("avoidance") | F.col("grouped"))
    return F.array_compact(F.array(
        F.when(F.col("leader"), LEADER), F.when(F.col("avoidance"), AVOIDANCE), F.when(F.col("grouped"), GROUP), F.when(none, OTHERS)))


def type_scenes(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Fill ``tag`` and ``sub_tags``. Only scenes whose own path leaves the type open are
    compared with their neighbours; the others are never shuffled.

    ``scenes`` is read several times, so it should be a stored table, as numbering leaves it.
    The result has the frames of a scene instead of its path, which is no longer needed.
    """
    kind = F.col("path_kind") if "path_kind" in scenes.columns else path_kind(config)
    marked = scenes.withColumn("tag", kind).drop("sub_tags", "path_kind")
    no_kind = F.array().cast("array<int>")
    by_frames = lambda rows: rows.withColumn("frames", F.col("path.frame")).drop("path")
    decided = by_frames(marked.where(F.col("tag").isNotNull())).withColumn("sub_tags", no_kind)
    open_scenes = marked.where(F.col("tag").isNull()).drop("tag")
    flags = all_interactions(open_scenes, tracks, config)
    unmarked = by_frames(open_scenes)
    typed = unmarked.join(flags, list(ID), "left").select(
        *unmarked.columns,
        F.when(F.col("cone") | F.col("grouped"), INTERACTING).otherwise(OTHER).alias("tag"),
        F.when(F.col("cone") | F.col("grouped"), sub_kinds()).otherwise(no_kind).alias("sub_tags"))
    return decided.unionByName(typed)


def presence(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Per scene, whether every pedestrian in it has a row in every frame of it.

    That holds exactly if each two successive frames show the same pedestrians. The frame
    pairs are compared once, however many scenes step over them, so scenes and
    pedestrians are never multiplied.
    """
    steps = scene_steps(scenes, 1, config.chunk_size).select("dataset", "split", "scene", "pframe", "frame")
    pairs = steps.select("dataset", "split", "pframe", "frame").distinct()
    seen = tracks.select("dataset", "split", "frame", "pedestrian").distinct()
    counts = seen.groupBy("dataset", "split", "frame").agg(F.count("*").alias("n"))
    before = seen.withColumnRenamed("frame", "pframe")
    common = (seen.join(pairs, ["dataset", "split", "frame"])
              .join(before, ["dataset", "split", "pframe", "pedestrian"], "left_semi")
              .groupBy("dataset", "split", "pframe", "frame").agg(F.count("*").alias("n_common")))
    same = (common.join(counts, ["dataset", "split", "frame"])
            .join(counts.withColumnRenamed("frame", "pframe").withColumnRenamed("n", "pn"), ["dataset", "split", "pframe"])
            .select("dataset", "split", "pframe", "frame", ((F.col("n_common") == F.col("n")) & (F.col("n") == F.col("pn"))).alias("same")))
    return (steps.join(same, ["dataset", "split", "pframe", "frame"], "left")
            .groupBy(*ID).agg(F.bool_and(F.coalesce("same", F.lit(False))).alias("all_present")))


def collisions(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Scenes (``dataset, scene``) whose primary comes nearer than the collision radius to a
    neighbour, at a predicted step or half-way between two of them."""
    members = copies(tracks, config.hot_copies) if config.collision_radius > 0 else None
    if members is None:
        return _collisions(scenes, tracks, config)
    # A copy is always where the other copies are.
    members = freeze(members)
    certain = scenes.join(members, PERSON, "left_semi").select(*ID)
    others = scenes.join(members, PERSON, "left_anti")
    return certain.unionByName(_collisions(others, without_followers(tracks, members), config))


def _collisions(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Overlapping scenes share most of their moves, so each distinct one is looked at once."""
    radius = config.collision_radius
    steps = scene_steps(scenes, config.obs_len, config.chunk_size)
    legs = steps.where(F.col("i") > config.obs_len)
    half = lambda rows: (rows.withColumn("x", (F.col("px") + F.col("x")) / 2).withColumn("y", (F.col("py") + F.col("y")) / 2).drop("px", "py"))
    spot, leg = [*FRAME, "pedestrian", "x", "y"], [*MOVE, "x", "y"]
    links = freeze(half(frame_links(legs, tracks)))
    at_step = touched(steps.select(*spot).distinct(), tracks, radius)
    between = touched(half(legs).select(*leg).distinct(), links, radius, ("dataset", "split", "pframe", "frame"))
    hit = lambda rows, found, keys: rows.join(found, keys, "left_semi").select(*ID)
    return hit(steps, at_step, spot).unionByName(hit(half(legs), between, leg)).distinct()


def touched(points: DataFrame, others: DataFrame, radius: float, on: Sequence[str] = FRAME) -> DataFrame:
    """Those of the distinct ``points`` (``on``, pedestrian, x, y) that are nearer than ``radius`` to another pedestrian of ``others``.

    Of two in one grid cell whose diagonal is shorter than the radius that is certain, whoever they are, so a crowded cell is only asked
    for its bounds. Points that have their cell for themselves are compared with those around; there are few of them near anybody,
    and the work grows with the rows, not with the pairs.
    """
    on, touching = list(on), F.col("d2") < F.lit(radius * radius)
    if radius <= 0:
        return nearby(points, others, radius, on).where(touching).select(*points.columns).distinct()
    size, cell = radius * math.sqrt(0.5) * (1 - 1e-6), [*on, "_cx", "_cy"]
    in_cell = lambda rows: rows.withColumn("_cx", grid_cell(F.col("x"), size)).withColumn("_cy", grid_cell(F.col("y"), size))
    low, high = [F.min(c).alias(f"{c}0") for c in ("x", "y")], [F.max(c).alias(f"{c}1") for c in ("x", "y")]
    held = in_cell(others).groupBy(*cell).agg(F.min("pedestrian").alias("_lo"), F.max("pedestrian").alias("_hi"), *low, *high)
    bounds = dist2(F.least("x", "x0"), F.least("y", "y0"), F.greatest("x", "x1"), F.greatest("y", "y1"))
    company = (F.col("_lo") != F.col("pedestrian")) | (F.col("_hi") != F.col("pedestrian"))
    sure = F.coalesce(company & (bounds < F.lit(radius * radius)), F.lit(False))
    asked = freeze(in_cell(points).join(held, cell, "left").select(*points.columns, sure.alias("_sure")))
    alone = nearby(asked.where("NOT _sure").drop("_sure"), others, radius, on).where(touching)
    return asked.where("_sure").drop("_sure").unionByName(alone.select(*points.columns).distinct())


def first_of_start(scenes: DataFrame) -> DataFrame:
    """Of the scenes of a split that start at the same frame, only the first."""
    firsts = scenes.groupBy("dataset", "split", "start").agg(F.min("scene").alias("scene"))
    return scenes.join(firsts.select(*ID), list(ID), "left_semi")


def forecast_check(scenes: DataFrame, tracks: DataFrame, forecasts: DataFrame, config: SceneConfig) -> DataFrame:
    """Per scene with forecasts, their iterations ``n_iter`` and ``is_invalid``: in some one the primary's forecast is
    not full-length, or a pedestrian with a full-length one is too far off. Errors over
    steps where the truth is missing are unknown and pass.
    """
    ahead = scenes.select("dataset", "split", "scene", F.col("pedestrian").alias("primary"),
                          F.slice(frames_of(scenes), config.obs_len + 1, config.pred_len).alias("frames"))
    truth = tracks.select("dataset", "split", "frame", "pedestrian", F.col("x").alias("tx"), F.col("y").alias("ty"))
    rows = (forecasts.join(ahead, ["dataset", "scene"])
            .withColumn("frame", F.get("frames", F.col("t").cast("int"))).drop("frames"))
    # Only those of full length are compared with the truth; who has several rows in a frame may get there by them.
    twice = freeze(tracks.groupBy(*FRAME, "pedestrian").agg(F.count("*").alias("_n")).where("_n > 1").select(*PERSON).distinct())
    if twice.isEmpty():
        rows = rows.withColumn("_twice", F.lit(False))
    else:
        rows = rows.join(twice.withColumn("_twice", F.lit(True)), PERSON, "left")
    # All of this is by scene, in one order, so the forecasts are shuffled and sorted once.
    person, own = ["dataset", "scene", "iter", "pedestrian", "primary"], F.col("pedestrian") == F.col("primary")
    of_person, of_iter = Window.partitionBy(*person), Window.partitionBy(*person[:3]).orderBy(*person[3:])
    whole = of_person.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = rows.withColumn("n", F.count("*").over(whole)).withColumn("_twice", F.coalesce(F.max("_twice").over(whole), F.lit(False)))
    numbered = numbered.withColumn("_head", F.row_number().over(of_iter) == 1).withColumn("compared", F.col("_twice") | (F.col("n") == config.pred_len))
    kept = freeze(numbered.where(F.col("compared") | F.col("_head") | own).drop("_twice", "_head"))
    rows = kept.where("compared").drop("n").join(truth, ["dataset", "split", "frame", "pedestrian"], "left")
    d = dist(F.col("x"), F.col("y"), F.col("tx"), F.col("ty"))
    by_ped = rows.groupBy(*person).agg(
        F.count("*").alias("n"), F.count(d).alias("n_true"), F.avg(d).alias("ade"),
        F.max(F.when(F.col("t") == config.pred_len - 1, d)).alias("fde"))
    off = (F.col("n") == config.pred_len) & (
        ((F.col("n_true") == config.pred_len) & (F.col("ade") > FORECAST_ADE)) | (F.col("fde") > FORECAST_FDE))
    each = by_ped.select("dataset", "scene", "iter", F.coalesce(off, F.lit(False)).alias("off"), F.when(own, F.col("n")).alias("own"))
    each = each.unionByName(kept.select("dataset", "scene", "iter", F.lit(False).alias("off"), F.when(own & ~F.col("compared"), F.col("n")).alias("own")))
    by_iter = each.groupBy("dataset", "scene", "iter").agg(F.bool_or("off").alias("off"), F.coalesce(F.max("own"), F.lit(0)).alias("own"))
    return by_iter.groupBy("dataset", "scene").agg(
        F.bool_or(F.col("off") | (F.col("own") != config.pred_len)).alias("is_invalid"), F.count("*").alias("n_iter"))


def short_test_scenes(scenes: DataFrame, shown: DataFrame, config: SceneConfig) -> DataFrame:
    """Public test scenes whose primary has fewer than ``obs_len`` rows among the tracks
    shown (``shown`` holds the public test tracks). There should be none."""
    test = scenes.where(F.col("split") == "test")
    frames = test.select("dataset", "scene", "pedestrian", F.explode(frames_of(scenes)).alias("frame"))
    rows = shown.where(F.col("split") == "test").select("dataset", "pedestrian", "frame")
    counts = frames.join(rows, ["dataset", "pedestrian", "frame"]).groupBy(*ID).agg(F.count("*").alias("n_shown"))
    return (test.select(*ID).join(counts, list(ID), "left")
            .select(*ID, F.coalesce("n_shown", F.lit(0)).alias("n_shown")).where(F.col("n_shown") < config.obs_len))
