"""Hot groups: cut into pieces, they must give what whole groups give."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pathloom.catalog import base
from pathloom.config import SceneConfig
from pathloom.operators import frames as R
from pathloom.operators import scenes as S
from pathloom.operators import synth as Y
from pathloom.operators.copies import copies
from pathloom.operators.kinds import collisions, type_scenes
from pathloom.operators.ordered import number_in_order, piece_window, running_totals, segments
from pathloom.operators.resample import midpoints
from pathloom.plans.recordings import prepare
from conftest import rows

WHOLE = dict(hot_rows=10**9, segment_rows=10**6)
CUT = dict(hot_rows=7, segment_rows=25)


@pytest.fixture(scope="module")
def skewed(spark):
    """Three groups; one holds most rows, with repeated keys and negative ones."""
    rng = random.Random(5)
    data = [("a", rng.randrange(-20000, 20000), n, rng.randrange(9)) for n in range(400)]
    data += [("b", k, k, 1) for k in range(5)] + [("c", 0, 0, 2)]
    return data, spark.createDataFrame(data, "g string, k long, tie long, v long").repartition(5)


@pytest.mark.parametrize("hot_rows", [10**9, 3, None])
@pytest.mark.parametrize("bits", [4, 12])
def test_running_totals(skewed, hot_rows, bits):
    data, table = skewed
    found = running_totals(table, ["g"], "k", {"n": F.lit(1), "s": F.col("v")}, ["tie"], hot_rows=hot_rows, block_bits=bits)
    want, seen = [], defaultdict(lambda: [0, 0])
    for g, k, tie, v in sorted(data):
        seen[g][0] += 1
        seen[g][1] += v
        want.append((g, k, tie, v, *seen[g]))
    assert sorted(tuple(r) for r in found.select("g", "k", "tie", "v", "n", "s").collect()) == sorted(want)


@pytest.mark.parametrize("before, after", [(0, 0), (2, 0), (0, 3), (4, 4)])
def test_segments_show_the_same_neighbours(skewed, before, after):
    _, table = skewed
    w = piece_window(["g"], "k", ["tie"])

    def seen(sizes):
        cut = segments(table, ["g"], "k", ["tie"], before, after, **sizes)
        around = [F.lag("v", n).over(w).alias(f"b{n}") for n in range(1, before + 1)] + [F.lead("v", n).over(w).alias(f"a{n}") for n in range(1, after + 1)]
        return rows(cut.select("g", "k", "tie", "row_no", "own", *around).where("own"))

    assert seen(CUT) == seen(WHOLE)
    assert len(seen(CUT)) == table.count()


def test_segments_are_bounded(skewed):
    _, table = skewed
    sizes = segments(table, ["g"], "k", ["tie"], 2, 3, **CUT).groupBy("g", "seg").count()
    assert sizes.agg(F.max("count")).first()[0] <= CUT["segment_rows"] + 5


def test_segments_refuse_a_window_beyond_a_piece(skewed):
    with pytest.raises(ValueError):
        segments(skewed[1], ["g"], "k", after=25, **CUT)


def test_number_in_order(skewed):
    data, table = skewed
    found = number_in_order(table, ["g"], ["k", "tie"], "n").select("g", "k", "tie", "v", "n").collect()
    want = []
    for g in "abc":
        want += [(*row, n) for n, row in enumerate(sorted(r for r in data if r[0] == g))]
    assert sorted(map(tuple, found)) == sorted(want)


def hot(config=SceneConfig()):
    return config.but(hot_rows=7, segment_rows=25)


@pytest.fixture(scope="module")
def doubled(crowd):
    """Tracks with repeated (frame, pedestrian) rows, some in another grid cell."""
    again = crowd.where("(frame + pedestrian) % 70 = 0").withColumn("x", F.col("x") + F.when(F.col("pedestrian") % 2 == 0, 0.0).otherwise(15.0))
    return crowd.unionByName(again)


def test_frame_stats(doubled):
    assert rows(R.frame_stats(doubled, hot_rows=2)) == rows(R.frame_stats(doubled))


def test_close_pedestrians_are_those_of_the_stats(doubled):
    want = R.frame_stats(doubled).where("close").select("dataset", "frame", "pedestrian").distinct()
    assert rows(R.close_pedestrians(doubled)) == rows(want)


def test_windows(doubled):
    columns = ("dataset", "split", "pedestrian", "row_no", "n_rows", "close", F.to_json("path").alias("path"))
    split = R.split_frames(doubled, SceneConfig())
    assert rows(S.candidate_windows(split, hot()).select(*columns)) == rows(S.candidate_windows(split, SceneConfig()).select(*columns))


@pytest.mark.parametrize("order_frames", [False, True])
def test_split(doubled, order_frames):
    config = SceneConfig(order_frames=order_frames)
    assert rows(R.split_frames(doubled, hot(config))) == rows(R.split_frames(doubled, config))


def test_kept_tracks(doubled):
    split = R.split_frames(doubled, SceneConfig())
    frames = split.where("frame % 3 = 0").withColumn("split", F.regexp_replace("split", "^test$", "test_private")).select("dataset", "split", "frame").distinct()
    assert rows(S.tracks_of_frames(split, frames, 2)) == rows(S.tracks_of_frames(split, frames))


def test_copies_of_a_track(spark, small):
    """Many equal tracks, some of whose scenes are open: as if compared one by one."""
    tracks = base.tracks(spark, small)
    again = tracks.where("pedestrian IN (4, 7)").withColumn("pedestrian", F.explode(F.sequence(F.col("pedestrian") + 1000, F.col("pedestrian") + 4000, F.lit(1000))))
    split, scenes = prepare(tracks.unionByName(again), SceneConfig())
    assert copies(split, 1000) is None
    assert copies(split, 3).select("pedestrian").distinct().count() == 10
    plain, few = SceneConfig(collision_radius=1.0), SceneConfig(collision_radius=1.0, hot_copies=3)
    typed = [rows(type_scenes(scenes, split, c).select("dataset", "scene", "pedestrian", "tag", F.to_json("sub_tags").alias("s"))) for c in (plain, few)]
    assert typed[0] == typed[1] and any(r[1] > 1000 and r[4] == 3 for r in typed[0])
    assert rows(collisions(scenes, split, few)) == rows(collisions(scenes, split, plain))


def test_midpoints_and_turns(crowd):
    line = crowd.withColumn("pos", F.col("frame"))
    assert rows(midpoints(line, **CUT)) == rows(midpoints(line, **WHOLE))
    agents = crowd.select("dataset", F.lit(0).cast("bigint").alias("scene"), "pedestrian", F.col("frame").alias("step"), "x", "y")
    for last in (False, True):
        assert rows(Y.smooth_scenes(agents, last, **CUT)) == rows(Y.smooth_scenes(agents, last, **WHOLE))
    assert rows(Y.scene_offsets(agents.withColumn("scene", F.col("pedestrian")), 3)) == rows(Y.scene_offsets(agents.withColumn("scene", F.col("pedestrian"))))
