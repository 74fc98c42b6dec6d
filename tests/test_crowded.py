"""Crowded cells: the same answers as from pairs, and work that grows with the crowd, not its square."""

import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from pathloom.config import NO_HOT_ROWS, SceneConfig
from pathloom.operators import crowded as C
from pathloom.operators import kinds as K
from pathloom.storage import freeze

CONFIG = SceneConfig(obs_len=2, pred_len=3)
NAMES = "dataset string, split string, frame long, pedestrian long, x double, y double"


def crowd(spark, people, frames, seed, width=9.0, step=0.6):
    """People who walk about in one cell of the first grid; some stand, some share a place, one is there twice."""
    rng = np.random.default_rng(seed)
    at = rng.uniform(0, width, (people, 2))
    at[: people // 10] = at[people // 10]
    data = []
    for f in range(frames):
        data += [("d", "train", 10 * f, p, float(x), float(y)) for p, (x, y) in enumerate(at)]
        move = rng.normal(0, step, (people, 2))
        move[people // 5: people // 4] = 0
        at = np.clip(at + move, 0, 9.99)
    data.append(("d", "train", 30, 3, 5.0, 5.0))
    return spark.createDataFrame(data, NAMES)


def scenes_of(tracks, size=5):
    """Every whole path as a scene."""
    path = F.sort_array(F.collect_list(F.struct("frame", "x", "y")))
    whole = tracks.groupBy("dataset", "split", "pedestrian").agg(path.alias("path")).where(F.size("path") == size)
    return whole.withColumn("scene", F.col("pedestrian") + 1000)


@pytest.mark.parametrize("seed, angle", [(1, 15.0), (2, 15.0), (4, 100.0)])
def test_answers_are_those_of_the_pairs(spark, seed, angle):
    config = CONFIG.but(inter_pos_range=angle, inter_dist_thresh=1.5 if seed == 2 else 5.0)
    tracks = freeze(crowd(spark, 120, 5, seed))
    scenes = freeze(scenes_of(tracks))
    flags = [rows(K.cone_flags(scenes, tracks, config.but(crowded=most)).select("scene", "leader", "avoidance")) for most in (20, NO_HOT_ROWS)]
    assert flags[0] == flags[1] and len(flags[0]) > 20
    if seed != 4:
        assert 0 < sum(r[0] for r in flags[0]) < len(flags[0])
    groups = [rows(K.group_pairs(scenes, tracks, config.but(crowded=most, grp_std_thresh=0.5))) for most in (20, NO_HOT_ROWS)]
    assert groups[0] == groups[1] and groups[0]


def brute(tracks, config):
    """Flags of every move by comparing everybody in the frame."""
    at = {}
    for _, _, f, p, x, y in tracks:
        at.setdefault(f, {})[p] = (x, y)
    limit, found = math.cos(math.radians(config.inter_pos_range)), {}
    last = max(at)
    here, before = at[last], at[last - 10]
    ids = np.array(sorted(here))
    pos, old = np.array([here[p] for p in ids]), np.array([before[p] for p in ids])
    head = pos - old
    size = np.hypot(*head.T)
    for k, p in enumerate(ids):
        b = pos - pos[k]
        d = np.hypot(*b.T)
        cone = (d > 0) & (d <= config.inter_dist_thresh) & (size[k] > 0) & (b @ head[k] >= limit * d * size[k])
        turn = head @ head[k]
        found[int(p)] = (bool(cone.any()), bool((cone & (size > 0) & (turn >= limit * size * size[k])).any()),
                         bool((cone & (size > 0) & (-turn >= limit * size * size[k])).any()))
    return found


def test_five_thousand_in_one_cell(spark):
    """Rows that the questions make grow with the crowd; everybody against everybody would be 25 million."""
    config, sizes = CONFIG, {}
    for people in (1250, 5000):
        tracks = freeze(crowd(spark, people, 2, 7).where("NOT (pedestrian = 3 AND frame = 30)"))
        a, b = tracks.where("frame = 0"), tracks.where("frame = 10")
        both = b.alias("b").join(a.alias("a"), "pedestrian").select(
            "b.dataset", "b.split", "pedestrian", F.col("a.frame").alias("pframe"), F.col("b.frame").alias("frame"), "b.x", "b.y",
            (F.col("b.x") - F.col("a.x")).alias("hx"), (F.col("b.y") - F.col("a.y")).alias("hy"))
        moves = freeze(both)
        cells = C.crowded_cells(tracks, 10.0, 1000)
        found = {r.pedestrian: (r.cone, r.leader, r.avoidance) for r in C.flags(C.answers(moves, tracks, cells, 10.0, config)).collect()}
        want = brute([tuple(r) for r in tracks.collect()], config)
        assert found == {p: w for p, w in want.items() if w[0]}
        first = C._questions(moves, cells, 10.0).where(C._bounds(config, 10.0, 2 * math.pi / C.SECTORS)[1])
        sizes[people] = first.count()
    assert sizes[5000] < 4.5 * sizes[1250] < 200_000


def test_ordinary_cells_are_left_to_the_pairs(spark):
    tracks = crowd(spark, 40, 5, 5)
    assert C.crowded_cells(tracks, 10.0, 1000) is None and C.crowded_cells(tracks, 10.0, NO_HOT_ROWS) is None
    assert K.contacts(scenes_of(tracks), tracks, CONFIG).answers is None


@pytest.mark.parametrize("odd", ["none", "gaps", "twice", "dense", "nowhere"])
def test_groups_settled_where_they_meet_are_those_of_running_sums(spark, odd):
    """Also with people who come and go, who are twice in a frame, in more frames than the scenes, or in one without a position."""
    config = SceneConfig(obs_len=2, pred_len=3, grp_dist_thresh=1.5, grp_std_thresh=0.6)
    tracks = crowd(spark, 60, 7, 5, step=0.3).where("NOT (pedestrian = 3 AND frame = 30 AND x = 5)")
    if odd == "gaps":
        tracks = tracks.where("NOT ((pedestrian + frame div 10) % 4 = 0 AND pedestrian % 2 = 0)")
    if odd == "twice":
        tracks = tracks.unionByName(tracks.where("pedestrian % 5 = 0").withColumn("x", F.col("x") + 0.1))
    if odd == "dense":
        tracks = tracks.unionByName(tracks.where("pedestrian % 5 = 0").withColumn("frame", F.col("frame") + 3))
    if odd == "nowhere":
        tracks = tracks.withColumn("x", F.when(F.expr("NOT (pedestrian % 5 = 0 AND frame = 30)"), F.col("x")))
    tracks = freeze(tracks)
    path = F.sort_array(F.collect_list(F.struct("frame", "x", "y")))
    scenes = freeze(tracks.groupBy("dataset", "split", "pedestrian").agg(F.slice(path, 1, 5).alias("path")).where(F.size("path") == 5)
                    .withColumn("scene", F.col("pedestrian") + 1000))
    found, plain = rows(K.group_pairs(scenes, tracks, config)), rows(K.pairs_by_walks(scenes, tracks, config))
    assert found == plain and found


def overlapping(tracks, size=5):
    """Scenes from every row of a pedestrian on that has enough rows after it."""
    ahead = Window.partitionBy("dataset", "split", "pedestrian").orderBy("frame", "x", "y")
    path = F.collect_list(F.struct("frame", "x", "y")).over(ahead.rowsBetween(0, size - 1))
    rows = tracks.select("dataset", "split", "pedestrian", path.alias("path"), F.row_number().over(ahead).alias("n")).where(F.size("path") == size)
    return freeze(rows.select("dataset", "split", "pedestrian", "path", (F.col("pedestrian") * 100 + F.col("n")).alias("scene")))


def test_scenes_that_overlap_bring_a_move_once(spark):
    """Each move of one pedestrian is sent once, with what every scene that holds it needs to go on from there."""
    tracks = spark.createDataFrame([("d", "train", 10 * f, 1, float(f), -float(f)) for f in range(12)], NAMES)
    scenes = overlapping(tracks).withColumn("ahead", F.slice("path", 3, 3))
    moves = K.later_moves(scenes, CONFIG).collect()
    assert len(moves) == len({(m.pframe, m.frame) for m in moves}) == 9 and sum(len(m.scenes) for m in moves) == 2 * scenes.count()
    ahead = {r.scene: [(p.frame, p.x, p.y) for p in r.ahead] for r in scenes.collect()}
    for m in moves:
        for scene, place in zip(m.scenes, m.places, strict=True):
            assert list(zip(m.af, m.ax, m.ay))[:3 - place] == ahead[scene][place:] and m.past[-place:] == [p[0] for p in ahead[scene][:place]]


@pytest.mark.parametrize("leap", [False, True])
def test_newcomers_are_told_by_the_frames_before(spark, leap):
    """Those at the end of a pair of frames that were not at its start, also where the pair leaps over more rows than they bring along."""
    data = [("d", "train", 10 * f, p, float(p), 0.0) for f in range(8) for p in range(4) if (f + p) % 4 and not (p == 2 and f == 1)]
    tracks = freeze(spark.createDataFrame(data, NAMES))
    pairs = [("d", "train", 10 * a, 10 * b) for a in range(8) for b in range(a + 1, 8) if leap or b == a + 1]
    found = K.newcomers(K.next_rows(tracks, CONFIG), freeze(spark.createDataFrame(pairs, "dataset string, split string, pframe long, frame long")), CONFIG)
    seen = {(f, p) for _, _, f, p, _, _ in data}
    assert sorted((r.pframe, r.frame, r.pedestrian) for r in found.collect()) == sorted(
        (a, b, p) for _, _, a, b in pairs for p in range(4) if (b, p) in seen and (a, p) not in seen)


@pytest.mark.parametrize("seed", [5, 6])
def test_groups_of_overlapping_scenes_with_gaps(spark, seed):
    config = SceneConfig(obs_len=2, pred_len=3, grp_dist_thresh=1.5, grp_std_thresh=0.6)
    tracks = freeze(crowd(spark, 60, 12, seed, step=0.3).where("NOT (pedestrian = 3 AND frame = 30 AND x = 5) AND (pedestrian + frame div 10) % 5 <> 0 AND NOT (pedestrian % 7 = 0 AND frame BETWEEN 20 AND 70)"))
    scenes = overlapping(tracks)
    found, plain = rows(K.group_pairs(scenes, tracks, config)), rows(K.pairs_by_walks(scenes, tracks, config))
    assert found == plain and found


def test_a_crowd_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Whether somebody is too near: the same as from all pairs, and who shares a small cell is not compared with anybody."""
    radius, compared = 0.7, []
    tracks = freeze(crowd(spark, 400, 2, 7).unionByName(crowd(spark, 40, 2, 8).withColumn("x", F.col("x") * 9 + 100).withColumn("pedestrian", F.col("pedestrian") + 1000)))
    points = tracks.where("pedestrian % 2 = 0").select("dataset", "split", "frame", "pedestrian", "x", "y")
    data = [tuple(r) for r in tracks.select("frame", "pedestrian", "x", "y").collect()]
    near = [(f, p, x, y) for f, p, x, y in data if p % 2 == 0
            and any(f == g and p != q and (x - u) * (x - u) + (y - v) * (y - v) < radius * radius for g, q, u, v in data)]
    plain = K.nearby
    monkeypatch.setattr(K, "nearby", lambda rows, *more: (compared.append(rows.count()), plain(rows, *more))[1])
    found = K.touched(points.distinct(), tracks, radius).select("frame", "pedestrian", "x", "y")
    assert sorted(tuple(r) for r in found.collect()) == sorted(set(near)) and 0 < len(set(near)) < points.distinct().count()
    assert sum(compared) < points.distinct().count() / 2


def test_collisions_of_a_crowd(spark, monkeypatch):
    """All at nearly one place: no pair is made."""
    people = 50
    data = [("d", "train", 10 * f, p, f + 0.001 * p, 0.0) for f in range(5) for p in range(people)]
    tracks = freeze(spark.createDataFrame(data, NAMES))
    plain, compared = K.nearby, []
    monkeypatch.setattr(K, "nearby", lambda rows, *more: (compared.append(rows.count()), plain(rows, *more))[1])
    assert K.collisions(freeze(scenes_of(tracks)), tracks, CONFIG).count() == people
    assert sum(compared) == 0


def met_pairs(monkeypatch, join, keys=()):
    """Pairs that are met from now on, one number for each join."""
    pairs, plain = [], getattr(K, join)

    def counted(here, there, on, *more, **named):
        pairs.append(K.group_sizes(here, there, [*on, *keys]).agg(F.sum("_pairs")).first()[0] or 0)
        return plain(here, there, on, *more, **named)

    monkeypatch.setattr(K, join, counted)
    return pairs


def test_one_companion_is_enough(spark, monkeypatch):
    """Whether a scene of a crowd is in a group: it meets a part of the others first, and the rest only if it is not; the same as from all pairs."""
    people, lone = 300, 20
    data = [("d", "train", 10 * f, p, 0.01 * p if p < people else 40.0 * p, 0.001 * (p * f % 7)) for f in range(5) for p in range(people + lone)]
    tracks = freeze(spark.createDataFrame(data, NAMES))
    scenes = freeze(scenes_of(tracks))
    everybody = {r.scene for r in K.group_pairs(scenes, tracks, CONFIG).select("scene").distinct().collect()}
    pairs = met_pairs(monkeypatch, "_met", ("_gx", "_gy"))
    assert {r.scene for r in K.group_flags(scenes, tracks, CONFIG).collect()} == everybody == {1000 + p for p in range(people)}
    assert sum(pairs) < people * people / 3


def test_a_cone_is_not_compared_with_all_in_reach(spark, monkeypatch):
    tracks = freeze(crowd(spark, 500, 3, 11, width=9.9).where("NOT (pedestrian = 3 AND frame = 30)"))
    scenes = freeze(scenes_of(tracks, 3))
    config = CONFIG.but(pred_len=1)
    data = [tuple(r) for r in tracks.collect()]
    want = {p: w for p, w in brute(data, config).items() if w[0]}
    pairs = met_pairs(monkeypatch, "meet")
    found = {r.scene - 1000: (True, r.leader, r.avoidance) for r in K.cone_flags(scenes, tracks, config).collect()}
    at = np.array([(x, y) for _, _, f, _, x, y in data if f == 20])
    assert found == want and 0 < sum(pairs) < (np.hypot(*(at[:, None] - at[None]).T) <= 5).sum()
