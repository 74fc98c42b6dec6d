"""Scenes against a plain loop, known counts, and what must hold for any input."""

import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.catalog import adapter
from pathloom.config import SceneConfig
from pathloom.functions.forecast import kalman_weights
from pathloom.operators import kinds as K
from pathloom.operators import scenes as S
from pathloom.operators.frames import split_frames
from pathloom.operators.pairs import scene_paths
from pathloom.plans import recordings as P
from pathloom.sources.lines import read_lines
from conftest import rows

CONFIG = SceneConfig()


def brute_scenes(data, config):
    """Scenes of plain rows (dataset, frame, pedestrian, x, y) by nested loops."""
    found = []
    for dataset in sorted({r[0] for r in data}):
        here = [r[1:] for r in data if r[0] == dataset]
        key = (lambda f: (f % 100000, f)) if config.order_frames else (lambda f: f)
        frames = sorted({r[0] for r in here}, key=key)
        a = int(len(frames) * config.train_fraction)
        b = a + int(len(frames) * config.val_fraction)
        number = 0
        for split, part in (("train", frames[:a]), ("val", frames[a:b]), ("test", frames[b:])):
            inside = set(part)
            now = [r for r in here if r[0] in inside]
            count, cells, paths = defaultdict(int), defaultdict(list), defaultdict(list)
            for f, p, x, y in now:
                count[f] += 1
                cells[f, x // config.cell_size, y // config.cell_size].append(p)
                paths[p].append((f, x, y))
            close = {(f, p) for (f, _, _), peds in cells.items() if len(peds) > 1 for p in peds}
            for p in sorted(paths):
                path = sorted(paths[p])
                for i in range(0, len(path) - config.chunk_size + 1, config.chunk_stride):
                    w = path[i:i + config.chunk_size]
                    steps = sorted(q[0] - r[0] for r, q in zip(w, w[1:]))
                    if ((w[0][1] - w[-1][1]) ** 2 + (w[0][2] - w[-1][2]) ** 2 > config.min_length
                            and steps[len(steps) // 2] * config.gap_tolerance > steps[-1]
                            and sum(count[f] for f, _, _ in w) >= config.activity * config.chunk_size
                            and any((f, p) in close for f, _, _ in w)):
                        found.append((dataset, split, number, p, w[0][0], w[-1][0]))
                        number += 1
    return found


@pytest.mark.parametrize("config", [
    CONFIG, CONFIG.but(obs_len=4, pred_len=6, chunk_stride=3, cell_size=4.0, min_length=1.0), CONFIG.but(order_frames=True, train_fraction=0.3, val_fraction=0.3),
    CONFIG.but(hot_rows=20, segment_rows=22)], ids=["default", "short", "sessions", "hot"])
def test_against_loops(spark, crowd, config):
    # Some rows twice, some gaps, a second session, and coordinates below zero.
    table = (crowd.where("(frame + 3 * pedestrian) % 110 <> 0").withColumn("x", F.col("x") - 60)
             .unionByName(crowd.where("pedestrian % 4 = 1").withColumn("frame", F.col("frame") + 100_000))
             .unionByName(crowd.where("(frame + pedestrian) % 90 = 0").withColumn("x", F.col("x") - 59)))
    data = [tuple(r) for r in table.select("dataset", "frame", "pedestrian", "x", "y").collect()]
    found = S.scene_rows(S.cut_scenes(split_frames(table, config), config), config)
    got = sorted(tuple(r) for r in found.select("dataset", "split", "scene", "pedestrian", "start", "end").collect())
    want = sorted(brute_scenes(data, config))
    assert len(want) > 2 and got == want


# Windows, then with one more filter each: moved, continuous, active, near.
KNOWN = {"sf0.001": [354, 354, 219, 134, 14], "sf0.01": [3540, 3540, 2147, 2147, 767]}


def filter_counts(tracks, config):
    w = S.candidate_windows(tracks, config).select(S.moved(config).alias("m"), S.continuous(config).alias("c"), S.active(config).alias("a"), F.col("close").alias("n"))
    seen, out = F.lit(True), [F.count("*")]
    for c in "mcan":
        seen = seen & F.col(c)
        out.append(F.count_if(seen))
    return list(w.agg(*out).first())


@pytest.mark.parametrize("scale", sorted(KNOWN))
def test_known_counts(spark, small, scale):
    folder = os.path.join(os.path.dirname(small), scale)
    if not os.path.isdir(folder):
        pytest.skip("no such data here")
    tracks = adapter.tracks_of(adapter.walk(spark, folder), recordings=1, units=100.0)
    assert filter_counts(tracks, CONFIG) == KNOWN[scale]


# Sample recordings, told apart by their number of rows: filter counts for 8+12 and 4+6 rows.
SAMPLES = {
    1200: ([60, 60, 60, 60, 60], [360, 360, 360, 360, 359]), 320: ([16, 15, 15, 15, 10], [96, 89, 89, 88, 58]),
    120: ([6, 5, 5, 4, 0], [36, 28, 28, 25, 0]), 1460: ([73, 61, 61, 61, 43], [438, 360, 360, 358, 208]),
    680: ([34, 34, 34, 34, 19], [204, 204, 204, 203, 83]), 400: ([20, 20, 20, 19, 5], [120, 120, 120, 112, 15]),
    480: ([24, 22, 22, 21, 8], [144, 129, 129, 121, 33]), 1520: ([76, 66, 66, 54, 29], [456, 378, 378, 321, 157]),
    900: ([45, 31, 31, 31, 25], [270, 186, 186, 186, 128]), 20: ([1, 1, 1, 0, 0], [6, 6, 6, 0, 0]),
    1500: ([75, 75, 75, 75, 64], [450, 449, 449, 449, 367]), 1260: ([63, 63, 63, 63, 51], [378, 378, 378, 378, 282])}
# Split first: (rows, scenes, rows kept, rows kept with only the first 4 frames visible) of train, val, test.
SPLITS = {
    1200: "851/230/851/647 192/0/0/0 157/16/157/112", 320: "279/39/263/168 26/0/0/0 15/0/0/0", 120: "100/0/0/0 11/0/0/0 9/0/0/0",
    1460: "894/108/824/713 305/34/305/248 261/37/255/242", 680: "426/42/338/295 150/17/120/90 104/11/82/60", 400: "175/0/0/0 128/7/80/50 97/4/37/19",
    480: "339/33/313/262 85/0/0/0 56/0/0/0", 1520: "1040/125/667/597 136/0/0/0 344/32/270/192", 900: "539/62/447/307 184/0/0/0 177/0/0/0",
    20: "12/0/0/0 4/0/0/0 4/0/0/0", 1500: "908/182/908/794 373/55/373/230 219/27/219/168", 1260: "830/178/830/751 285/38/285/174 145/5/136/107"}


@pytest.fixture(scope="module")
def samples(spark):
    """Set TRACK_SAMPLES to a glob of space-separated sample recordings to run these."""
    glob = os.environ.get("TRACK_SAMPLES")
    if not glob:
        pytest.skip("TRACK_SAMPLES is not set")
    tracks = read_lines(spark, glob, "spaced").persist()
    return tracks, {r["dataset"]: r["count"] for r in tracks.groupBy("dataset").count().collect()}


@pytest.mark.parametrize("place, sizes", [(0, (8, 12)), (1, (4, 6))])
def test_sample_filters(samples, place, sizes):
    tracks, names = samples
    config = CONFIG.but(obs_len=sizes[0], pred_len=sizes[1])
    assert len(names) == 12
    w = S.candidate_windows(tracks, config).select("dataset", S.moved(config).alias("m"), S.continuous(config).alias("c"), S.active(config).alias("a"), F.col("close").alias("n"))
    seen, out = F.lit(True), [F.count("*").alias("0")]
    for c in "mcan":
        seen = seen & F.col(c)
        out.append(F.count_if(seen).alias(c))
    got = {names[r[0]]: list(r[1:]) for r in w.groupBy("dataset").agg(*out).collect()}
    assert got == {n: both[place] for n, both in SAMPLES.items()}


def test_sample_splits(samples):
    tracks, names = samples
    config = CONFIG.but(obs_len=4, pred_len=6)
    split, scenes = P.prepare(tracks, config)
    frames = lambda all_: scenes.select("dataset", "split", F.explode(F.col("path.frame") if all_ else F.slice(F.col("path.frame"), 1, 4)).alias("frame")).distinct()
    keep = lambda all_: split.join(frames(all_), ["dataset", "split", "frame"], "left_semi")
    tables = [{(names[r[0]], r[1]): r[2] for r in t.groupBy("dataset", "split").count().collect()} for t in (split, scenes, keep(True), keep(False))]
    for n, text in SPLITS.items():
        want = [[int(v) for v in part.split("/")] for part in text.split()]
        assert [[t.get((n, s), 0) for t in tables] for s in ("train", "val", "test")] == want


@pytest.fixture(scope="module")
def result(spark, small):
    tracks = adapter.tracks(spark, os.path.join(os.path.dirname(small), "sf0.01")) if os.path.isdir(os.path.join(os.path.dirname(small), "sf0.01")) else adapter.tracks(spark, small)
    return tracks, P.convert(tracks, CONFIG.but(acceptance=(0.5, 1.0, 0.8, 0.9)))


def test_ids_are_consecutive_over_the_splits(result):
    for (dataset,) in result[1].scenes.select("dataset").distinct().collect():
        ids = [[r["scene"] for r in result[1].scenes.where((F.col("dataset") == dataset) & (F.col("split") == s)).orderBy("scene").collect()] for s in ("train", "val", "test_private", "test")]
        assert ids[2] == ids[3]
        assert ids[0] + ids[1] + ids[2] == list(range(sum(map(len, ids[:3]))))


def test_scenes_are_whole(result):
    scenes = result[1].scenes
    assert scenes.where(F.size("frames") != CONFIG.chunk_size).isEmpty()
    assert scenes.where("start <> frames[0] OR end <> frames[20]").isEmpty()
    assert scenes.where("split <> 'test' AND tag NOT BETWEEN 1 AND 4").isEmpty()
    assert scenes.where("split <> 'test' AND (tag = 3) <> (size(sub_tags) > 0)").isEmpty()
    assert scenes.where("split = 'test' AND (tag <> 0 OR sub_tags IS NOT NULL)").isEmpty()


def test_public_test_shows_a_part_of_private_test(result):
    frames = lambda s: {tuple(r) for r in result[1].tracks.where(F.col("split") == s).select("dataset", "frame", "pedestrian").collect()}
    assert frames("test") < frames("test_private")


def test_layout_does_not_matter(result):
    tracks, first = result
    again = P.convert(tracks.repartition(13, "frame"), CONFIG.but(acceptance=(0.5, 1.0, 0.8, 0.9)))
    flat = lambda r: (rows(r.scenes.withColumn("frames", F.to_json("frames")).withColumn("sub_tags", F.to_json("sub_tags"))), rows(r.tracks))
    assert flat(again) == flat(first)


def test_optional_filters_drop_scenes(result):
    tracks, _ = result
    split, scenes = P.prepare(tracks, CONFIG)
    for change in (dict(all_present=True), dict(drop_collisions=True, collision_radius=0.6), dict(distinct_starts=True)):
        kept = P.prefilter(scenes, split, CONFIG.but(**change)).count()
        assert 0 < kept < scenes.count()


def test_no_test_part(result):
    tracks, _ = result
    config = CONFIG.but(train_fraction=0.8, val_fraction=0.2)
    split, scenes = P.prepare(tracks, config)
    assert {r["split"] for r in P.select(scenes, split, config).select("split").distinct().collect()} == {"train", "val"}


def test_nothing_to_cut_is_an_error(crowd):
    with pytest.raises(ValueError, match="no scenes"):
        P.convert(crowd, CONFIG.but(activity=1e9))


def test_scene_paths_with_everybody(spark, small, crowd):
    split, scenes = P.prepare(crowd, CONFIG)
    found = scene_paths(scenes, split)
    for row in scenes.select("scene", "dataset", "split", "pedestrian", F.col("path.frame").alias("f")).collect():
        want = split.where((F.col("dataset") == row["dataset"]) & (F.col("split") == row["split"]) & F.col("frame").isin(row["f"])).count()
        assert found.where((F.col("dataset") == row["dataset"]) & (F.col("scene") == row["scene"])).count() == want
        break
    assert scene_paths(scenes, split, 1e6).count() == found.count()


def kalman(z, horizon, process=1e-5, measure=0.05 ** 2):
    """The filter itself, on one coordinate."""
    move, mean, cov = np.array([[1.0, 1.0], [0.0, 1.0]]), np.array([z[0], z[1] - z[0]]), np.eye(2)
    for k, seen in enumerate(z):
        if k:
            mean, cov = move @ mean, move @ cov @ move.T + process * np.eye(2)
        gain = cov[:, 0] / (cov[0, 0] + measure)
        mean, cov = mean + gain * (seen - mean[0]), cov - np.outer(gain, cov[0])
    return (np.linalg.matrix_power(move, horizon) @ mean)[0]


@pytest.mark.parametrize("obs_len", [2, 4, 9])
def test_forecast_weights_are_the_filter(obs_len):
    rng = np.random.default_rng(3)
    weights = kalman_weights(obs_len, 12)
    assert sum(weights) == pytest.approx(1)
    for _ in range(50):
        z = np.cumsum(rng.normal(size=obs_len))
        assert np.dot(weights, z) == pytest.approx(kalman(z, 12), abs=1e-9)


def test_short_test_scene_is_found(result):
    tracks, done = result
    cut = done.tracks.where("split <> 'test' OR frame % 100 = 0")
    short = K.short_test_scenes(done.scenes, cut, CONFIG)
    assert short.count() == done.scenes.where("split = 'test'").count()
    with pytest.raises(ValueError, match="adequate length"):
        P.require_test_length(P.SceneSet(done.scenes, cut), CONFIG)


def test_forecast_check(spark):
    """One scene of two: exact forecasts pass, a short one, a far one and a far end do not;
    a pedestrian who is not there at the end cannot fail."""
    config = CONFIG.but(obs_len=2, pred_len=3)
    path = [(10 * k, float(k), 0.0) for k in range(5)]
    names = ["exact", "short", "far", "end", "absent"]
    scenes = spark.createDataFrame([(n, "train", 0, 1, path) for n in names], "dataset string, split string, scene long, pedestrian long, path array<struct<frame: long, x: double, y: double>>")
    tracks = [(n, "train", f, 1, x, y) for n in names for f, x, y in path]
    tracks += [(n, "train", f, 2, x, 9.0) for n in names for f, x, y in path if not (n == "absent" and f > 20)]
    tracks = spark.createDataFrame(tracks, "dataset string, split string, frame long, pedestrian long, x double, y double")
    off = {"far": [0.15, 0.15, 0.15], "end": [0.0, 0.0, 0.25], "absent": [5.0, 5.0, 5.0]}
    data = [(n, 0, i, p, t, 2.0 + t + (off.get(n, [0.0] * 3)[t] if p == 2 else 0.0), 0.0 if p == 1 else 9.0)
            for n in names for i in (0, 1) for p in (1, 2) for t in range(3) if not (n == "short" and p == 1 and i == 1 and t == 2)]
    forecasts = spark.createDataFrame(data, "dataset string, scene long, iter long, pedestrian long, t long, x double, y double")
    found = {r["dataset"]: r["is_invalid"] for r in K.forecast_check(scenes, tracks, forecasts, config).collect()}
    assert found == {"exact": False, "short": True, "far": True, "end": True, "absent": False}


def test_only_whole_forecasts_meet_the_truth(spark, monkeypatch):
    """Forecasts of a crowd, nearly all too short: only whole ones are kept for the truth. Two rows in a frame count as two steps."""
    config = CONFIG.but(obs_len=2, pred_len=3)
    path = [(10 * k, float(k), 0.0) for k in range(5)]
    schema = "dataset string, split string, frame long, pedestrian long, x double, y double"
    scenes = spark.createDataFrame([("d", "train", s, 1, path) for s in (0, 1)], "dataset string, split string, scene long, pedestrian long, path array<struct<frame: long, x: double, y: double>>")
    tracks = [("d", "train", f, p, x, float(p)) for f, x, _ in path for p in range(1, 42)] + [("d", "train", 30, 41, 3.0, 99.0)]
    data = [("d", 0, i, 1, t, 2.0 + t, 1.0) for i in (0, 1) for t in range(3)]  # the primary, in both iterations
    data += [("d", 0, 0, p, t, 9.0, 9.0) for p in range(2, 41) for t in range(2)]  # far off, but two steps only
    whole = data + [("d", 1, 0, 41, t, 9.0, 9.0) for t in (1, 2)] + [("d", 1, 0, 1, t, 2.0 + t, 1.0) for t in range(3)]  # two steps, three rows
    stored, freeze = [], K.freeze
    monkeypatch.setattr(K, "freeze", lambda rows: stored.append(freeze(rows)) or stored[-1])
    found = K.forecast_check(scenes, spark.createDataFrame(tracks, schema), spark.createDataFrame(whole, "dataset string, scene long, iter long, pedestrian long, t long, x double, y double"), config)
    assert sorted(tuple(r) for r in found.collect()) == [("d", 0, False, 2), ("d", 1, True, 1)]
    kept = [rows.where("compared").count() for rows in stored if "compared" in rows.columns]
    assert kept == [3 + 3 + 3 + 2]
