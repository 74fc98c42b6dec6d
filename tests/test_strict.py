"""What must not be lost without a word, and rules that hold for every size of table."""

import random
import re
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pathloom.config import SceneConfig
from pathloom.operators import kinds as K
from pathloom.operators import scenes as S
from pathloom.operators.frames import split_frames
from pathloom.operators.resample import resample
from pathloom.operators import selection
from pathloom.operators.selection import accept, acceptance_stats, drop_invalid, renumber
from pathloom.operators.synth import trim_at_goal
from pathloom.plans.recordings import convert, convert_mixed, missing_parts, require_scenes, retype
from pathloom.sinks.writers import write_buckets, write_ndjson, write_tables
from pathloom.sources import files
from pathloom.sources.lines import parse_lines
from pathloom.sources.tables import ndjson_parts, parse_ndjson_scenes
from pathloom.storage import co_partitioned, freeze, scratch, work_folder

CONFIG = SceneConfig()


@pytest.fixture(scope="module")
def copied(spark, crowd):
    """The crowd with eight tracks four times each."""
    some = [r.pedestrian for r in crowd.select("pedestrian").distinct().orderBy("pedestrian").limit(8).collect()]
    more = [crowd.where(F.col("pedestrian").isin(some)).withColumn("pedestrian", F.col("pedestrian") + 10000 * k) for k in (1, 2, 3)]
    tracks = crowd
    for part in more:
        tracks = tracks.unionByName(part)
    split = freeze(split_frames(tracks, CONFIG))
    return split, freeze(S.scene_rows(S.cut_scenes(split, CONFIG).withColumn("path_kind", K.path_kind(CONFIG)), CONFIG))


@pytest.mark.parametrize("part", ["pedestrian >= 10000", "pedestrian >= 20000 OR pedestrian < 10000", "scene % 3 = 0", "true"])
def test_copies_rule_does_not_depend_on_the_scenes_given(copied, part):
    split, scenes = copied
    some = scenes.where(part)
    found = [rows(K.type_scenes(some, split, CONFIG.but(hot_copies=most)).select("dataset", "scene", "tag", F.sort_array("sub_tags").alias("s"))) for most in (3, 1000)]
    assert found[0] == found[1] and found[0]


def test_ids_are_those_of_the_order(copied):
    _, scenes = copied
    table = scenes.select("dataset", "split", "pedestrian", "start", "end", "scene").collect()
    place = {"train": 0, "val": 1, "test": 2}
    for dataset in {r.dataset for r in table}:
        own = sorted((r for r in table if r.dataset == dataset), key=lambda r: r.scene)
        assert [r.scene for r in own] == list(range(len(own)))
        assert [(place[r.split], r.pedestrian, r.start) for r in own] == sorted((place[r.split], r.pedestrian, r.start) for r in own)
    some = renumber(scenes.where("scene % 3 = 1")).select("dataset", "scene", "pedestrian", "start").collect()
    for dataset in {r.dataset for r in some}:
        own = sorted((r.scene, r.pedestrian, r.start) for r in some if r.dataset == dataset)
        old = sorted((r.scene, r.pedestrian, r.start) for r in table if r.dataset == dataset and r.scene % 3 == 1)
        assert [o[1:] for o in own] == [o[1:] for o in old] and [o[0] for o in own] == list(range(len(own)))


def test_numbering_moves_no_path_by_range(copied, crowd):
    split, _ = copied
    text = S.scene_rows(S.cut_scenes(split, CONFIG), CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text


def test_stored_scenes_are_typed_alike(spark, copied, tmp_path):
    split, scenes = copied
    write_ndjson(scenes, split.limit(0), str(tmp_path / "s"))
    stored = parse_ndjson_scenes(ndjson_parts(spark, str(tmp_path / "s"))).drop("tag", "sub_tags")
    columns = ("dataset", "split", "scene", "tag")
    assert rows(retype(stored, split, CONFIG).select(*columns)) == rows(K.type_scenes(scenes, split, CONFIG).select(*columns))
    assert rows(S.with_paths(stored, split).select("dataset", "scene", F.to_json("path").alias("p"))) == rows(scenes.select("dataset", "scene", F.to_json("path").alias("p")))


def above(text, mark):
    """The operators of a plan that the first line with ``mark`` feeds, from the nearest on."""
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if mark in line)
    indent = lambda line: len(line) - len(line.lstrip(" :+-|"))
    found, depth = [], indent(lines[at])
    for line in lines[at::-1]:
        if indent(line) < depth:
            depth = indent(line)
            found.append(line.lstrip(" :+-|*"))
    return found


def test_paths_of_stored_scenes_shuffle_no_buckets(spark, copied, tmp_path):
    """Neither a shuffle of tracks in buckets, nor a range of frames after an equi-join."""
    split, scenes = copied
    write_buckets(split, "tracks_in_buckets", str(tmp_path / "b"), 8)
    stored = scenes.drop("path", "tag", "sub_tags")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with co_partitioned(spark):
            found = S.with_paths(stored, spark.table("tracks_in_buckets"))
            text = found._jdf.queryExecution().executedPlan().toString()
            got = rows(found.select("dataset", "scene", F.to_json("path").alias("p")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == rows(scenes.select("dataset", "scene", F.to_json("path").alias("p"))) and got
    over = above(text, "Bucketed: true")
    assert any(o.startswith("Window") for o in over) and not any("Exchange" in o for o in over)
    assert not re.search(r"Join \[[^\]]*\], \[[^\]]*\], \w+, \(", text)
    spark.sql("DROP TABLE tracks_in_buckets")


def test_paths_of_busy_pedestrians_and_odd_scenes(spark):
    """Hot pedestrians in pieces, several rows in a frame, scenes without their start and shorter ones."""
    data = [("d", "train", 1, 10 * (k - (k == 7)), float(k), 0.0) for k in range(60)] + [("d", "train", 2, 10 * k, 0.0, float(k)) for k in range(5)]
    tracks = spark.createDataFrame(data, "dataset string, split string, pedestrian long, frame long, x double, y double")
    scenes = spark.createDataFrame([("d", "train", 1, 0, 0, 40), ("d", "train", 1, 1, 300, 340), ("d", "train", 1, 2, 560, 590), ("d", "train", 1, 3, 5, 40), ("d", "train", 2, 4, 10, 90),
                                    ("d", "train", 1, 5, 60, 90)], "dataset string, split string, pedestrian long, scene long, start long, end long")
    for sizes in (dict(), dict(hot_rows=10, segment_rows=7)):
        found = {r.scene: [(p.frame, p.x) for p in r.path] for r in S.with_paths(scenes, tracks, 5, **sizes).collect()}
        assert found == {0: [(10 * k, float(k)) for k in range(5)], 1: [(10 * k, float(k)) for k in range(30, 35)], 2: [(10 * k, float(k)) for k in range(56, 60)],
                         4: [(10 * k, 0.0) for k in range(1, 5)], 5: [(60, 6.0), (60, 7.0), (80, 8.0), (90, 9.0)]}


def test_conversions_count_on_the_way(crowd, tmp_path):
    result = convert(crowd, CONFIG.but(acceptance=(0.5, 0.5, 0.5, 0.5)))
    counts = result.write(str(tmp_path / "out")).collect()
    kept = {(r.dataset, r.split, r.tag): r.n for r in result.scenes.where("split <> 'test'").groupBy("dataset", F.regexp_replace("split", "test_private", "test").alias("split"), "tag").agg(
        F.count("*").alias("n")).collect()}
    assert {(r.dataset, r.split, r.tag): r.n_kept for r in counts if r.n_kept} == kept and sum(r.n_rejected for r in counts) > 0
    assert all(r.n_total == r.n_kept + r.n_rejected for r in counts)


def test_counts_of_too_many_keys_are_not_taken(spark, monkeypatch):
    monkeypatch.setattr(selection, "MOST_KEYS", 3)
    monkeypatch.setattr(selection, "ROOM", 8)
    for n, exact in ((3, True), (60, False)):
        scenes, seen = selection.passing(spark.range(n).select(F.col("id").cast("string").alias("dataset"), F.lit("train").alias("split"), F.lit(1).alias("tag")))
        freeze(scenes)
        found = selection.seen_counts(seen)
        assert (found is not None) == exact and (not exact or sum(found.values()) == n)


def test_settings_per_recording(crowd):
    stride, plain = CONFIG.but(chunk_stride=4, fps=5.0), CONFIG
    both = freeze(crowd.withColumn("dataset", F.explode(F.array(F.lit("a"), F.lit("b")))))
    mixed = convert_mixed(both, {"a": stride}, plain).scenes
    alone = {"a": convert(both.where("dataset = 'a'"), stride), "b": convert(both.where("dataset = 'b'"), plain)}
    columns = ("split", "scene", "pedestrian", "start", "fps", "tag")
    for dataset, want in alone.items():
        assert rows(mixed.where(F.col("dataset") == dataset).select(*columns)) == rows(want.scenes.select(*columns))


def test_scenes_without_forecasts_are_not_valid(spark, copied):
    split, scenes = copied
    some = scenes.limit(6)
    none = spark.createDataFrame([], "dataset string, scene long, iter long, pedestrian long, t long, x double, y double")
    assert drop_invalid(some, split, none, CONFIG).collect() == []
    steps = some.select("dataset", "scene", "pedestrian", F.posexplode(F.slice("path", 10, 12)).alias("t", "p"))
    exact = steps.select("dataset", "scene", F.lit(0).alias("iter"), "pedestrian", F.col("t").cast("long").alias("t"), "p.x", "p.y")
    exact = exact.withColumn("iter", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))))
    lacking = exact.where("NOT (scene % 2 = 0 AND iter = 4)")
    assert drop_invalid(some, split, exact, CONFIG).count() == some.count()
    assert {r.scene % 2 for r in drop_invalid(some, split, lacking, CONFIG).collect()} <= {1}


def test_parts_without_scenes(spark, copied):
    split, scenes = copied
    assert require_scenes(scenes) is scenes
    without = scenes.where("NOT (dataset = 'plaza' AND split = 'val')")
    assert ("plaza", "val") in {tuple(r) for r in missing_parts(without, split).collect()}
    with pytest.raises(ValueError, match="plaza/val"):
        require_scenes(without, split)


def test_acceptance_counts(copied):
    split, scenes = copied
    typed = freeze(K.type_scenes(scenes, split, CONFIG))
    found = acceptance_stats(typed, accept(typed, CONFIG)).collect()
    assert sum(r.n_total for r in found) == scenes.count() and all(r.n_total == r.n_kept + r.n_rejected for r in found)


def test_goal_at_the_start_does_not_count(spark):
    path = spark.createDataFrame([("d", 0, 0, s, float(s), 0.0) for s in range(6)], "dataset string, scene long, pedestrian long, step long, x double, y double")
    goals = spark.createDataFrame([("d", 0, 0, 0.2, 0.0)], "dataset string, scene long, pedestrian long, gx double, gy double")
    assert sorted(r.step for r in trim_at_goal(path, goals).collect()) == [0, 1]


def test_malformed_lines_raise_by_default(spark):
    lines = spark.createDataFrame([("/a/b.txt", "1 2 3.0 4.0"), ("/a/b.txt", "1 two 3.0 4.0")], "path string, value string")
    with pytest.raises(Exception, match="not a number"):
        parse_lines(lines, "spaced").collect()
    assert parse_lines(lines, "spaced", mode="DROP").count() == 1


def test_repeated_control_frames(spark):
    points = [("d", 1, 0.0, 0.0, 0), ("d", 1, 10.0, 0.0, 20), ("d", 1, 20.0, 0.0, 20), ("d", 1, 30.0, 0.0, 45)]
    table = spark.createDataFrame(points, "dataset string, pedestrian long, x double, y double, f long")
    assert sorted(r.frame for r in resample(table).collect()) == [10, 20, 30, 40]
    many = spark.createDataFrame([("d", 2, float(k), 0.0, 10 * min(k, 6)) for k in range(8)], table.schema)
    with pytest.raises(Exception, match="two control points"):
        resample(many).collect()


def test_empty_files_use_up_ids(spark, tmp_path):
    for name, text in (("a", "TRACK.R1=[[1 2 3];[1 2 6]];\n"), ("b", ""), ("c", "TRACK.R1=[[1 2 3];[1 2 4]];\n")):
        (tmp_path / f"{name}.txt").write_text(text)
    found = {r.pedestrian for r in files.read_edinburgh(spark, str(tmp_path / "*.txt")).collect()}
    assert found == {1, 2_000_001}


def test_folders_get_few_files(spark, tmp_path):
    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.choice(["train", "val"]), i) for i in range(4000)]
    write_tables(spark.createDataFrame(data, "dataset string, split string, n long").repartition(16), str(tmp_path / "t"))
    for folder in (tmp_path / "t").glob("dataset=*/split=*"):
        assert len(list(folder.glob("*.parquet"))) <= 2


def test_scratch_leaves_only_what_was_written(spark, crowd, tmp_path):
    place = Path(work_folder(spark).removeprefix("file:"))
    before = set(place.iterdir())
    with scratch(spark):
        result = convert(crowd, CONFIG)
        result.write(str(tmp_path / "out"))
        assert set(place.iterdir()) - before
    assert set(place.iterdir()) == before
    assert spark.read.parquet(str(tmp_path / "out" / "scenes")).count() > 0
