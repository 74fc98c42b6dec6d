"""Joins whose result is all pairs of scenes and people."""

from pyspark.sql import functions as F

from conftest import rows
from pathloom.config import SceneConfig
from pathloom.functions.draws import jitter
from pathloom.operators.pairs import FRAME, meet, near_steps, nearby, neighbors, noisy_observations, scene_paths, scene_steps

CONFIG = SceneConfig()
PEOPLE = 300


def standing(spark, people=PEOPLE, apart=0.01):
    """Tracks of people who stand in a row for 21 frames, and a scene of each, in one partition."""
    tracks = spark.range(people).select(
        F.lit("a").alias("dataset"), F.lit("train").alias("split"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(20).cast("bigint"))).alias("frame"),
        F.col("id").alias("pedestrian"), (F.col("id") * apart).alias("x"), F.lit(0.0).alias("y")).coalesce(1)
    scenes = (tracks.groupBy("dataset", "split", "pedestrian").agg(F.sort_array(F.collect_list(F.struct("frame", "x", "y"))).alias("path"))
              .withColumn("scene", F.col("pedestrian")).coalesce(1))
    return scenes, tracks


def largest(found):
    return found.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()


def test_tasks_follow_the_pairs(spark):
    scenes, tracks = standing(spark)
    pairs = PEOPLE * (PEOPLE - 1)
    most, all_rows = largest(scene_paths(scenes, tracks).where("NOT is_primary"))
    assert all_rows == 21 * pairs and most < all_rows
    most, all_rows = largest(noisy_observations(scenes, tracks, CONFIG.but(obs_len=14), iterations=2).where("pedestrian <> scene"))
    assert all_rows == 2 * 14 * pairs and most < all_rows
    most, all_rows = largest(neighbors(scenes, tracks, 5.0, 9, 21))
    assert all_rows == 12 * pairs and most < all_rows


def test_a_crowded_frame_is_dealt_to_several_tasks(spark):
    scenes, tracks = standing(spark, 40)
    steps = scene_steps(scenes.unionByName(scenes.withColumn("scene", F.col("scene") + 1000)), 0, 1)
    people = tracks.select(*FRAME, F.col("pedestrian").alias("other"))
    plain = steps.join(people, list(FRAME))
    shared = meet(steps, people, FRAME, task_pairs=100, share_pairs=100)
    assert rows(shared) == rows(plain)
    assert largest(shared)[0] < plain.count()


def test_near_steps_are_those_of_nearby(spark):
    scenes, tracks = standing(spark, 60, 0.7)
    left = tracks.withColumn("x", -F.col("x")).withColumn("y", F.col("y") - 3.0).withColumn("pedestrian", F.col("pedestrian") + 60)
    steps, everybody = scene_steps(scenes, 0, 3), tracks.unionByName(left)
    found = near_steps(steps, everybody, 5.0)
    assert rows(found) == rows(nearby(steps, everybody, 5.0).select(found.columns))
    assert found.count() > 0


def test_draws_are_those_of_the_whole_key(spark):
    scenes, tracks = standing(spark, 5)
    found = noisy_observations(scenes, tracks, CONFIG, iterations=3, thresh=0.5)
    seen = scene_paths(scenes, tracks).where("t < 9").withColumn("iter", F.explode(F.sequence(F.lit(0), F.lit(2))))
    key = [F.col(c) for c in ("dataset", "scene", "pedestrian", "t", "iter")]
    want = seen.select(*[c for c in found.columns if c not in "xy"], *[jitter(F.col(c), 0.5, CONFIG.seed, *key, c).alias(c) for c in ("x", "y")])
    assert rows(found) == rows(want.select(found.columns))
    assert found.schema["iter"].dataType == want.schema["iter"].dataType
