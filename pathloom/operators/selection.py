"""Choosing scenes by type, renumbering them and counting what came out."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pathloom.config import SceneConfig
from pathloom.functions.draws import uniform
from pathloom.operators.kinds import collisions, first_of_start, forecast_check, presence
from pathloom.operators.ordered import number_in_order
from pathloom.storage import broadcast_if_small, freeze

# Names of the four interaction kinds, in their order.
KIND_NAMES = ("LF", "CA", "Group", "Others")


def accept(scenes: DataFrame, config: SceneConfig) -> DataFrame:
    """Keep a scene with the probability its type has. The draw hashes the scene's key."""
    chance = F.element_at(F.lit([float(p) for p in config.acceptance]), F.col("tag"))
    return scenes.where(uniform(config.seed, F.col("dataset"), F.col("scene")) < chance)


def prefilter(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """The optional filters that come before typing."""
    if config.distinct_starts:
        scenes = first_of_start(scenes)
    if config.drop_collisions:
        scenes = scenes.join(collisions(scenes, tracks, config), ["dataset", "scene"], "left_anti")
    if config.all_present:
        whole = presence(scenes, tracks, config).where("all_present")
        scenes = scenes.join(whole, ["dataset", "scene"], "left_semi")
    return scenes


def drop_invalid(scenes: DataFrame, tracks: DataFrame, forecasts: DataFrame, config: SceneConfig) -> DataFrame:
    """Keep accepted scenes that every iteration of their re-simulation reproduces. A scene
    that lacks ``config.forecast_iterations`` iterations, or has none, is not kept."""
    good = forecast_check(scenes, tracks, forecasts, config).where(~F.col("is_invalid") & (F.col("n_iter") >= config.forecast_iterations))
    return scenes.join(good, ["dataset", "scene"], "left_semi")


def renumber(scenes: DataFrame, stored: bool = False) -> DataFrame:
    """Consecutive ids again, over the accepted scenes of all splits. The old ids have the
    order already, so only they are put in order; the scenes follow by a join. They are read twice,
    so they are stored, unless they are a ``stored`` table."""
    scenes = scenes if stored else freeze(scenes)
    ids = number_in_order(scenes.select("dataset", "scene"), ["dataset"], ["scene"], "_new")
    return scenes.join(broadcast_if_small(ids), ["dataset", "scene"]).drop("scene").withColumnRenamed("_new", "scene")


def acceptance_stats(typed: DataFrame, kept: DataFrame) -> DataFrame:
    """Scenes in all, kept and rejected per dataset, split and type. ``kept`` is what the draw
    and the checks left of ``typed``, with the scene ids of before renumbering."""
    marked = typed.select("dataset", "scene", "split", "tag").join(
        kept.select("dataset", "scene", F.lit(True).alias("_kept")), ["dataset", "scene"], "left")
    return marked.groupBy("dataset", "split", "tag").agg(
        F.count("*").alias("n_total"), F.count("_kept").alias("n_kept"), F.count_if(F.col("_kept").isNull()).alias("n_rejected"))


# Most keys that are counted while rows pass by; with more, counting takes a job of its own.
MOST_KEYS, ROOM = 10_000, 100_000
PART = ("dataset", "split", "tag")


def passing(scenes: DataFrame) -> tuple[DataFrame, Observation]:
    """The scenes, counted per dataset, split and type by whatever job runs over them first: the result of an
    ``approx_top_k``, which is exact for fewer keys than it has room for, and their number."""
    seen, key = Observation(), F.to_json(F.struct(*PART), {"ignoreNullFields": "false"})
    counts = F.expr(f"approx_top_k(_key, {MOST_KEYS}, {ROOM})").alias("counts")
    return scenes.withColumn("_key", key).observe(seen, counts, F.count(F.lit(1)).alias("n")).drop("_key"), seen


def seen_counts(seen: Observation) -> dict[str, int] | None:
    """What ``passing`` has counted, by key; None if there were too many keys."""
    got = seen.get
    counts = {row["item"]: row["count"] for row in got.get("counts") or []}
    return counts if sum(counts.values()) == got.get("n", 0) else None


def seen_stats(spark: SparkSession, total: Observation, kept: Observation) -> DataFrame | None:
    """``acceptance_stats`` from two observations, without another job; None if they had too many keys."""
    all_, left = seen_counts(total), seen_counts(kept)
    if all_ is None or left is None:
        return None
    rows = [(*(json.loads(k)[c] for c in PART), n, left.get(k, 0), n - left.get(k, 0)) for k, n in all_.items()]
    return spark.createDataFrame(rows, "dataset string, split string, tag int, n_total long, n_kept long, n_rejected long")


def tag_stats(scenes: DataFrame) -> DataFrame:
    """Scenes per dataset, split and type, and per interaction kind (NULL in the rows for
    the type as a whole)."""
    both = F.array_union(F.array(F.lit(None).cast("int")), F.coalesce("sub_tags", F.array().cast("array<int>")))
    names = F.lit(list(KIND_NAMES))
    return (scenes.select("dataset", "split", "tag", F.explode(both).alias("sub_tag"))
            .groupBy("dataset", "split", "tag", "sub_tag").agg(F.count("*").alias("n_scenes"))
            .withColumn("kind", F.get(names, F.col("sub_tag") - 1)))
