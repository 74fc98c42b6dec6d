"""From track tables of any number of recordings to typed, selected scenes."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.config import NO_HOT_ROWS, SceneConfig
from pathloom.operators.frames import split_frames
from pathloom.operators.kinds import path_kind, short_test_scenes, type_scenes
from pathloom.operators.scenes import cut_scenes, kept_frames, scene_rows, tracks_of_frames, with_paths, with_public_test
from pathloom.operators.selection import accept, acceptance_stats, drop_invalid, passing, prefilter, renumber, seen_stats, tag_stats
from pathloom.sinks.writers import write_ndjson, write_tables
from pathloom.storage import co_partitioned, freeze


@dataclass(frozen=True)
class SceneSet:
    """Scenes and the track rows they show, over train, val, test_private and test. ``counts`` are the scenes in all, kept and
    rejected per dataset, split and type, as the conversion has counted them on the way; None for a set that was put together otherwise."""

    scenes: DataFrame
    tracks: DataFrame
    counts: DataFrame | None = None

    def write(self, folder: str) -> DataFrame | None:
        """Parquet in ``scenes`` and ``tracks``; returns the counts."""
        write_tables(self.scenes, f"{folder}/scenes")
        write_tables(self.tracks, f"{folder}/tracks")
        return self.counts

    def write_ndjson(self, folder: str) -> DataFrame | None:
        write_ndjson(self.scenes, self.tracks, folder)
        return self.counts


def prepare(tracks: DataFrame, config: SceneConfig, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split by frame, cut and number scenes: (tracks with their split, scenes).

    The tracks are read by several steps, so they are stored once, already parsed, unless they
    are a ``stored`` table. The
    part of the type that a path alone decides is stored with the scenes.
    """
    split = split_frames(tracks if stored else freeze(tracks), config)
    return split, scene_rows(cut_scenes(split, config).withColumn("path_kind", path_kind(config)), config)


def sized(config: SceneConfig, rows: int) -> SceneConfig:
    """The settings for a table of so many rows: where no group in it can be hot, none is looked
    for. A step repeats a row at most once, for the public test twin."""
    return config.but(hot_rows=NO_HOT_ROWS if 2 * rows <= config.hot_rows else config.hot_rows,
                      hot_copies=NO_HOT_ROWS if rows <= config.hot_copies else config.hot_copies,
                      crowded=NO_HOT_ROWS if rows <= config.crowded else config.crowded)


def publish(scenes: DataFrame, split: DataFrame, config: SceneConfig) -> SceneSet:
    """The scenes with the public test twin, and the tracks any of them shows."""
    published = with_public_test(scenes)
    return SceneSet(published, tracks_of_frames(split, kept_frames(published, config), config.hot_rows))


def select(scenes: DataFrame, split: DataFrame, config: SceneConfig, forecasts: DataFrame | None = None) -> DataFrame:
    """Type the scenes and keep those the acceptance rates and the checks let through, with
    consecutive ids again. The draw comes before the costly check."""
    return select_counted(scenes, split, config, forecasts)[0]


def select_counted(scenes: DataFrame, split: DataFrame, config: SceneConfig, forecasts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``select``, and the scenes in all, kept and rejected per dataset, split and type. They are counted while the chosen scenes
    are stored; only with very many datasets by a job of their own."""
    if not config.has_test:
        scenes = scenes.where(F.col("split") != "test")
    plain = type_scenes(prefilter(scenes, split, config), split, config)
    typed, total = passing(plain)
    kept = accept(typed, config)
    if forecasts is not None:
        kept = drop_invalid(freeze(kept), split, forecasts, config)
    kept, left = passing(kept)
    kept = freeze(kept)
    counts = seen_stats(scenes.sparkSession, total, left)
    return renumber(kept, stored=True), acceptance_stats(plain, kept) if counts is None else counts


def missing_parts(scenes: DataFrame, split: DataFrame) -> DataFrame:
    """The parts (``dataset, split``) of recordings that have rows but no scene."""
    part = ["dataset", "split"]
    return split.select(*part).distinct().join(scenes.select(*part).distinct(), part, "left_anti")


def require_scenes(scenes: DataFrame, split: DataFrame | None = None) -> DataFrame:
    """The scenes, if there are any; with the tracks ``split`` also in each of their parts."""
    if scenes.isEmpty():
        raise ValueError("no scenes found")
    if split is not None and (missing := missing_parts(scenes, split).take(5)):
        raise ValueError(f"no scenes found in {', '.join(f'{r.dataset}/{r.split}' for r in missing)}")
    return scenes


def require_test_length(published: SceneSet, config: SceneConfig) -> SceneSet:
    short = short_test_scenes(published.scenes, published.tracks, config).take(1)
    if short:
        raise ValueError(f"test scene not of adequate length: {short[0]}")
    return published


def convert(tracks: DataFrame, config: SceneConfig, forecasts: DataFrame | None = None) -> SceneSet:
    """The whole conversion: tracks in, published scenes and tracks out."""
    tracks = freeze(tracks)
    config = sized(config, tracks.count())
    split, scenes = prepare(tracks, config, stored=True)
    chosen, counts = select_counted(require_scenes(scenes, split if config.require_parts else None), split, config, forecasts)
    return replace(require_test_length(publish(chosen, split, config), config), counts=counts)


def convert_mixed(tracks: DataFrame, settings: dict[str, SceneConfig], default: SceneConfig | None = None) -> SceneSet:
    """Conversions with settings of their own per dataset; the others take ``default`` or are
    left out. Datasets with equal settings are converted together, in one pass each."""
    groups: dict[SceneConfig, list[str]] = {}
    for dataset, config in settings.items():
        groups.setdefault(config, []).append(dataset)
    parts = [convert(tracks.where(F.col("dataset").isin(names)), config) for config, names in groups.items()]
    if default is not None:
        others = tracks.where(~F.coalesce(F.col("dataset").isin(list(settings)), F.lit(False)))
        parts += [] if others.isEmpty() else [convert(others, default)]
    if not parts:
        raise ValueError("no dataset has settings")
    scenes, rows, counts = parts[0].scenes, parts[0].tracks, parts[0].counts
    for part in parts[1:]:
        scenes, rows, counts = scenes.unionByName(part.scenes), rows.unionByName(part.tracks), counts.unionByName(part.counts)
    return SceneSet(scenes, rows, counts)


def retype(scenes: DataFrame, tracks: DataFrame, config: SceneConfig) -> DataFrame:
    """Type stored scenes: those of a written set, or any with dataset, split, scene,
    pedestrian, start and end, over the split tracks they were cut from. With tracks in buckets the paths take no shuffle of them."""
    with co_partitioned(tracks.sparkSession):
        whole = freeze(with_paths(scenes, tracks, config.chunk_size, config.hot_rows, config.segment_rows))
    return type_scenes(whole, tracks, config)


def stats(result: SceneSet) -> DataFrame:
    """Counts per dataset, split, type and kind; public test scenes have none."""
    return tag_stats(result.scenes.where(F.col("split") != "test"))
