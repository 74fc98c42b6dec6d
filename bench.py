"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. The derived track table and the stage tables are stored once before the timing, as
in a real conversion; ``convert`` is the whole of it, from tracks to published scenes. With
BENCH_COPIES=n the tracks are repeated under n dataset names, for volume; BENCH_ONLY names
the queries to run, with commas in between.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pathloom.catalog import adapter, base
from pathloom.catalog.queries import QUERIES
from pathloom.operators import kinds as K
from pathloom.operators import scenes as S
from pathloom.operators.frames import frame_stats, split_frames
from pathloom.operators.selection import accept, renumber, tag_stats
from pathloom.plans.recordings import convert
from pathloom.storage import freeze

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
CONFIG = base.CONFIG


def copies(rows):
    """The rows under ``COPIES`` dataset names."""
    if COPIES == 1:
        return rows
    names = F.array(*[F.concat("dataset", F.lit(f"_{k}")) for k in range(COPIES)])
    return freeze(rows.withColumn("dataset", F.explode(names)))


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS if COPIES == 1 else str(4 * int(CPUS))).config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    start = time.perf_counter()
    tracks = copies(adapter.tracks(spark, FOLDER))
    split = freeze(split_frames(tracks, CONFIG))
    scenes = S.scene_rows(S.cut_scenes(split, CONFIG).withColumn("path_kind", K.path_kind(CONFIG)), CONFIG)
    typed = freeze(K.type_scenes(scenes, split, CONFIG))
    inputs = round(time.perf_counter() - start, 3)

    runs = {
        "walk": lambda: adapter.make_walk(spark, FOLDER),
        "parse_lines": lambda: QUERIES["src_biwi"](spark, FOLDER),
        "resample_linear": lambda: QUERIES["op_resample"](spark, FOLDER),
        "midpoints": lambda: QUERIES["op_midpoint"](spark, FOLDER),
        "split_frames": lambda: split_frames(tracks, CONFIG),
        "frame_stats": lambda: frame_stats(split),
        "windows": lambda: S.path_windows(split, CONFIG.chunk_size, CONFIG.chunk_stride),
        "cut_scenes": lambda: S.cut_scenes(split, CONFIG),
        "number_scenes": lambda: S.scene_rows(S.cut_scenes(split, CONFIG), CONFIG),
        "cone": lambda: K.cone_flags(scenes.where("path_kind IS NULL"), split, CONFIG),
        "group": lambda: K.group_flags(scenes.where("path_kind IS NULL"), split, CONFIG),
        "type_scenes": lambda: K.type_scenes(scenes, split, CONFIG),
        "all_present": lambda: K.presence(scenes, split, CONFIG),
        "collisions": lambda: K.collisions(scenes, split, CONFIG),
        "kept_tracks": lambda: S.tracks_of_frames(split, S.kept_frames(S.with_public_test(typed), CONFIG)),
        "renumber": lambda: renumber(accept(typed, CONFIG)),
        "tag_stats": lambda: tag_stats(typed),
        "convert": lambda: convert(tracks, CONFIG).tracks,
    }
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or list(runs)
    times = {name: min(timed(runs[name]), timed(runs[name])) for name in only}
    scale = re.search(r"sf([\d.]+)", FOLDER)
    n_tracks = tracks.count()
    print(json.dumps({
        "metric": "total seconds over headline queries, best of two", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None, "inputs_sec": inputs, "track_rows": n_tracks,
        "scenes": scenes.count(), "convert_rows_per_sec": round(n_tracks / times["convert"]) if "convert" in times else None, "cpus": int(CPUS), "copies": COPIES}))
    spark.stop()


if __name__ == "__main__":
    main()
