"""What the plans must and must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from pathloom.catalog import base
from pathloom.config import SceneConfig
from pathloom.operators import kinds as K
from pathloom.operators import scenes as S
from pathloom.operators.frames import split_frames
from pathloom.operators.pairs import nearby, scene_steps
from pathloom.sources import files as X

CONFIG = SceneConfig()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def split(spark, small):
    return base.split_tracks(spark, small)


@pytest.fixture(scope="module")
def scenes(spark, small):
    return base.scenes(spark, small)


def test_windows_take_two_shuffles_and_two_sorts(split):
    text = plan(S.cut_scenes(split, CONFIG))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert len(re.findall(r"\bSort \[", text)) == 2
    assert "SinglePartition" not in text


def test_windows_alone_take_one_shuffle_and_one_sort(split):
    text = plan(S.path_windows(split, 21, 2))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_typing_pairs_by_frame_and_cell(split, scenes):
    text = plan(K.type_scenes(scenes, split, CONFIG))
    assert "Cartesian" not in text and "NestedLoop" not in text and "SinglePartition" not in text
    steps = plan(nearby(scene_steps(scenes, 9, 21), split, 5.0))
    assert re.search(r"Join \[dataset#\w+, split#\w+, frame#\w+, _gx#\w+, _gy#\w+\]", steps)


def test_split_needs_no_join_by_frame(split, spark, small):
    text = plan(split_frames(base.tracks(spark, small), CONFIG))
    assert "BroadcastHashJoin [dataset" in text and "Exchange hashpartitioning" not in text


def test_first_rows_are_cut_before_the_shuffle(split):
    text = plan(S.first_rows(split, 20))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_scans_read_only_what_is_used(spark, tmp_path):
    table = spark.range(10).select(*[F.col("id").cast("double").alias(n) for n in ("camera", "id", "frame", "left", "top", "width", "height", "world_x", "world_y", "feet_x", "feet_y")])
    table.write.parquet(str(tmp_path / "t"))
    text = plan(X.read_dukemtmc(spark, str(tmp_path / "t")))
    assert "PushedFilters: [IsNotNull(camera), " in text and "EqualTo(camera,5.0)" in text
    assert "feet_x" not in text and "left" not in text


def test_no_driver_loops_in_the_library():
    for file in (Path(ROOT) / "pathloom").rglob("*.py"):
        text = file.read_text()
        for word in ("toLocalIterator", ".toPandas(", "localCheckpoint", ".rdd", "crossJoin", "rand()"):
            assert word not in text.replace("``rand()``", ""), (file, word)
        if file.parent.name not in ("catalog", "llm"):  # llm collects samples and sizes with a bound
            assert ".collect()" not in text, file
