"""Every reader on files: good lines, odd lines and malformed ones."""

import json

import pytest
from pyspark.errors import PySparkException

from pathloom.config import SceneConfig
from pathloom.sinks import writers as W
from pathloom.sources import files as X
from pathloom.sources import lines as L
from pathloom.sources import tables as T
from pathloom.sources.tagged import read_tagged
from pathloom.storage import freeze
from conftest import rows


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def tracks(df):
    return [tuple(r) for r in df.select("frame", "pedestrian", "x", "y").orderBy("pedestrian", "frame", "x", "y").collect()]


LINES = {
    "biwi": ("1 1 8.4 0 3.5 0.1 0 0.2\n\n 7.0  2  1.5 9 -2.5 0\n0.5 3 1 1 1\nbad\n",
             [(0, 1, 8.4, 3.5), (6, 2, 1.5, -2.5), (0, 3, 1.0, 1.0)], 2),
    "mot": ("2,1,0,0,1,1,1,3.5,4.5,0\n3,1,0,0,1,1,1,3.5,4.5,0\n4,2,0,0\n", [(2, 1, 3.5, 4.5)], 1),
    "spaced": ("24 18 20.578 32.048\n36 18 20.5 32", [(24, 18, 20.578, 32.048), (36, 18, 20.5, 32.0)], 0),
    "lcas": ("12.0,3.0,1.25,-7\nx,3,1,1\n", [(12, 3, 1.25, -7.0)], 1),
    "controlled": ("0,1,1.5,2.5\n1, 1, 1.75, 2.25\n", [(0, 1, 1.5, 2.5), (1, 1, 1.75, 2.25)], 0),
    "standard": ("5\t6\t1e1\t-2.5\n", [(5, 6, 10.0, -2.5)], 0),
    "cff": ("2013-02-06T07:17:20:400;PIW;33500;-1200;12\n"
            "2013-02-06T17:00:00:000;PIW;1000;2000;12\n"
            "2013-02-06T07:17:20:500;PIW;1;1;1\n"          # frame not a multiple of 4
            "2013-02-06T07:00:59:600;PIW;1;1;7\n2013-02-06T07:01:00:000;PIW;1;1;7\n"  # the jump at a minute
            "2013-02-06T08:17:20:400;PIW;1;1;1\n2013-02-06T07:17:20:400;OTHER;1;1;1\n07:17:20;PIW;1;1;1\n2013-02-06T07:17:20:400;PIW;1;1\n"
            "2013-02-06T07:17:20:400;PIW;x;1;1\n",
            [(596, 7, 0.001, 0.001), (1000, 7, 0.001, 0.001), (17204, 12, 33.5, -1.2), (100000, 100012, 1.0, 2.0)], 1),
}


@pytest.mark.parametrize("fmt", sorted(LINES))
def test_line_formats(spark, tmp_path, fmt):
    text, want, bad = LINES[fmt]
    path = put(tmp_path, "street.txt", text)
    found = L.read_lines(spark, path, fmt, mode="DROP")
    assert sorted(tracks(found)) == sorted(want)
    assert {r["dataset"] for r in found.collect()} == {"street"}
    left = L.rejects(L.text_lines(spark, path), fmt).collect()
    assert len(left) == bad and all(r["reason"].startswith("not a number") for r in left)
    if bad:
        with pytest.raises(PySparkException):
            L.read_lines(spark, path, fmt, mode="FAILFAST").collect()


CONTROL = """2 - the number of splines
0 - Num of control points
2 - Num of control points
100 50 0 0.5 - (x, y, frame, gaze)
200 150 20 0.5 - (x, y, frame, gaze)
3 - Num of control points
0 0 5 1
  10   20   15 1
short line 1
30 40 31 1
"""


def test_crowds(spark, tmp_path):
    put(tmp_path, "zara.vsp", CONTROL)
    found = tracks(X.read_crowds(spark, str(tmp_path / "*.vsp")))
    assert [r[:2] for r in found] == [(10, 0), (10, 1), (20, 1), (30, 1)]
    assert found[0][2:] == pytest.approx((150 * 0.0210, 100 * 0.0239))
    assert found[1][2:] == pytest.approx((5 * 0.0210, 10 * 0.0239))


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    path = put(tmp_path, "long.txt", "".join(f"{k}\n" for k in range(5000)))
    put(tmp_path, "short.txt", "a\nb\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = X.numbered_lines(spark, str(tmp_path / "*.txt"))
        assert found.rdd.getNumPartitions() >= 1
        got = {(r["path"].split("/")[-1], r["line_no"]): r["value"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    assert got == {("long.txt", k): str(k) for k in range(5000)} | {("short.txt", 0): "a", ("short.txt", 1): "b"}
    assert path.endswith("long.txt")


XML = """<?xml version="1.0"?>
<dataset name="s2">
 <frame number="0"><objectlist>
  <object id="3"><box h="1" w="1" xc="150" yc="250.5"/></object>
  <object id="4"><box h="1" w="1" xc="-50" yc="0"/></object></objectlist></frame>
 <frame number="1"><objectlist><object id="3"><box xc="1" yc="1"/></object></objectlist></frame>
 <frame number="2"><objectlist><object id="5"><box xc="100" yc="100"/></object></objectlist></frame>
 <frame number="4"><objectlist></objectlist></frame>
</dataset>
"""


def test_mot_xml(spark, tmp_path):
    path = put(tmp_path, "s2.xml", XML)
    found = X.read_mot_xml(spark, path)
    assert sorted(tracks(found)) == [(0, 3, 1.5, 2.505), (0, 4, -0.5, 0.0), (2, 5, 1.0, 1.0)]
    assert found.first()["dataset"] == "s2"


def test_edinburgh(spark, tmp_path):
    folder = tmp_path / "forum"
    put(folder, "tracks.01.txt", "% remark\nTRACK.R1=[[10 20 3];[11 21 4];[12 22 6]];\n  TRACK.R2=[[1 1 9]]\nTRACK.S1=[[1 1 3]]\n")
    put(folder, "tracks.02.txt", "TRACK.R1=[[10 20 2];[10 20 3];[10 20 5]];\n")
    found = tracks(X.read_edinburgh(spark, str(folder / "*.txt")))
    # The second file is moved by 1000000, which leaves 1 when divided by 3.
    assert [r[:2] for r in found] == [(3, 1), (6, 1), (9, 2), (1000002, 1000001), (1000005, 1000001)]
    assert found[0][2:] == pytest.approx((10 * 0.0247, 20 * 0.0247))


def test_syi(spark, tmp_path):
    folder = tmp_path / "station"
    put(folder, "000007.txt", "960\n540\n0\n\n1920\n1080\n21\n0\n0\n40\n5\n6\n")
    put(folder, "000008.txt", "1\n2\n")
    found = tracks(X.read_syi(spark, str(folder / "*.txt")))
    assert [r[:2] for r in found] == [(0, 7), (10, 7), (21, 7), (30, 7), (40, 7)]
    assert found[1][2:] == pytest.approx((22.5, 52.5))


def test_dukemtmc(spark, tmp_path):
    names = ("camera", "id", "frame", "left", "top", "width", "height", "world_x", "world_y", "feet_x", "feet_y")
    data = [(5.0, 1.0, 48.0, 0.0, 0.0, 0.0, 0.0, 1.5, 2.5, 0.0, 0.0), (5.0, 1.0, 49.0, 0.0, 0.0, 0.0, 0.0, 1.5, 2.5, 0.0, 0.0),
            (2.0, 1.0, 48.0, 0.0, 0.0, 0.0, 0.0, 9.0, 9.0, 0.0, 0.0)]
    path = str(tmp_path / "duke")
    spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).write.parquet(path)
    assert tracks(X.read_dukemtmc(spark, path)) == [(48, 1, 1.5, 2.5)]
    assert tracks(X.read_dukemtmc(spark, path, camera=2)) == [(48, 1, 9.0, 9.0)]


def test_wildtrack(spark, tmp_path):
    put(tmp_path, "00000005.json", json.dumps([{"personID": 3, "positionID": 481, "views": []}, {"personID": 4, "positionID": 240}], indent=1))
    put(tmp_path, "00000010.json", "[]")
    found = tracks(X.read_wildtrack(spark, str(tmp_path / "*.json")))
    assert [r[:2] for r in found] == [(5, 3), (5, 4)]
    assert found[0][2:] == pytest.approx((-3 + 0.025, -9 + 0.025 * 481 / 480))
    assert found[1][2:] == pytest.approx((3.0, -9 + 0.0125))


HEADER = "ID,Front1x,Front1y,Front2x,Front2y,Back1x,Back1y,Back2x,Back2y,Type,Occlusion\n"


def test_car(spark, tmp_path):
    folder = tmp_path / "v1.2"
    put(folder, "24.csv", HEADER + "7,162,324,0,0,0,0,0,0,2,0\n8,1,1,0,0,0,0,0,0,1,0\n")
    put(folder, "25.csv", HEADER + "7,162,324,0,0,0,0,0,0,2,0\n")
    assert tracks(X.read_car(spark, str(folder / "*.csv"))) == [(24, 7, pytest.approx(5.0), pytest.approx(10.0))]
    put(folder, "36.csv", HEADER.replace("Type", "Kind") + "7,162,324,0,0,0,0,0,0,2,0\n")
    with pytest.raises(Exception, match="header"):
        X.read_car(spark, str(folder / "*.csv")).collect()


def test_ndjson(spark, tmp_path):
    path = put(tmp_path, "a.ndjson", "\n".join([
        '{"track": {"f": 1, "p": 2, "x": 1.5, "y": -2}}', '{"track": {"f": 2, "p": 2, "x": 0, "y": 0, "prediction_number": 1}}',
        '{"scene": {"id": 4, "p": 2, "s": 1, "e": 9, "fps": 2.5, "tag": [3, [1, 3]]}}',
        '{"scene": {"id": 5, "p": 2, "s": 1, "e": 9, "fps": 2.5, "tag": [4, []]}}',
        '{"scene": {"id": 6, "p": 2, "s": 1, "e": 9, "fps": 2.5, "tag": 0}}']))
    assert [tuple(r) for r in T.read_ndjson_tracks(spark, path).orderBy("frame").collect()] == [("a", 1, 2, 1.5, -2.0, None), ("a", 2, 2, 0.0, 0.0, 1)]
    found = T.read_ndjson_scenes(spark, path).orderBy("scene").collect()
    assert [(r["scene"], r["tag"], r["sub_tags"]) for r in found] == [(4, 3, [1, 3]), (5, 4, []), (6, 0, None)]


def test_written_lines(spark, tmp_path):
    scenes = spark.createDataFrame([("d", "train", 0, 7, 10, 30, 2.5, 3, [1, 2]), ("d", "train", 1, 7, 10, 30, 2.5, 4, []), ("d", "test", 2, 8, 5, 6, 2.5, 0, None)],
                                   "dataset string, split string, scene long, pedestrian long, start long, end long, fps double, tag int, sub_tags array<int>")
    tracks_ = spark.createDataFrame([("d", "train", 10, 7, 0.5, -1.25)], "dataset string, split string, frame long, pedestrian long, x double, y double")
    folder = str(tmp_path / "out")
    for _ in range(2):  # the second time overwrites
        W.write_ndjson(scenes, tracks_, folder)
    found = [json.loads(r["value"]) for r in T.ndjson_parts(spark, folder).collect()]
    assert {"track": {"f": 10, "p": 7, "x": 0.5, "y": -1.25}} in found
    assert {"scene": {"id": 0, "p": 7, "s": 10, "e": 30, "fps": 2.5, "tag": [3, [1, 2]]}} in found
    assert {"scene": {"id": 1, "p": 7, "s": 10, "e": 30, "fps": 2.5, "tag": [4, []]}} in found
    assert {"scene": {"id": 2, "p": 8, "s": 5, "e": 6, "fps": 2.5, "tag": 0}} in found
    assert len(found) == 4


def test_tracks_only_are_ordered(spark, crowd, tmp_path):
    W.write_tracks_only(crowd, str(tmp_path / "t"))
    folder = tmp_path / "t" / "dataset=plaza"
    keys = [(d["p"], d["f"]) for file in sorted(folder.glob("part-*")) for d in (json.loads(line)["track"] for line in file.read_text().splitlines())]
    assert keys == sorted(keys) and len(keys) == crowd.where("dataset = 'plaza'").count()


def test_csv_is_read_back(spark, crowd, tmp_path):
    W.write_csv(crowd, str(tmp_path / "c"))
    found = L.read_lines(spark, str(tmp_path / "c" / "dataset=plaza"), "controlled", "plaza")
    assert rows(found) == rows(crowd.where("dataset = 'plaza'"))


def test_freeze_keeps_rows_and_schema(crowd):
    kept = freeze(crowd)
    assert kept.schema == crowd.schema and rows(kept) == rows(crowd)


def test_settings_tell_a_rounding_residue_from_a_test_part():
    assert not SceneConfig(train_fraction=0.8, val_fraction=0.2).has_test
    assert SceneConfig().has_test


# Of the formats beyond one position per line: a file, its name, what is read and why what is rejected.
TAGGED = {
    "crowds": ("zara.vsp", "1 - Num of control points\n0 0 5 1\n1 x 7 1\n10 20 25 1\n3 - Num of control points\n1 1 oops 1\n4 - Num of control points\n0 0 5 1\n2 2 25 1\n",
               [(10, 0), (20, 0), (10, 1), (20, 1)], ["not a number: f", "not a number: y"]),
    "mot_xml": ("s2.xml", XML.replace('number="1"', 'number="one"').replace('id="4"', 'id="four"'), [(0, 3), (2, 5)], ["not a frame element", "not a number: pedestrian"]),
    "edinburgh": ("a.txt", "TRACK.R1=[[10 20 3];[11 oops 6];[12 22]];\nTRACK.Rx=[[1 1 9]]\n", [(3, 1)], ["not a number: frame", "not a number: pedestrian", "not a number: y"]),
    "syi": ("7.txt", "1\n2\n10\n3\nx\n20\n\n5\n6\n30\n7\n", [(10, 7), (20, 7), (30, 7)], ["not a number: y"]),
    "wildtrack": ("00000005.json", '[{"personID": 1, "positionID": 480}, {"personID": 2}]', [(5, 1)], ["not a number: x, y"]),
    "car": ("12.csv", ",".join(["ID", "Front1x", "Front1y", "Front2x", "Front2y", "Back1x", "Back1y", "Back2x", "Back2y", "Type", "Occlusion"])
            + "\n4,1,1,0,0,0,0,0,0,2,0\nfive,1,1,0,0,0,0,0,0,2,0\n6,1\n", [(12, 4)], ["not a number: Type, y", "not a vehicle line"]),
    "ndjson": ("a.ndjson", '{"track": {"f": 1, "p": 2, "x": 1.0, "y": 2.0}}\n{"scene": {"id": 1}}\n{"track": {"f": 1, "p": 2}}\noops\n\n', [(1, 2)], ["not a JSON line", "not a number: x, y"]),
}


@pytest.mark.parametrize("fmt", sorted(TAGGED))
def test_tracks_and_rejects_of_one_scan(spark, tmp_path, fmt):
    name, text, want, reasons = TAGGED[fmt]
    path = put(tmp_path / "in", name, text)
    found = read_tagged(spark, path, fmt)
    assert sorted((r.frame, r.pedestrian) for r in found.tracks.collect()) == sorted(want)
    assert sorted(r.reason for r in found.rejects.collect()) == sorted(reasons)
    for side in (found.tracks, found.rejects):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert not any(f"FileScan {kind}" in plan for kind in ("text", "csv", "json", "xml")), plan


@pytest.mark.parametrize("fmt", sorted(LINES))
def test_lines_and_rejects_of_one_scan(spark, tmp_path, fmt):
    text, want, bad = LINES[fmt]
    found = read_tagged(spark, put(tmp_path, "street.txt", text), fmt)
    assert sorted(tracks(found.tracks)) == sorted(want) and found.rejects.count() == bad


def test_files_without_a_list_are_rejected_whole(spark, tmp_path):
    for name, text in (("1.json", "not a list"), ("2.json", "[]"), ("3.json", '[{"personID": 1, "positionID": 1}]')):
        put(tmp_path / "in", name, text)
    found = read_tagged(spark, str(tmp_path / "in" / "*.json"), "wildtrack")
    assert [(r.frame, r.pedestrian) for r in found.tracks.collect()] == [(3, 1)]
    assert [r.value for r in found.rejects.collect()] == ["not a list"]


def test_control_points_of_the_malformed_lines_have_a_person_each(spark, tmp_path):
    """Two pedestrians that are in the same frames, in one file."""
    from pathloom.catalog.source_queries import _malformed
    from pathloom.operators.resample import repeated_controls
    from pathloom.sources.files import tag_controls
    events = spark.range(12).selectExpr("id + 1 AS event_id", "timestamp_seconds(id) AS ts", "(id % 2) * 500 AS user_id", "'click' AS event_type", "1D AS value", "'{\"k\": 3}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    points = tag_controls(_malformed(spark, str(tmp_path), "crowds")).where("reason IS NULL")
    assert points.count() == 12 and points.select("pedestrian").distinct().count() == 2
    assert repeated_controls(points).isEmpty()
