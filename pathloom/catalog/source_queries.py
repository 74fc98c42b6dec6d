"""Sources, sinks and scalar functions over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pathloom.catalog.base import CONFIG, SPLINE, lines, query, real, rounded, scenes, split_tracks, sql, tracks, typed, walk
from pathloom.functions import geometry as G
from pathloom.functions.draws import jitter
from pathloom.functions.text import clock_frame, path_id, tokens
from pathloom.operators.frames import stride_frame
from pathloom.operators.ordered import number_in_order, piece_window, segments
from pathloom.operators.resample import SCALE_X, SCALE_Y
from pathloom.operators.pairs import noisy_observations, scene_paths
from pathloom.schema import CAR_HEADER, DUKE_COLUMNS
from pathloom.schema import NDJSON as NDJSON_LINE
from pathloom.operators.scenes import kept_frames, tracks_of_frames, with_public_test
from pathloom.sinks import writers as W
from pathloom.sources import files as X
from pathloom.sources import lines as L
from pathloom.sources import tables as T
from pathloom.sources.tagged import SOURCES, tag
from pathloom.storage import new_folder, work_folder

TRACK = ("dataset", "frame", "pedestrian", "x", "y")


def txt(value: str) -> str:
    return f"CAST({value} AS STRING)"


def joined(separator: str, *values: str) -> str:
    """SQL text of a line; every 97th event gives a broken one."""
    parts = ", ".join(v if v.startswith("'") else txt(v) for v in values)
    return f"CASE WHEN event_id % 97 = 0 THEN 'broken line' ELSE concat_ws('{separator}', {parts}) END"


def expected(text: str, separator: str, frame: str, pedestrian: str, x: str, y: str, keep: str = "true") -> str:
    """SQL that splits the same lines again and reads the parts."""
    return sql("walk", f"""SELECT 'walk' AS dataset, frame, pedestrian, x, y FROM (
        SELECT {frame} AS frame, {pedestrian} AS pedestrian, {x} AS x, {y} AS y FROM cut)
        WHERE frame IS NOT NULL AND pedestrian IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND {keep}""",
        raw=f"SELECT {text} AS value FROM walk",
        cut=f"SELECT list_filter(string_split(value, '{separator}'), lambda part: part <> '') AS p FROM raw")


def num(k: int, shift: str = "") -> str:
    return f"CAST(trunc(TRY_CAST(p[{k}] AS DOUBLE){shift}) AS BIGINT)"


def dbl(k: int) -> str:
    return f"TRY_CAST(p[{k}] AS DOUBLE)"


BIWI = joined(" ", "frame + 1", "''", "pedestrian", "xc", "'0.0'", "yc", "'0.5'")
MOT = joined(",", "frame + event_id % 2", "pedestrian", "'1'", "'2'", "'3'", "'4'", "'1'", "xc", "yc", "'0'")
PLAIN = ("frame", "pedestrian", "xc", "yc")
SPACED = joined(" ", *PLAIN)
LCAS = joined(",", "CAST(frame AS DOUBLE)", *PLAIN[1:])
CONTROLLED = joined(", ", *PLAIN)
STANDARD = joined("\t", *PLAIN)


def in_files(spark, lines, *order):
    """Write ``value`` in the given order into one text file for each ``file``; the folder."""
    folder = new_folder(spark, "lines")
    lines.repartition("file").sortWithinPartitions("file", *order).select("file", "value").write.partitionBy("file").text(folder)
    return folder


def named(rows, ending):
    """Lines that were read, with the name their file was written under instead of Spark's."""
    return rows.withColumn("path", F.regexp_replace("path", r"/file=([^/]*)/[^/]*$", rf"/in/$1{ending}"))


def _line_query(name: str, fmt: str, text: str, oracle: str) -> None:
    @query(name, oracle)
    def run(spark, sf_dir):
        folder = in_files(spark, lines(spark, sf_dir, text).withColumn("file", F.pmod("pedestrian", F.lit(8))), "event_id")
        return L.read_lines(spark, f"{folder}/*", fmt, "walk", mode="DROP")


_line_query("src_biwi", "biwi", BIWI, expected(BIWI, " ", num(1, " - 1"), num(2), dbl(3), dbl(5)))
_line_query("src_mot", "mot", MOT, expected(MOT, ",", num(1), num(2), dbl(8), dbl(9), "frame % 2 = 0"))
_line_query("src_spaced", "spaced", SPACED, expected(SPACED, " ", num(1), num(2), dbl(3), dbl(4)))
_line_query("src_lcas", "lcas", LCAS, expected(LCAS, ",", num(1), num(2), dbl(3), dbl(4)))
_line_query("src_controlled", "controlled", CONTROLLED, expected(CONTROLLED, ", ", num(1), num(2), dbl(3), dbl(4)))
_line_query("src_standard", "standard", STANDARD, expected(STANDARD, "\t", num(1), num(2), dbl(3), dbl(4)))

# A clock, a place, two coordinates in millimetres and an id; some lines of another place or
# session, with a short clock or with a part missing.
_two = lambda value: f"lpad({txt(value)}, 2, '0')"
CLOCK = (f"concat_ws(':', CASE WHEN event_id % 17 = 0 THEN '2013-02-06T18' WHEN event_id % 2 = 0 THEN '2013-02-06T07' ELSE '2013-02-06T17' END, "
         f"{_two('CAST(floor(frame / 600) AS BIGINT) % 60')}, {_two('CAST(floor(frame / 10) AS BIGINT) % 60')}, lpad({txt('event_id % 1000')}, 3, '0'))")
STATION = f"""CASE WHEN event_id % 19 = 0 THEN '2013-02-06T07:01:02;PIW;1;2;3' WHEN event_id % 23 = 0 THEN concat_ws(';', {CLOCK}, 'PIW', {txt('xc * 10')}, {txt('yc * 10')})
    ELSE concat_ws(';', {CLOCK}, CASE WHEN event_id % 13 = 0 THEN 'PXX' ELSE 'PIW' END, {txt('xc * 10')}, {txt('yc * 10')}, {txt('pedestrian')}) END"""


@query("src_cff", sql("walk", """SELECT 'walk' AS dataset, frame, pedestrian, x, y FROM (
    SELECT shift + CAST(c[2] AS BIGINT) * 1000 + CAST(c[3] AS BIGINT) * 10 + CAST(substr(c[4], 1, 1) AS BIGINT) AS frame,
      shift + CAST(p[5] AS BIGINT) AS pedestrian, CAST(p[3] AS DOUBLE) / 1000 AS x, CAST(p[4] AS DOUBLE) / 1000 AS y
    FROM (SELECT p, c, CASE right(c[1], 3) WHEN 'T07' THEN 0 WHEN 'T17' THEN 100000 END AS shift FROM cut
          WHERE len(p) = 5 AND len(c) = 4 AND p[2] = 'PIW') WHERE shift IS NOT NULL) WHERE frame % 4 = 0""",
    raw=f"SELECT {STATION} AS value FROM walk",
    cut="SELECT string_split(value, ';') AS p, string_split(string_split(value, ';')[1], ':') AS c FROM raw"))
def src_cff(spark, sf_dir):
    return L.parse_lines(lines(spark, sf_dir, STATION), "cff")


def control_lines(spark, sf_dir):
    """Four files of control points: a header before every sixth event and each pedestrian."""
    file = "concat('scene_', CAST(pedestrian % 4 AS STRING))"
    rows = walk(spark, sf_dir).withColumn("at", F.col("pedestrian") * 1_000_000_000 + F.col("event_id") * 2)
    heads = (rows.where(F.col("event_id") % 6 == 0).selectExpr(f"{file} AS file", "at AS line_no", "'7 - Num of control points' AS value")
             .unionByName(rows.select("pedestrian").distinct().selectExpr(
                 f"{file} AS file", "pedestrian * 1000000000L - 1 AS line_no", "'9 - the number of splines' AS value")))
    points = rows.selectExpr(f"{file} AS file", "at + 1 AS line_no",
                             f"concat_ws(' ', {txt('xc')}, {txt('yc')}, {txt('frame + event_id % 7')}, '0.1', ' - (position)') AS value")
    return heads.unionByName(points)


@query("src_crowds", sql("walk", "SELECT dataset, frame, pedestrian, round(x, 6) AS x, round(y, 6) AS y FROM curves",
    heads="SELECT *, event_id % 6 = 0 OR row_number() OVER (PARTITION BY pedestrian ORDER BY event_id) = 1 AS fresh FROM walk",
    pts=f"""SELECT 'scene_' || (pedestrian % 4) AS dataset, CAST(sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY pedestrian % 4 ORDER BY pedestrian, event_id) - 1 AS BIGINT) AS pedestrian,
        frame + event_id % 7 AS f, CAST(xc AS DOUBLE) * {real(SCALE_X)} AS x, CAST(yc AS DOUBLE) * {real(SCALE_Y)} AS y FROM heads""", **SPLINE))
def src_crowds(spark, sf_dir):
    """Written as files of control points and read again."""
    folder = in_files(spark, control_lines(spark, sf_dir), "line_no")
    return rounded(X.parse_crowds(named(X.numbered_lines(spark, f"{folder}/*"), ".vsp")), "x", "y")


XML_SQL = """SELECT 'walk' AS dataset, frame + event_id % 2 AS frame, pedestrian + shift AS pedestrian,
    CAST(xc + shift AS DOUBLE) / 100 AS x, CAST(yc AS DOUBLE) / 100 AS y
    FROM walk, (VALUES (0), (1000000)) AS objects(shift)
    WHERE (frame + event_id % 2) % 2 = 0 AND event_id % 5 <> 0 AND (shift = 0 OR event_id % 3 = 0)"""


def xml_text(number):
    """SQL of a frame element over several lines."""
    thing = lambda shift: f"""concat('<object id="', {txt(f'pedestrian + {shift}')}, '"><box xc="', {txt(f'xc + {shift}')}, '" yc="', {txt('yc')}, '"/></object>', chr(10))"""
    return f"""concat('<frame number="', {txt(number)}, '"><objectlist>', chr(10), CASE WHEN event_id % 5 = 0 THEN '' ELSE {thing(0)} END,
        CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN {thing(1000000)} ELSE '' END, '</objectlist></frame>')"""


def xml_lines(spark, sf_dir, number="frame + event_id % 2"):
    return lines(spark, sf_dir, xml_text(number)).withColumn("file", F.pmod("pedestrian", F.lit(4)))


@query("src_mot_xml", sql("walk", XML_SQL))
def src_mot_xml(spark, sf_dir):
    return X.read_mot_xml(spark, f"{in_files(spark, xml_lines(spark, sf_dir), 'event_id')}/*", "walk")


FORUM = f"""CASE WHEN event_id % 97 = 0 THEN '% a remark' ELSE concat(' TRACK.R', {txt('pedestrian')}, '=[[', {txt('xc')}, ' ', {txt('yc')}, ' ', {txt('frame')}, '];[',
    {txt('xc + 1')}, ' ', {txt('yc')}, ' ', {txt('frame + 1')}, ']];') END"""


@query("src_edinburgh", sql("walk", f"""SELECT 'forum' AS dataset, frame + step + file * 1000000 AS frame, pedestrian + file * 1000000 AS pedestrian,
    CAST(xc + step AS DOUBLE) * {real(0.0247)} AS x, CAST(yc AS DOUBLE) * {real(0.0247)} AS y
    FROM (SELECT *, [0, 2, 3][CAST(pedestrian % 3 AS INTEGER) + 1] AS file FROM walk), (VALUES (0), (1)) AS points(step)
    WHERE event_id % 97 <> 0 AND (frame + step + file * 1000000) % 3 = 0"""))
def src_edinburgh(spark, sf_dir):
    """Three files with lines, and an empty one that uses up a number."""
    rows = lines(spark, sf_dir, FORUM).withColumn("file", F.concat(F.lit("tracks_"), F.element_at(F.array(F.lit(0), F.lit(2), F.lit(3)), (F.col("pedestrian") % 3 + 1).cast("int"))))
    folder = in_files(spark, rows, "event_id")
    empty = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/file=tracks_1/part-0.txt")
    empty.getFileSystem(spark._jsc.hadoopConfiguration()).create(empty).close()
    return X.read_edinburgh(spark, f"{folder}/*", "forum")


STATION_SQL = f"""SELECT pedestrian, event_id, frame, CAST(xc AS DOUBLE) * 30 / 1920 AS x, CAST(yc AS DOUBLE) * 70 / 1080 AS y,
    lag(frame) OVER w AS f0, lag(CAST(xc AS DOUBLE) * 30 / 1920) OVER w AS x0, lag(CAST(yc AS DOUBLE) * 70 / 1080) OVER w AS y0
    FROM (SELECT * REPLACE (frame + event_id % 3 AS frame) FROM walk) WINDOW w AS (PARTITION BY pedestrian ORDER BY event_id)"""
MIDPOINT_SQL = sql("walk", """SELECT 'in' AS dataset, frame, pedestrian, x, y FROM points UNION ALL
    SELECT 'in', CAST(trunc((f0 + frame) / 2) AS BIGINT), pedestrian, (x0 + x) / 2, (y0 + y) / 2 FROM points WHERE f0 IS NOT NULL""", points=STATION_SQL)


def station_lines(spark, sf_dir):
    """One number per line, and a blank one after every triple; a file per pedestrian."""
    numbers = F.array(*[F.col(c).cast("string") for c in ("xc", "yc", "shown")], F.lit(""))
    return (walk(spark, sf_dir).withColumn("shown", F.col("frame") + F.col("event_id") % 3)
            .select(F.lpad(F.col("pedestrian").cast("string"), 8, "0").alias("file"), "event_id", F.posexplode(numbers).alias("k", "value"))
            .select("file", F.concat(F.lit("/in/"), "file", F.lit(".txt")).alias("path"), (F.col("event_id") * 4 + F.col("k")).alias("line_no"), "value"))


@query("src_syi", MIDPOINT_SQL)
def src_syi(spark, sf_dir):
    """Written as a file for each pedestrian and read again."""
    folder = in_files(spark, station_lines(spark, sf_dir), "line_no")
    return X.parse_syi(named(X.numbered_lines(spark, f"{folder}/*"), ".txt"))


@query("src_dukemtmc", sql("walk", """SELECT 'duke' AS dataset, CAST(frame AS BIGINT) AS frame, pedestrian, CAST(xc AS DOUBLE) AS x, CAST(yc AS DOUBLE) AS y
    FROM walk WHERE event_id % 8 = 5 AND frame % 24 = 0"""))
def src_dukemtmc(spark, sf_dir):
    table = walk(spark, sf_dir).selectExpr(
        "CAST(event_id % 8 AS DOUBLE) AS camera", "CAST(pedestrian AS DOUBLE) AS id", "CAST(frame AS DOUBLE) AS frame", "0D AS left", "0D AS top",
        "1D AS width", "1D AS height", "CAST(xc AS DOUBLE) AS world_x", "CAST(yc AS DOUBLE) AS world_y", "0D AS feet_x", "0D AS feet_y")
    return X.parse_dukemtmc(table, "duke")


PEOPLE = f"""concat('[{{"personID": ', {txt('pedestrian')}, ', "positionID": ', {txt('event_id')}, '}}, {{"personID": ', {txt('pedestrian + 1000')}, ', "positionID": ', {txt('event_id + 481')}, '}}]')"""
CELL_SQL = f"""{real(-3.0)} + {real(0.025)} * CAST(cell % 480 AS DOUBLE) AS x, {real(-9.0)} + {real(0.025)} * (CAST(cell AS DOUBLE) / 480) AS y"""


@query("src_wildtrack", sql("walk", f"""SELECT 'in' AS dataset, frame, pedestrian, {CELL_SQL} FROM (
    SELECT frame, pedestrian + 1000 * k AS pedestrian, event_id + 481 * k AS cell FROM walk, (VALUES (0), (1)) AS people(k))"""))
def src_wildtrack(spark, sf_dir):
    return X.parse_wildtrack(lines(spark, sf_dir, PEOPLE, f"concat('/cam/in/', lpad({txt('frame')}, 8, '0'), '.json')"))


def car_files(spark, sf_dir, text):
    """Files of vehicle lines below their header, named after a frame."""
    rows = lines(spark, sf_dir, text).select(F.lpad((F.floor(F.col("frame") / 100) * 6).cast("string"), 8, "0").alias("file"), "event_id", "value")
    heads = rows.select("file").distinct().select("file", F.lit(-1).cast("bigint").alias("event_id"), F.lit(",".join(CAR_HEADER)).alias("value"))
    return in_files(spark, rows.unionByName(heads), "event_id")


CAR_LINE = joined(",", "pedestrian", "xc", "yc", "'1'", "'1'", "'1'", "'1'", "'1'", "'1'", "event_id % 4", "'0'")


@query("src_car", sql("walk", f"""SELECT 'in' AS dataset, CAST(frame // 100 * 6 AS BIGINT) AS frame, pedestrian, CAST(xc AS DOUBLE) * {real(5.0 / 162)} AS x, CAST(yc AS DOUBLE) * {real(5.0 / 162)} AS y
    FROM walk WHERE event_id % 4 = 2 AND frame // 100 % 2 = 0"""))
def src_car(spark, sf_dir):
    folder = car_files(spark, sf_dir, CAR_LINE.replace("event_id % 97 = 0", "false"))
    return X.parse_car(named(X.car_lines(spark, f"{folder}/*"), ".csv"))


NDJSON = f"""CASE WHEN event_id % 10 = 0 THEN '{{"scene": {{"id": 1, "p": 2, "s": 3, "e": 4, "fps": 2.5, "tag": 0}}}}'
    ELSE concat('{{"track": {{"f": ', {txt('frame')}, ', "p": ', {txt('pedestrian')}, ', "x": ', {txt('xc')}, '.0, "y": ', {txt('yc')}, '.0',
      CASE WHEN event_id % 4 = 1 THEN ', "prediction_number": 1' ELSE '' END, '}}}}') END"""


@query("src_ndjson_tracks", sql("walk", """SELECT 'walk' AS dataset, frame, pedestrian, CAST(xc AS DOUBLE) AS x, CAST(yc AS DOUBLE) AS y,
    CASE WHEN event_id % 4 = 1 THEN 1 END AS prediction_number FROM walk WHERE event_id % 10 <> 0"""))
def src_ndjson_tracks(spark, sf_dir):
    return T.parse_ndjson_tracks(lines(spark, sf_dir, NDJSON))


_OWN = "SELECT dataset, split, scene, pedestrian, i - 1 AS t, path[i].frame AS frame, path[i].x AS x, path[i].y AS y FROM sc, range(1, 22) AS places(i)"
_ALL = """SELECT dataset, split, scene, pedestrian, true AS is_primary, t, frame, x, y FROM p UNION ALL
    SELECT p.dataset, p.split, p.scene, o.pedestrian, false, t, p.frame, o.x, o.y FROM p JOIN st o
      ON o.dataset = p.dataset AND o.split = p.split AND o.frame = p.frame AND o.pedestrian <> p.pedestrian"""


@query("src_scene_paths", sql("own_kind", _ALL, p=_OWN))
def src_scene_paths(spark, sf_dir):
    """Everybody in the frames of a scene."""
    return scene_paths(scenes(spark, sf_dir), split_tracks(spark, sf_dir))


@query("src_scene_near", sql("own_kind", f"{_ALL} WHERE (p.x - o.x) * (p.x - o.x) + (p.y - o.y) * (p.y - o.y) <= 25", p=_OWN))
def src_scene_near(spark, sf_dir):
    """Those within five metres of the primary."""
    return scene_paths(scenes(spark, sf_dir), split_tracks(spark, sf_dir), radius=5.0)


def _draw(*key: str) -> str:
    text = ", ".join(["'42'", *[f"CAST({k} AS VARCHAR)" for k in key]])
    return f"(CAST(CAST('0x' || substr(md5(concat_ws(':', {text})), 1, 8) AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE) * {real(0.01)} - {real(0.005)})"


_KEY = ("dataset", "scene", "pedestrian", "t", "iter")


@query("op_observations", sql("own_kind", f"""SELECT dataset, split, scene, pedestrian, iter, t, frame, round(x + {_draw(*_KEY, "'x'")}, 6) AS x, round(y + {_draw(*_KEY, "'y'")}, 6) AS y
    FROM ({_ALL}), (VALUES (0), (1)) AS iters(iter) WHERE t < 9""", p=_OWN))
def op_observations(spark, sf_dir):
    found = noisy_observations(scenes(spark, sf_dir), split_tracks(spark, sf_dir), CONFIG, iterations=2)
    return rounded(found, "x", "y")


GOALS_SQL = "SELECT dataset, pedestrian, max_by(x, frame) AS gx, max_by(y, frame) AS gy FROM tracks GROUP BY dataset, pedestrian"


def goals(spark, sf_dir):
    """The last position of every pedestrian."""
    last = F.max_by(F.struct("x", "y"), "frame")
    return tracks(spark, sf_dir).groupBy("dataset", "pedestrian").agg(last.alias("p")).select("dataset", "pedestrian", F.col("p.x").alias("gx"), F.col("p.y").alias("gy"))


@query("src_goals", sql("tracks", "SELECT * FROM goals", goals=GOALS_SQL))
def src_goals(spark, sf_dir):
    folder = f"{work_folder(spark)}/goals-{uuid.uuid4().hex}"
    goals(spark, sf_dir).write.parquet(folder)
    return T.read_goals(spark, folder)


@query("jn_goals", sql("sc", "SELECT sc.dataset, scene, pedestrian, start, gx, gy FROM sc JOIN goals USING (dataset, pedestrian)", goals=GOALS_SQL))
def jn_goals(spark, sf_dir):
    return T.path_goals(scenes(spark, sf_dir), goals(spark, sf_dir)).select("dataset", "scene", "pedestrian", "start", "gx", "gy")


# --- sinks ----------------------------------------------------------------------------------------

def published(spark, sf_dir):
    both = with_public_test(typed(spark, sf_dir))
    return both, tracks_of_frames(split_tracks(spark, sf_dir), kept_frames(both, CONFIG))


PUBLISHED = dict(
    twice="SELECT * FROM subs WHERE split <> 'test' UNION ALL SELECT * REPLACE ('test_private' AS split) FROM subs WHERE split = 'test' "
         "UNION ALL SELECT * REPLACE (0 AS tag, NULL AS sub_tags) FROM subs WHERE split = 'test'",
    kept="SELECT DISTINCT dataset, split, path[i].frame AS frame FROM twice, range(1, 22) AS places(i) WHERE split <> 'test' OR i <= 9",
    twins="SELECT * FROM st WHERE split <> 'test' UNION ALL SELECT st.* REPLACE (n AS split) FROM st, (VALUES ('test'), ('test_private')) AS names(n) WHERE split = 'test'",
    shown="SELECT twins.* FROM twins JOIN kept USING (dataset, split, frame)")


@query("snk_ndjson", sql("subs", """SELECT dataset, split, 'scene' AS kind, scene AS id, pedestrian, start AS first, stop AS last, tag, sub_tags,
      CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y FROM twice
    UNION ALL SELECT dataset, split, 'track', frame, pedestrian, NULL, NULL, NULL, NULL, x, y FROM shown""", **PUBLISHED))
def snk_ndjson(spark, sf_dir):
    """Written and read back."""
    folder = f"{work_folder(spark)}/ndjson-{uuid.uuid4().hex}"
    W.write_ndjson(*published(spark, sf_dir), folder)
    rows = T.ndjson_parts(spark, folder)
    none = lambda kind: F.lit(None).cast(kind)
    return T.parse_ndjson_scenes(rows).select(
        "dataset", "split", F.lit("scene").alias("kind"), F.col("scene").alias("id"), "pedestrian", F.col("start").alias("first"), F.col("end").alias("last"),
        "tag", F.array_join(F.col("sub_tags").cast("array<string>"), ",").alias("sub_tags"), none("double").alias("x"), none("double").alias("y")
    ).unionByName(T.parse_ndjson_tracks(rows).select(
        "dataset", "split", F.lit("track").alias("kind"), F.col("frame").alias("id"), "pedestrian", none("bigint").alias("first"), none("bigint").alias("last"),
        none("int").alias("tag"), none("string").alias("sub_tags"), "x", "y"))


@query("set_union_out", sql("subs", "SELECT dataset, split, 'scene' AS kind, count(*) AS n_lines FROM twice GROUP BY ALL UNION ALL "
                                    "SELECT dataset, split, 'track', count(*) FROM shown GROUP BY ALL", **PUBLISHED))
def set_union_out(spark, sf_dir):
    rows = W.ndjson_lines(*published(spark, sf_dir))
    return rows.groupBy("dataset", "split", F.regexp_extract("value", r'^\{"(\w+)"', 1).alias("kind")).agg(F.count("*").alias("n_lines"))


@query("snk_tracks_only", sql("tracks", "SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY pedestrian, frame, x, y) - 1 AS place FROM tracks"))
def snk_tracks_only(spark, sf_dir):
    """Written, and read again with the place of every line in the files of its dataset."""
    folder = f"{work_folder(spark)}/ndjson-{uuid.uuid4().hex}"
    W.write_tracks_only(tracks(spark, sf_dir), folder)
    rows = X.numbered_lines(spark, f"{folder}/*").withColumn("dataset", F.regexp_extract("path", "dataset=([^/]*)/", 1))
    placed = number_in_order(rows, ["dataset"], ["path", "line_no"], "place").select("dataset", "value", "place")
    track = F.from_json("value", NDJSON_LINE)["track"]
    return placed.select("dataset", track["f"].alias("frame"), track["p"].alias("pedestrian"), track["x"].alias("x"), track["y"].alias("y"), "place")


@query("snk_csv", sql("tracks", "SELECT * FROM tracks"))
def snk_csv(spark, sf_dir):
    folder = f"{work_folder(spark)}/csv-{uuid.uuid4().hex}"
    W.write_csv(tracks(spark, sf_dir), folder)
    rows = spark.read.option("basePath", folder).schema("value string, dataset string").text(folder).withColumn("path", F.lit(folder))
    return L.parse_lines(rows, "controlled")


@query("snk_goals_by_split", sql("tracks", "SELECT goals.*, split FROM goals, (VALUES ('train'), ('val'), ('test_private')) AS s(split)", goals=GOALS_SQL))
def snk_goals_by_split(spark, sf_dir):
    folder = f"{work_folder(spark)}/goals-{uuid.uuid4().hex}"
    W.write_goals(goals(spark, sf_dir), folder)
    return spark.read.parquet(folder)


@query("snk_parquet", sql("subs", "SELECT dataset, split, frame, pedestrian, x, y FROM shown", **PUBLISHED))
def snk_parquet(spark, sf_dir):
    folder = f"{work_folder(spark)}/tracks-{uuid.uuid4().hex}"
    W.write_tables(published(spark, sf_dir)[1], folder)
    return spark.read.parquet(folder)


# --- scalar functions ---------------------------------------------------------------------------------

@query("fn_int_trunc", sql("walk", "SELECT event_id, CAST(trunc(CAST(xc - 5000 AS DOUBLE) / 7) AS BIGINT) AS n FROM walk"))
def fn_int_trunc(spark, sf_dir):
    return walk(spark, sf_dir).select("event_id", G.whole(((F.col("xc") - 5000).cast("double") / 7.0).cast("string")).alias("n"))


@query("fn_scale", sql("walk", f"SELECT event_id, CAST(xc AS DOUBLE) * {real(0.0210)} AS x, CAST(yc AS DOUBLE) * {real(0.0239)} AS y FROM walk"))
def fn_scale(spark, sf_dir):
    return walk(spark, sf_dir).select("event_id", G.scale(F.col("xc").cast("double"), 0.0210).alias("x"), G.scale(F.col("yc").cast("double"), 0.0239).alias("y"))


@query("fn_cell_decode", sql("walk", f"SELECT cell, {CELL_SQL} FROM (SELECT event_id AS cell FROM walk)"))
def fn_cell_decode(spark, sf_dir):
    x, y = G.cell_position(F.col("event_id"))
    return walk(spark, sf_dir).select(F.col("event_id").alias("cell"), x.alias("x"), y.alias("y"))


@query("fn_clock_frame", sql("walk", "SELECT event_id, (event_id % 60) * 1000 + (event_id % 59) * 10 + event_id % 10 AS frame FROM walk"))
def fn_clock_frame(spark, sf_dir):
    clock = "concat_ws(':', 'T07', CAST(event_id % 60 AS STRING), CAST(event_id % 59 AS STRING), concat(CAST(event_id % 10 AS STRING), '99'))"
    return walk(spark, sf_dir).select("event_id", clock_frame(tokens(F.expr(clock), ":"), F.lit(0).cast("bigint")).alias("frame"))


@query("fn_id_offset", sql("walk", "SELECT DISTINCT pedestrian % 3 AS file, pedestrian + 1000000 * (pedestrian % 3) AS pedestrian FROM walk WHERE event_id % 97 <> 0"))
def fn_id_offset(spark, sf_dir):
    """The ids the multi-file reader gives, before its stride drops frames: three points in a row."""
    text = f"""CASE WHEN event_id % 97 = 0 THEN 'x' ELSE concat('TRACK.R', {txt('pedestrian')}, '=[[1 2 0];[1 2 1];[1 2 2]]') END"""
    rows = X.parse_edinburgh(lines(spark, sf_dir, text, "concat('/in/tracks_', CAST(pedestrian % 3 AS STRING), '.txt')"))
    return rows.select(F.floor(F.col("frame") / 1_000_000).alias("file"), "pedestrian").distinct()


@query("fn_path_id", sql("walk", "SELECT event_id, frame FROM walk"))
def fn_path_id(spark, sf_dir):
    return lines(spark, sf_dir, "''", f"concat('/a.b/c/', lpad({txt('frame')}, 8, '0'), '.json')").select("event_id", path_id(F.col("path")).alias("frame"))


@query("flt_stride_frame", sql("tracks", "SELECT step, dataset, frame, pedestrian FROM tracks, (VALUES (2), (3), (24), (4), (12)) AS s(step) WHERE frame % step = 0"))
def flt_stride_frame(spark, sf_dir):
    steps = [stride_frame(tracks(spark, sf_dir), k).select(F.lit(k).alias("step"), "dataset", "frame", "pedestrian") for k in (2, 3, 24, 4, 12)]
    out = steps[0]
    for more in steps[1:]:
        out = out.unionByName(more)
    return out


@query("flt_code", sql("walk", "SELECT camera, count(*) AS n_rows FROM (SELECT CAST(event_id % 8 AS INTEGER) AS camera FROM walk WHERE frame % 24 = 0) WHERE camera IN (1, 5) GROUP BY camera"))
def flt_code(spark, sf_dir):
    table = walk(spark, sf_dir).selectExpr("event_id % 8 AS camera", "pedestrian AS id", "frame", "xc AS world_x", "yc AS world_y")
    one = lambda k: X.parse_dukemtmc(table, "duke", k).select(F.lit(k).alias("camera"))
    return one(5).unionByName(one(1)).groupBy("camera").agg(F.count("*").alias("n_rows"))


def _odd(good: str, bad: str) -> str:
    """Every 97th event has something unreadable."""
    return f"CASE WHEN event_id % 97 = 0 THEN {bad} ELSE {good} END"


# Of each format, lines some of which are unreadable; what is then rejected, in SQL, and why. A format with its own names is written by ``MAKERS``.
_SOME = ("xc", "'oops'", txt("yc"))
MALFORMED: dict[str, tuple[str, str, str]] = {
    "biwi": (BIWI, "'broken line'", "not a number: frame, pedestrian, x, y"),
    "mot": (MOT, "'broken line'", "not a number: frame, pedestrian, x, y"),
    "spaced": (SPACED, "'broken line'", "not a number: frame, pedestrian, x, y"),
    "lcas": (LCAS, "'broken line'", "not a number: frame, pedestrian, x, y"),
    "controlled": (CONTROLLED, "'broken line'", "not a number: frame, pedestrian, x, y"),
    "standard": (STANDARD, "'broken line'", "not a number: frame, pedestrian, x, y"),
    "cff": (f"concat_ws(';', '2013-02-06T07:00:02:100', 'PIW', {_odd(txt('xc'), _SOME[1])}, {txt('yc')}, {txt('pedestrian')})",
            f"concat_ws(';', '2013-02-06T07:00:02:100', 'PIW', 'oops', {txt('yc')}, {txt('pedestrian')})", "not a number: x"),
    "crowds": (f"concat_ws(' ', {txt('xc')}, {_odd(txt('yc'), _SOME[1])}, {txt('frame')}, '0.1')", f"concat_ws(' ', {txt('xc')}, 'oops', {txt('frame')}, '0.1')", "not a number: y"),
    "edinburgh": (f"concat('TRACK.R', {txt('pedestrian')}, '=[[', {txt('xc')}, ' ', {txt('yc')}, ' ', {_odd(txt('frame'), _SOME[1])}, ']];')",
                  f"concat('TRACK.R', {txt('pedestrian')}, '=[[', {txt('xc')}, ' ', {txt('yc')}, ' oops]]')", "not a number: frame"),
    "wildtrack": (f"""concat('{{"personID": ', {txt('pedestrian')}, {_odd(f"concat(', \"positionID\": ', {txt('event_id')})", "''")}, '}}')""",
                  f"""concat('{{"personID":', {txt('pedestrian')}, '}}')""", "not a number: x, y"),
    "ndjson": (_odd(f"""concat('{{"track": {{"f": ', {txt('frame')}, ', "p": ', {txt('pedestrian')}, ', "x": ', {txt('xc')}, '.0, "y": ', {txt('yc')}, '.0}}}}')""", "'broken line'"),
               "'broken line'", "not a JSON line"),
}


MALFORMED |= {
    "dukemtmc": ("", "CAST(NULL AS STRING)", "not a number: x"), "car": (CAR_LINE, "'broken line'", "not a vehicle line"),
    "mot_xml": ("", xml_text(_odd(txt("frame"), _SOME[1])), "not a frame element"), "syi": ("", f"concat_ws(' ', {txt('xc')}, {txt('yc')}, 'oops')", "not a number: frame")}


def _malformed(spark, sf_dir, fmt):
    """Rows of a format as its reader gives them, from files written here."""
    read, rows = SOURCES[fmt].read, lines(spark, sf_dir, MALFORMED[fmt][0] or "''")
    block = F.lpad(F.floor(F.col("frame") / 100).cast("string"), 8, "0")
    if fmt == "dukemtmc":
        folder = new_folder(spark, "lines")
        cells = {"camera": "5D", "id": "CAST(pedestrian AS DOUBLE)", "frame": "CAST(frame AS DOUBLE)", "world_x": _odd("CAST(xc AS DOUBLE)", "CAST(NULL AS DOUBLE)"), "world_y": "CAST(yc AS DOUBLE)"}
        walk(spark, sf_dir).selectExpr(*[f"{cells.get(c, '0D')} AS {c}" for c in DUKE_COLUMNS]).write.parquet(folder)
        return read(spark, folder)
    if fmt == "car":
        return named(read(spark, f"{car_files(spark, sf_dir, CAR_LINE)}/*"), ".csv")
    if fmt == "mot_xml":
        return read(spark, f"{in_files(spark, xml_lines(spark, sf_dir, _odd(txt('frame'), _SOME[1])), 'event_id')}/*")
    if fmt == "syi":
        rows = station_lines(spark, sf_dir).withColumn("value", F.expr("CASE WHEN line_no % 4 = 2 AND (line_no div 4) % 97 = 0 THEN 'oops' ELSE value END"))
        return named(read(spark, f"{in_files(spark, rows, 'line_no')}/*"), ".txt")
    if fmt == "wildtrack":
        lists = rows.groupBy(block.alias("file")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
        return named(read(spark, f"{in_files(spark, lists)}/*"), ".json")
    rows = rows.withColumn("file", F.pmod("pedestrian", F.lit(4)))
    if fmt == "crowds":  # a person for each pedestrian, like in real files: no curve passes through two points at one frame
        heads = rows.select("file", "pedestrian").distinct().select(
            "file", "pedestrian", F.lit(None).cast("bigint").alias("event_id"), F.lit("9 - the number of splines").alias("value"))
        rows = heads.unionByName(rows.select("file", "pedestrian", "event_id", "value")).withColumn("head", F.col("value").contains(" - "))
        return read(spark, f"{in_files(spark, rows, 'pedestrian', F.desc('head'), 'event_id')}/*")
    return read(spark, f"{in_files(spark, rows, 'event_id')}/*")


@query("flt_malformed", sql("walk", "\nUNION ALL ".join(
    f"SELECT '{fmt}' AS fmt, {value} AS value, '{reason}' AS reason FROM walk WHERE event_id % 97 = 0" for fmt, (_, value, reason) in sorted(MALFORMED.items()))))
def flt_malformed(spark, sf_dir):
    """What is rejected of each format, from files, by the one scan that gives the tracks as well."""
    out = None
    for fmt in sorted(MALFORMED):
        bad = tag(_malformed(spark, sf_dir, fmt), fmt).rejects
        value = F.lit(None).cast("string") if fmt == "dukemtmc" else F.col("value")
        bad = bad.select(F.lit(fmt).alias("fmt"), value.alias("value"), "reason")
        out = bad if out is None else out.unionByName(bad)
    return out


_NEXT = "SELECT dataset, pedestrian, frame, x, y, lead(x) OVER w AS bx, lead(y) OVER w AS by_, lead(x, 2) OVER w AS cx, lead(y, 2) OVER w AS cy FROM tracks WINDOW w AS (PARTITION BY dataset, pedestrian ORDER BY frame)"


def _with_next(spark, sf_dir):
    keys = ["dataset", "pedestrian"]
    w = piece_window(keys, "frame")
    rows = segments(tracks(spark, sf_dir), keys, "frame", after=2)
    return rows.select("dataset", "pedestrian", "frame", "x", "y", "own", *[F.lead(c, k).over(w).alias(n) for n, c, k in (("bx", "x", 1), ("by_", "y", 1), ("cx", "x", 2), ("cy", "y", 2))]).where("own")


@query("fn_dist2", sql("tracks", "SELECT dataset, pedestrian, frame, (x - bx) * (x - bx) + (y - by_) * (y - by_) AS d2 FROM n WHERE bx IS NOT NULL", n=_NEXT))
def fn_dist2(spark, sf_dir):
    rows = _with_next(spark, sf_dir).where(F.col("bx").isNotNull())
    return rows.select("dataset", "pedestrian", "frame", G.dist2(F.col("x"), F.col("y"), F.col("bx"), F.col("by_")).alias("d2"))


@query("fn_dist", sql("tracks", "SELECT dataset, pedestrian, frame, round(sqrt((x - bx) * (x - bx) + (y - by_) * (y - by_)), 6) AS d FROM n WHERE bx IS NOT NULL", n=_NEXT))
def fn_dist(spark, sf_dir):
    rows = _with_next(spark, sf_dir).where(F.col("bx").isNotNull())
    return rows.select("dataset", "pedestrian", "frame", F.round(G.dist(F.col("x"), F.col("y"), F.col("bx"), F.col("by_")), 6).alias("d"))


@query("fn_grid_cell", sql("tracks", "SELECT dataset, pedestrian, frame, CAST(floor(x / 10) AS BIGINT) AS cx, CAST(floor(y / 10) AS BIGINT) AS cy FROM tracks"))
def fn_grid_cell(spark, sf_dir):
    return tracks(spark, sf_dir).select("dataset", "pedestrian", "frame", G.grid_cell(F.col("x"), 10).alias("cx"), G.grid_cell(F.col("y"), 10).alias("cy"))


@query("fn_turn", sql("tracks", "SELECT dataset, pedestrian, frame, (x - bx) * (cx - bx) + (y - by_) * (cy - by_) > 0 AS sharp FROM n WHERE cx IS NOT NULL", n=_NEXT))
def fn_turn(spark, sf_dir):
    c = F.col
    rows = _with_next(spark, sf_dir).where(c("cx").isNotNull())
    return rows.select("dataset", "pedestrian", "frame", G.turns_back((c("x"), c("y")), (c("bx"), c("by_")), (c("cx"), c("cy"))).alias("sharp"))


@query("fn_jitter", sql("tracks", f"""SELECT dataset, pedestrian, frame, round(x + (u * {real(0.01)} - {real(0.005)}), 6) AS x FROM (SELECT *,
    CAST(CAST('0x' || substr(md5(concat_ws(':', '42', dataset, CAST(pedestrian AS VARCHAR), CAST(frame AS VARCHAR), 'x')), 1, 8) AS BIGINT) AS DOUBLE)
    / CAST(4294967296 AS DOUBLE) AS u FROM tracks)"""))
def fn_jitter(spark, sf_dir):
    """One axis; both are in ``op_observations``."""
    return tracks(spark, sf_dir).select("dataset", "pedestrian", "frame", F.round(
        jitter(F.col("x"), 0.005, 42, F.col("dataset"), F.col("pedestrian"), F.col("frame"), "x"), 6).alias("x"))
