"""Frames, windows, scenes, selection and the first-generation set over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pathloom.catalog.base import CONFIG, query, scenes, split_tracks, sql, tracks, typed
from pathloom.operators import frames as R
from pathloom.operators import scenes as S
from pathloom.operators.ordered import number_in_order, segments
from pathloom.operators.selection import accept, acceptance_stats, renumber, tag_stats
from pathloom.plans.originals import frame_fan, long_starts, originals

WINDOW = ("dataset", "split", "pedestrian", "row_no")


def windows(spark, sf_dir):
    return S.candidate_windows(split_tracks(spark, sf_dir), CONFIG)


def ends(rows, *more):
    return rows.select("dataset", "split", "pedestrian", *more, F.col("path")[0]["frame"].alias("start"), F.element_at("path", -1)["frame"].alias("stop"))


@query("op_windows", sql("cand", "SELECT dataset, split, pedestrian, row_no, start, stop, list_sum([p.frame for p in path]) AS frame_sum, round(list_sum([p.x for p in path]), 6) AS x_sum FROM cand"))
def op_windows(spark, sf_dir):
    rows = S.path_windows(split_tracks(spark, sf_dir), CONFIG.chunk_size, CONFIG.chunk_stride)
    total = lambda c, kind: F.aggregate(F.col(f"path.{c}"), F.lit(0).cast(kind), lambda a, v: a + v)
    return ends(rows, "row_no", total("frame", "bigint").alias("frame_sum"), F.round(total("x", "double"), 6).alias("x_sum"))


@query("op_min_move", sql("cand", """SELECT dataset, split, pedestrian, row_no, start, stop FROM cand
    WHERE (path[1].x - path[21].x) * (path[1].x - path[21].x) + (path[1].y - path[21].y) * (path[1].y - path[21].y) > 4"""))
def op_min_move(spark, sf_dir):
    """Two metres at least: everybody here moves a little."""
    rows = S.path_windows(split_tracks(spark, sf_dir), CONFIG.chunk_size, CONFIG.chunk_stride)
    return ends(rows.where(S.moved(CONFIG.but(min_length=4.0))), "row_no")


@query("op_continuous", sql("cand", "SELECT dataset, split, pedestrian, row_no, start, stop FROM cand WHERE is_continuous"))
def op_continuous(spark, sf_dir):
    rows = S.path_windows(split_tracks(spark, sf_dir), CONFIG.chunk_size, CONFIG.chunk_stride)
    return ends(rows.where(S.continuous(CONFIG)), "row_no")


@query("op_frame_count", sql("st", "SELECT dataset, split, frame, count(*) AS n_rows FROM st GROUP BY dataset, split, frame"))
def op_frame_count(spark, sf_dir):
    return R.frame_counts(split_tracks(spark, sf_dir))


@query("jn_frame_stats", sql("stats", "SELECT dataset, split, frame, pedestrian, n_rows, is_close FROM stats"))
def jn_frame_stats(spark, sf_dir):
    return R.frame_stats(split_tracks(spark, sf_dir)).select("dataset", "split", "frame", "pedestrian", "n_rows", F.col("close").alias("is_close"))


@query("op_active", sql("cand", "SELECT dataset, split, pedestrian, row_no, n_rows FROM cand WHERE is_active"))
def op_active(spark, sf_dir):
    return windows(spark, sf_dir).where(S.active(CONFIG)).select(*WINDOW, "n_rows")


@query("op_close_peds", sql("stats", "SELECT DISTINCT dataset, split, frame, pedestrian FROM stats WHERE is_close"))
def op_close_peds(spark, sf_dir):
    return R.close_pedestrians(split_tracks(spark, sf_dir))


@query("op_near", sql("cand", "SELECT dataset, split, pedestrian, row_no FROM cand WHERE is_close"))
def op_near(spark, sf_dir):
    return windows(spark, sf_dir).where("close").select(*WINDOW)


@query("op_visible_chunk", sql("sc", "SELECT dataset, scene, path[i].frame AS frame FROM sc, range(1, 10) AS places(i)"))
def op_visible_chunk(spark, sf_dir):
    return S.visible_frames(scenes(spark, sf_dir), CONFIG.obs_len).select("dataset", "scene", F.explode("frames").alias("frame"))


@query("op_first_k", sql("tracks", "SELECT * FROM tracks QUALIFY row_number() OVER (PARTITION BY dataset, pedestrian ORDER BY frame, x, y) <= 20"))
def op_first_k(spark, sf_dir):
    return S.first_rows(tracks(spark, sf_dir), 20)


@query("agg_len_filter", sql("st", "SELECT * FROM st QUALIFY count(*) OVER (PARTITION BY dataset, split, pedestrian) >= 21"))
def agg_len_filter(spark, sf_dir):
    rows = split_tracks(spark, sf_dir)
    return S.long_tracks(rows, CONFIG.chunk_size).select(rows.columns)


@query("op_split_frames", sql("parts", "SELECT * FROM parts"))
def op_split_frames(spark, sf_dir):
    return R.split_frames(tracks(spark, sf_dir), CONFIG).select("dataset", "frame", "split").distinct()


@query("jn_split", sql("st", "SELECT * FROM st"))
def jn_split(spark, sf_dir):
    return R.split_frames(tracks(spark, sf_dir), CONFIG)


@query("srt_frames", sql("tracks", """SELECT 'plain' AS by_what, dataset, frame, r AS rank FROM (SELECT dataset, frame, row_number() OVER (PARTITION BY dataset ORDER BY frame) - 1 AS r FROM f)
    UNION ALL SELECT 'session', dataset, frame, row_number() OVER (PARTITION BY dataset ORDER BY frame % 100000, frame) - 1 FROM s""",
    f="SELECT DISTINCT dataset, frame FROM tracks", s="SELECT DISTINCT dataset, frame + 100000 * (pedestrian % 2) AS frame FROM tracks"))
def srt_frames(spark, sf_dir):
    rows = tracks(spark, sf_dir)
    two = rows.withColumn("frame", F.col("frame") + 100_000 * (F.col("pedestrian") % 2))
    return (R.ordered_frames(rows, CONFIG).select(F.lit("plain").alias("by_what"), "*")
            .unionByName(R.ordered_frames(two, CONFIG.but(order_frames=True)).select(F.lit("session").alias("by_what"), "*")))


@query("srt_path", sql("tracks", "SELECT dataset, pedestrian, frame, x, y, row_number() OVER (PARTITION BY dataset, pedestrian ORDER BY frame, x, y) AS row_no FROM tracks"))
def srt_path(spark, sf_dir):
    return segments(tracks(spark, sf_dir), ["dataset", "pedestrian"], "frame", ["x", "y"]).select("dataset", "pedestrian", "frame", "x", "y", "row_no")


@query("srt_ped_frame", sql("tracks", "SELECT dataset, pedestrian, frame, x, y, row_number() OVER (PARTITION BY dataset ORDER BY pedestrian, frame, x, y) - 1 AS place FROM tracks"))
def srt_ped_frame(spark, sf_dir):
    return number_in_order(tracks(spark, sf_dir), ["dataset"], ["pedestrian", "frame", "x", "y"], "place")


SCENE_SQL = "SELECT dataset, split, scene, pedestrian, start, stop, CAST(2.5 AS DOUBLE) AS fps, 0 AS tag FROM sc"


def scene_table(rows):
    return rows.select("dataset", "split", "scene", "pedestrian", "start", F.col("end").alias("stop"), "fps", "tag")


@query("op_scene_ids", sql("sc", SCENE_SQL))
def op_scene_ids(spark, sf_dir):
    return scene_table(S.scene_rows(S.cut_scenes(split_tracks(spark, sf_dir), CONFIG), CONFIG))


@query("op_test_twins", sql("sc", """SELECT dataset, split, scene, pedestrian, start, stop FROM sc WHERE split <> 'test' UNION ALL
    SELECT dataset, n, scene, pedestrian, start, stop FROM sc, (VALUES ('test'), ('test_private')) AS names(n) WHERE split = 'test'"""))
def op_test_twins(spark, sf_dir):
    return S.with_public_test(scenes(spark, sf_dir)).select("dataset", "split", "scene", "pedestrian", "start", F.col("end").alias("stop"))


TWINS = dict(
    twice="SELECT * FROM sc WHERE split <> 'test' UNION ALL SELECT sc.* REPLACE (n AS split) FROM sc, (VALUES ('test'), ('test_private')) AS names(n) WHERE split = 'test'",
    kept="SELECT DISTINCT dataset, split, path[i].frame AS frame FROM twice, range(1, 22) AS places(i) WHERE split <> 'test' OR i <= 9")


@query("set_frames_union", sql("sc", "SELECT * FROM kept", **TWINS))
def set_frames_union(spark, sf_dir):
    return S.kept_frames(S.with_public_test(scenes(spark, sf_dir)), CONFIG)


@query("jn_frames_semi", sql("sc", "SELECT t.dataset, kept.split, t.frame, pedestrian, x, y FROM st t JOIN kept ON kept.dataset = t.dataset AND kept.frame = t.frame", **TWINS))
def jn_frames_semi(spark, sf_dir):
    frames = S.kept_frames(S.with_public_test(scenes(spark, sf_dir)), CONFIG)
    return S.tracks_of_frames(split_tracks(spark, sf_dir), frames).select("dataset", "split", "frame", "pedestrian", "x", "y")


@query("op_accept", sql("accepted", "SELECT dataset, split, scene, tag FROM accepted"))
def op_accept(spark, sf_dir):
    return accept(typed(spark, sf_dir), CONFIG).select("dataset", "split", "scene", "tag")


@query("op_renumber", sql("renumbered", "SELECT dataset, split, scene, pedestrian, start, stop, tag FROM renumbered"))
def op_renumber(spark, sf_dir):
    rows = renumber(accept(typed(spark, sf_dir), CONFIG))
    return rows.select("dataset", "split", "scene", "pedestrian", "start", F.col("end").alias("stop"), "tag")


@query("agg_tag_stats", sql("accepted", """SELECT dataset, split, tag, NULL AS sub_tag, count(*) AS n_scenes, NULL AS kind FROM accepted GROUP BY dataset, split, tag
    UNION ALL SELECT dataset, split, tag, CAST(s AS INTEGER), count(*), ['LF', 'CA', 'Group', 'Others'][CAST(s AS INTEGER)]
      FROM (SELECT dataset, split, tag, unnest(string_split(sub_tags, ',')) AS s FROM accepted WHERE sub_tags <> '') GROUP BY dataset, split, tag, s"""))
def agg_tag_stats(spark, sf_dir):
    return tag_stats(accept(typed(spark, sf_dir), CONFIG))


@query("agg_accept_stats", sql("draws", f"""SELECT dataset, split, tag, count(*) AS n_total, count(*) FILTER (WHERE u < chance) AS n_kept,
    count(*) FILTER (WHERE u >= chance) AS n_rejected FROM (SELECT *, CASE WHEN tag = 1 THEN CAST('0.1' AS DOUBLE) ELSE 1 END AS chance FROM draws) GROUP BY dataset, split, tag"""))
def agg_accept_stats(spark, sf_dir):
    rows = typed(spark, sf_dir)
    return acceptance_stats(rows, accept(rows, CONFIG))


LONG = "SELECT dataset, pedestrian, count(*) AS n_rows, min(frame) AS start FROM tracks GROUP BY dataset, pedestrian HAVING count(*) >= 20"
FAN = "SELECT DISTINCT dataset, start + 10 * k AS frame FROM long, range(0, 20) AS places(k)"


@query("op_long_starts", sql("tracks", "SELECT * FROM long", long=LONG))
def op_long_starts(spark, sf_dir):
    return long_starts(tracks(spark, sf_dir))


@query("op_frame_fan", sql("tracks", "SELECT * FROM fan", long=LONG, fan=FAN))
def op_frame_fan(spark, sf_dir):
    return frame_fan(long_starts(tracks(spark, sf_dir)))


@query("pl_originals", sql("tracks", "SELECT dataset, frame, pedestrian, x, y FROM good QUALIFY count(*) OVER (PARTITION BY dataset, pedestrian) >= 20 "
                           "AND row_number() OVER (PARTITION BY dataset, pedestrian ORDER BY frame, x, y) <= 20",
                           long=LONG, fan=FAN, good="SELECT tracks.* FROM tracks JOIN fan USING (dataset, frame)"))
def pl_originals(spark, sf_dir):
    return originals(tracks(spark, sf_dir))
