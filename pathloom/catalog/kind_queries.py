"""Scene typing and its checks over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pathloom.catalog.base import CONFIG, dist_sql, query, real, rounded, scenes, split_tracks, sql, tracks, typed
from pathloom.catalog.source_queries import in_files, named
from pathloom.operators import kinds as K
from pathloom.operators.pairs import neighbors, scene_steps
from pathloom.operators.scenes import kept_frames, path_windows, tracks_of_frames, with_public_test
from pathloom.operators.selection import accept
from pathloom.plans.recordings import convert, require_scenes, retype
from pathloom.sinks.writers import write_buckets, write_ndjson
from pathloom.sources.tables import ndjson_parts, parse_ndjson_scenes
from pathloom.sources.tagged import SOURCES, tag
from pathloom.storage import new_folder

# Nobody in the derived walk comes nearer than the usual 0.1 m; this finds some.
WIDE = CONFIG.but(collision_radius=0.6)
# Few walk within 0.8 m of each other for a whole scene; these limits find more, in scenes of any type.
LOOSE = CONFIG.but(grp_dist_thresh=2.5, grp_std_thresh=1.0)


_APART = dist_sql("s.x", "s.y", "t.x", "t.y")


def undecided(spark, sf_dir):
    return scenes(spark, sf_dir).where("path_kind IS NULL")


@query("ty_static", sql("kinds", "SELECT dataset, scene, round(travelled, 6) AS travelled, travelled < 1 AS is_static FROM kinds"))
def ty_static(spark, sf_dir):
    return scenes(spark, sf_dir).select("dataset", "scene", F.round(K.travelled(CONFIG), 6).alias("travelled"), K.is_static(CONFIG).alias("is_static"))


@query("ty_linear", sql("kinds", "SELECT dataset, scene, round(fde, 6) AS fde, fde < 0.5 AS is_linear FROM kinds"))
def ty_linear(spark, sf_dir):
    return scenes(spark, sf_dir).select("dataset", "scene", F.round(K.forecast_error(CONFIG), 6).alias("fde"), K.is_linear(CONFIG).alias("is_linear"))


@query("jn_neighbors", sql("own_kind", """SELECT s.dataset, s.scene, s.i, t.pedestrian AS other, round((s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y), 6) AS d2
    FROM s JOIN st t ON t.dataset = s.dataset AND t.split = s.split AND t.frame = s.frame AND t.pedestrian <> s.pedestrian
    WHERE (s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y) <= 25""",
    s="SELECT dataset, split, scene, pedestrian, i, path[i + 1].frame AS frame, path[i + 1].x AS x, path[i + 1].y AS y FROM sc, range(9, 21) AS places(i)"))
def jn_neighbors(spark, sf_dir):
    near = neighbors(scenes(spark, sf_dir), split_tracks(spark, sf_dir), CONFIG.inter_dist_thresh, CONFIG.obs_len, CONFIG.chunk_size)
    return near.select("dataset", "scene", "i", "other", F.round("d2", 6).alias("d2"))


@query("ty_cone", sql("cones", "SELECT dataset, scene, leader, avoidance FROM cones"))
def ty_cone(spark, sf_dir):
    return K.cone_flags(undecided(spark, sf_dir), split_tracks(spark, sf_dir), CONFIG).select("dataset", "scene", "leader", "avoidance")


@query("ty_group", sql("all_steps", f"""SELECT s.dataset, s.scene, t.pedestrian AS other, round(avg({_APART}), 6) AS mean_dist, round(stddev_pop({_APART}), 6) AS std_dist, count(*) AS steps
    FROM all_steps s JOIN st t ON t.dataset = s.dataset AND t.split = s.split AND t.frame = s.frame AND t.pedestrian <> s.pedestrian WHERE s.i >= 9
    GROUP BY s.dataset, s.scene, t.pedestrian HAVING count(*) >= 2 AND avg({_APART}) < {real(LOOSE.grp_dist_thresh)} AND stddev_pop({_APART}) < {real(LOOSE.grp_std_thresh)}"""))
def ty_group(spark, sf_dir):
    return rounded(K.group_pairs(scenes(spark, sf_dir), split_tracks(spark, sf_dir), LOOSE), "mean_dist", "std_dist")


@query("ty_main", sql("typed", "SELECT dataset, split, scene, tag FROM typed"))
def ty_main(spark, sf_dir):
    return K.type_scenes(scenes(spark, sf_dir), split_tracks(spark, sf_dir), CONFIG).select("dataset", "split", "scene", "tag")


def in_buckets(spark, sf_dir):
    """The split tracks as a table in buckets."""
    table = f"tracks_{uuid.uuid4().hex}"
    write_buckets(split_tracks(spark, sf_dir), table, new_folder(spark, "buckets"), 8)
    return spark.table(table)


@query("snk_buckets", sql("cand", "SELECT dataset, split, pedestrian, row_no, start, stop FROM cand"))
def snk_buckets(spark, sf_dir):
    """Windows of tracks that were written in buckets."""
    rows = path_windows(in_buckets(spark, sf_dir), CONFIG.chunk_size, CONFIG.chunk_stride)
    return rows.select("dataset", "split", "pedestrian", "row_no", F.col("path")[0]["frame"].alias("start"), F.element_at("path", -1)["frame"].alias("stop"))


@query("pl_retype", sql("subs", "SELECT dataset, split, scene, tag, sub_tags FROM subs"))
def pl_retype(spark, sf_dir):
    """Scenes written as lines, read again, and typed from tracks in buckets."""
    folder, rows = new_folder(spark, "scenes"), in_buckets(spark, sf_dir)
    write_ndjson(scenes(spark, sf_dir), rows.limit(0), folder)
    found = retype(parse_ndjson_scenes(ndjson_parts(spark, folder)).drop("tag", "sub_tags"), rows, CONFIG)
    return found.select("dataset", "split", "scene", "tag", F.array_join(F.col("sub_tags").cast("array<string>"), ",").alias("sub_tags"))


@query("ty_sub", sql("subs", "SELECT dataset, scene, tag, sub_tags FROM subs WHERE tag = 3"))
def ty_sub(spark, sf_dir):
    rows = K.type_scenes(scenes(spark, sf_dir), split_tracks(spark, sf_dir), CONFIG).where("tag = 3")
    return rows.select("dataset", "scene", "tag", F.array_join(F.col("sub_tags").cast("array<string>"), ",").alias("sub_tags"))


@query("ty_all_present", sql("sc", "SELECT dataset, scene, count(*) = 21 * count(DISTINCT pedestrian) AS all_present FROM seen GROUP BY dataset, scene",
    seen="""SELECT DISTINCT sc.dataset, sc.scene, t.frame, t.pedestrian FROM (SELECT dataset, split, scene, path[i].frame AS frame FROM sc, range(1, 22) AS places(i)) sc
        JOIN st t ON t.dataset = sc.dataset AND t.split = sc.split AND t.frame = sc.frame"""))
def ty_all_present(spark, sf_dir):
    return K.presence(scenes(spark, sf_dir), split_tracks(spark, sf_dir), CONFIG)


@query("ty_collision", sql("all_steps", f"""SELECT DISTINCT s.dataset, s.scene FROM s
    JOIN st t ON t.dataset = s.dataset AND t.split = s.split AND t.frame = s.frame AND t.pedestrian <> s.pedestrian
    LEFT JOIN st b ON b.dataset = s.dataset AND b.split = s.split AND b.frame = s.pframe AND b.pedestrian = t.pedestrian
    WHERE (s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y) < {real(0.6 * 0.6)}
      OR (i > 9 AND ((s.px + s.x) / 2 - (b.x + t.x) / 2) * ((s.px + s.x) / 2 - (b.x + t.x) / 2)
        + ((s.py + s.y) / 2 - (b.y + t.y) / 2) * ((s.py + s.y) / 2 - (b.y + t.y) / 2) < {real(0.6 * 0.6)})""", s="SELECT * FROM all_steps WHERE i >= 9"))
def ty_collision(spark, sf_dir):
    return K.collisions(scenes(spark, sf_dir), split_tracks(spark, sf_dir), WIDE)


@query("ty_common_start", sql("sc", "SELECT dataset, split, start, min(scene) AS scene FROM sc GROUP BY dataset, split, start"))
def ty_common_start(spark, sf_dir):
    return K.first_of_start(scenes(spark, sf_dir)).select("dataset", "split", "start", "scene")


# Forecasts: the truth of the primaries and of those near them, moved by a few centimetres that
# a hash picks; the 1st of two iterations is short for some primaries.
_HASH = "CAST(conv(substr(md5(concat_ws(':', dataset, CAST(scene AS STRING), CAST(iter AS STRING), CAST(pedestrian AS STRING), CAST(t AS STRING))), 1, 4), 16, 10) AS BIGINT)"


def forecasts(spark, sf_dir):
    near = neighbors(scenes(spark, sf_dir), split_tracks(spark, sf_dir), 1.0, CONFIG.obs_len, CONFIG.chunk_size).select(
        "dataset", "scene", F.col("other").alias("pedestrian"), (F.col("i") - CONFIG.obs_len).alias("t"), F.col("ox").alias("x"), F.col("oy").alias("y"))
    own = scene_steps(scenes(spark, sf_dir), CONFIG.obs_len, CONFIG.chunk_size).select(
        "dataset", "scene", "pedestrian", (F.col("i") - CONFIG.obs_len).alias("t"), "x", "y")
    rows = own.unionByName(near).withColumn("iter", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.where("NOT (iter = 1 AND t = 11 AND scene % 9 = 0)")
    return rows.withColumn("h", F.expr(_HASH)).select(
        "dataset", "scene", F.col("iter").cast("bigint").alias("iter"), "pedestrian", "t",
        (F.col("x") + (F.col("h") % 29).cast("double") / 100.0).alias("x"), F.col("y"))


@query("ty_forecast_check", sql("own_kind", f"""SELECT dataset, scene, bool_or(off OR own <> 12) AS is_invalid, count(*) AS n_iter FROM (
      SELECT dataset, scene, iter, bool_or(coalesce(n = 12 AND ((n_true = 12 AND ade > {real(0.11)}) OR fde > {real(0.2)}), false)) AS off,
        coalesce(max(CASE WHEN pedestrian = lead_ped THEN n END), 0) AS own FROM errors GROUP BY dataset, scene, iter) GROUP BY dataset, scene""",
    p="SELECT dataset, split, scene, pedestrian, i - 9 AS t, path[i + 1].frame AS frame, path[i + 1].x AS x, path[i + 1].y AS y FROM sc, range(9, 21) AS places(i)",
    f0="""SELECT dataset, scene, pedestrian, t, x FROM p UNION ALL SELECT p.dataset, p.scene, o.pedestrian, t, o.x FROM p
        JOIN st o ON o.dataset = p.dataset AND o.split = p.split AND o.frame = p.frame AND o.pedestrian <> p.pedestrian
        WHERE (p.x - o.x) * (p.x - o.x) + (p.y - o.y) * (p.y - o.y) <= 1""",
    f1="SELECT * FROM f0, (VALUES (0), (1)) AS iters(iter) WHERE NOT (iter = 1 AND t = 11 AND scene % 9 = 0)",
    f2="""SELECT *, CAST('0x' || substr(md5(concat_ws(':', dataset, CAST(scene AS VARCHAR), CAST(iter AS VARCHAR), CAST(pedestrian AS VARCHAR), CAST(t AS VARCHAR))), 1, 4) AS BIGINT) AS h FROM f1""",
    errors="""SELECT f.dataset, f.scene, f.iter, f.pedestrian, p.pedestrian AS lead_ped, count(*) AS n, count(o.x) AS n_true,
        avg(sqrt((f.x + CAST(h % 29 AS DOUBLE) / 100 - o.x) * (f.x + CAST(h % 29 AS DOUBLE) / 100 - o.x))) AS ade,
        max(CASE WHEN f.t = 11 THEN sqrt((f.x + CAST(h % 29 AS DOUBLE) / 100 - o.x) * (f.x + CAST(h % 29 AS DOUBLE) / 100 - o.x)) END) AS fde
        FROM f2 f JOIN p ON p.dataset = f.dataset AND p.scene = f.scene AND p.t = f.t
        LEFT JOIN st o ON o.dataset = p.dataset AND o.split = p.split AND o.frame = p.frame AND o.pedestrian = f.pedestrian
        GROUP BY f.dataset, f.scene, f.iter, f.pedestrian, p.pedestrian"""))
def ty_forecast_check(spark, sf_dir):
    return K.forecast_check(scenes(spark, sf_dir), split_tracks(spark, sf_dir), forecasts(spark, sf_dir), CONFIG)


@query("ty_test_len", sql("sc", """SELECT dataset, scene, n_shown FROM (SELECT dataset, scene,
      count(*) FILTER (WHERE (dataset, path[i].frame) IN (SELECT (dataset, frame) FROM seen) AND NOT (pedestrian % 4 = 1 AND path[i].frame % 20 = 0)) AS n_shown
    FROM sc, range(1, 22) AS places(i) WHERE split = 'test' GROUP BY dataset, scene) WHERE n_shown < 9""",
    seen="SELECT DISTINCT dataset, path[i].frame AS frame FROM sc, range(1, 10) AS places(i) WHERE split = 'test'"))
def ty_test_len(spark, sf_dir):
    """No published scene is too short, so some rows are taken away first."""
    both = with_public_test(scenes(spark, sf_dir))
    shown = tracks_of_frames(split_tracks(spark, sf_dir), kept_frames(both, CONFIG))
    return K.short_test_scenes(both, shown.where("NOT (pedestrian % 4 = 1 AND frame % 20 = 0)"), CONFIG)


@query("ty_keep_frames", sql("accepted", """SELECT DISTINCT dataset, n AS split, path[i].frame AS frame FROM accepted, range(1, 22) AS places(i),
    (VALUES ('train'), ('val'), ('test'), ('test_private')) AS names(n)
    WHERE (n = split AND split <> 'test') OR (split = 'test' AND (n = 'test_private' OR (n = 'test' AND i <= 9)))"""))
def ty_keep_frames(spark, sf_dir):
    return kept_frames(with_public_test(accept(typed(spark, sf_dir), CONFIG)), CONFIG)


@query("ty_blank_tags", sql("subs", "SELECT dataset, 'test' AS split, scene, 0 AS tag, NULL AS sub_tags FROM subs WHERE split = 'test' UNION ALL "
                                    "SELECT dataset, 'test_private', scene, tag, sub_tags FROM subs WHERE split = 'test'"))
def ty_blank_tags(spark, sf_dir):
    rows = with_public_test(typed(spark, sf_dir)).where(F.col("split").startswith("test"))
    return rows.select("dataset", "split", "scene", "tag", F.array_join(F.col("sub_tags").cast("array<string>"), ",").alias("sub_tags"))


@query("ty_no_scenes", sql("sc", "SELECT dataset, split, count(*) AS n_scenes FROM sc GROUP BY dataset, split"))
def ty_no_scenes(spark, sf_dir):
    return require_scenes(scenes(spark, sf_dir)).groupBy("dataset", "split").agg(F.count("*").alias("n_scenes"))


@query("pl_convert", sql("renumbered", """SELECT dataset, n AS split, scene, pedestrian, start, stop, CASE WHEN n = 'test' THEN 0 ELSE tag END AS tag
    FROM renumbered, (VALUES ('train'), ('val'), ('test'), ('test_private')) AS names(n)
    WHERE (n = split AND split <> 'test') OR (split = 'test' AND n LIKE 'test%')"""))
def pl_convert(spark, sf_dir):
    """The whole conversion, from tracks."""
    return convert(tracks(spark, sf_dir), CONFIG).scenes.select("dataset", "split", "scene", "pedestrian", "start", F.col("end").alias("stop"), "tag")


@query("pl_convert_counts", sql("draws", """SELECT dataset, split, tag, count(*) AS n_total, count(*) FILTER (WHERE u < chance) AS n_kept,
    count(*) FILTER (WHERE u >= chance) AS n_rejected FROM (SELECT *, CASE WHEN tag = 1 THEN CAST('0.1' AS DOUBLE) ELSE 1 END AS chance FROM draws) GROUP BY dataset, split, tag"""))
def pl_convert_counts(spark, sf_dir):
    """Scenes in all, kept and rejected, as a conversion returns them when it is written."""
    return convert(tracks(spark, sf_dir), CONFIG).write(new_folder(spark, "converted"))


@query("pl_files", sql("renumbered", """SELECT dataset, n AS split, scene, pedestrian, start, stop, CASE WHEN n = 'test' THEN 0 ELSE tag END AS tag, CASE WHEN n <> 'test' THEN sub_tags END AS sub_tags
    FROM renumbered, (VALUES ('train'), ('val'), ('test'), ('test_private')) AS names(n)
    WHERE (n = split AND split <> 'test') OR (split = 'test' AND n LIKE 'test%')"""))
def pl_files(spark, sf_dir):
    """Files to files: recordings as text, some lines of which are broken, converted and written as JSON lines, which are read again."""
    text = F.when(F.col("frame") % 970 == 0, F.array(F.lit("broken line"))).otherwise(F.array())
    line = F.concat_ws(" ", *[c.cast("string") for c in (F.col("frame") + 1, F.col("pedestrian"), F.col("x"), F.lit(0), F.col("y"))])
    rows = tracks(spark, sf_dir).select(F.col("dataset").alias("file"), "pedestrian", "frame", F.explode(F.concat(F.array(line), text)).alias("value"))
    read = read_source(spark, in_files(spark, rows, "pedestrian", "frame"), "biwi")
    folder = new_folder(spark, "converted")
    convert(read.tracks, CONFIG).write_ndjson(folder)
    if read.rejects.where("value <> 'broken line'").count():
        raise ValueError("a good line was rejected")
    found = parse_ndjson_scenes(ndjson_parts(spark, folder))
    return found.select("dataset", "split", "scene", "pedestrian", "start", F.col("end").alias("stop"), "tag", F.array_join(F.col("sub_tags").cast("array<string>"), ",").alias("sub_tags"))


def read_source(spark, folder, fmt):
    """Tracks and rejects of files that ``in_files`` has written, under the names it was given."""
    return tag(named(SOURCES[fmt].read(spark, f"{folder}/*"), ".txt"), fmt)
