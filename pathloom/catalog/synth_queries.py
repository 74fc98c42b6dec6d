"""Resampling and the clean-up of simulated crowds over the given tables.

Each pedestrian of the walk belongs to a simulated scene of five; its steps are its rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pathloom.catalog.base import SPLINE, query, real, sql, walk
from pathloom.catalog.source_queries import MIDPOINT_SQL, station_lines
from pathloom.operators import synth as Y
from pathloom.operators.ordered import segments
from pathloom.operators.resample import SCALE_X, SCALE_Y, midpoints, resample
from pathloom.plans.synthetic import crowd_tracks
from pathloom.sources.files import station_points

SIM = """SELECT CASE WHEN (pedestrian // 5) % 3 = 0 THEN 'plaza' ELSE 'street' END AS dataset, pedestrian // 5 AS scene, pedestrian % 5 AS pedestrian,
    row_number() OVER (PARTITION BY pedestrian ORDER BY frame) - 1 AS step,
    CAST(xc AS DOUBLE) / CAST(400 AS DOUBLE) AS x, CAST(yc AS DOUBLE) / CAST(400 AS DOUBLE) AS y, pedestrian % 3 AS lag_steps FROM walk"""
# A goal is where the pedestrian is a few steps before its scene's 41st, so that most scenes
# end with all at their goals; in every fourth it is far away.
GOALS = """SELECT dataset, scene, pedestrian, max(CASE WHEN step = 40 - lag_steps THEN x END) + CASE WHEN scene % 4 = 3 THEN 100 ELSE 0 END AS gx, max(CASE WHEN step = 40 - lag_steps THEN y END) AS gy
    FROM sim GROUP BY dataset, scene, pedestrian"""
NEAR = """SELECT sim.*, (x - gx) * (x - gx) + (y - gy) * (y - gy) < 1 AS reached FROM sim JOIN goals USING (dataset, scene, pedestrian)"""
FIRST = "SELECT dataset, scene, pedestrian, min(step) AS first FROM near WHERE reached AND step > 0 GROUP BY ALL"
TRIMMED = "SELECT sim.* FROM sim LEFT JOIN first USING (dataset, scene, pedestrian) WHERE first IS NULL OR step <= first"
THERE = "SELECT dataset, scene, step, count(*) FILTER (WHERE reached) AS there FROM near WHERE step > 0 GROUP BY ALL"
DONE = """SELECT dataset, scene, max(there) = max(n) AS done FROM there JOIN (SELECT dataset, scene, count(DISTINCT pedestrian) AS n FROM sim GROUP BY ALL) USING (dataset, scene) GROUP BY ALL"""
KEPT = "SELECT * FROM trimmed WHERE step > 0 AND (step - 1) % 4 = 0"


def _turns(rows: str) -> str:
    return f"""SELECT dataset, scene, NOT coalesce(bool_or(x3 IS NOT NULL AND (x - x1) * (x2 - x1) + (y - y1) * (y2 - y1) > 0), false) AS smooth
        FROM (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(x, 2) OVER w AS x2, lead(y, 2) OVER w AS y2, lead(x, 3) OVER w AS x3
          FROM {rows} WINDOW w AS (PARTITION BY dataset, scene, pedestrian ORDER BY step)) GROUP BY dataset, scene"""


SIZES = "SELECT dataset, scene, coalesce(sum(n) OVER (PARTITION BY dataset ORDER BY scene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift FROM (SELECT dataset, scene, count(DISTINCT pedestrian) AS n FROM sim GROUP BY ALL)"
# Starts lie half as far apart, so that some are too near each other.
STARTS = """SELECT dataset, scene, pedestrian, x / 2 AS x, y / 2 AS y, -x / 2 AS gx, -y / 2 AS gy FROM sim WHERE step = 0"""


def sim(spark, sf_dir):
    rows = segments(walk(spark, sf_dir), ["pedestrian"], "frame")
    group = F.floor(F.col("pedestrian") / 5)
    return rows.select(
        F.when(group % 3 == 0, "plaza").otherwise("street").alias("dataset"), group.alias("scene"), (F.col("pedestrian") % 5).alias("pedestrian"),
        (F.col("row_no") - 1).alias("step"), (F.col("xc").cast("double") / 400.0).alias("x"), (F.col("yc").cast("double") / 400.0).alias("y"),
        (F.col("pedestrian") % 3).alias("lag_steps"))


def aims(spark, sf_dir):
    at = F.when(F.col("step") == 40 - F.col("lag_steps"), F.struct("x", "y"))
    return sim(spark, sf_dir).groupBy(*Y.AGENT).agg(F.max(at).alias("p")).select(*Y.AGENT, (F.col("p.x") + F.when(F.col("scene") % 4 == 3, 100).otherwise(0)).alias("gx"), F.col("p.y").alias("gy"))


def agents(spark, sf_dir):
    return sim(spark, sf_dir).drop("lag_steps")


@query("op_goal_trim", sql("walk", "SELECT dataset, scene, pedestrian, step, x, y FROM trimmed", sim=SIM, goals=GOALS, near=NEAR, first=FIRST, trimmed=TRIMMED))
def op_goal_trim(spark, sf_dir):
    return Y.trim_at_goal(agents(spark, sf_dir), aims(spark, sf_dir))


@query("op_downsample", sql("walk", "SELECT phase, dataset, scene, pedestrian, step FROM sim, (VALUES (0), (1)) AS p(phase) WHERE step > 0 AND (step - phase) % 40 = 0", sim=SIM))
def op_downsample(spark, sf_dir):
    rows = agents(spark, sf_dir)
    part = lambda k: Y.downsample(rows, phase=k).select(F.lit(k).alias("phase"), *Y.AGENT, "step")
    return part(0).unionByName(part(1))


@query("op_turns", sql("walk", f"SELECT * FROM ({_turns('thin')})", sim=SIM, thin="SELECT * FROM sim WHERE step > 0 AND (step - 1) % 16 = 0"))
def op_turns(spark, sf_dir):
    return Y.smooth_scenes(Y.downsample(agents(spark, sf_dir), 16))


@query("op_valid_scenes", sql("walk", f"SELECT dataset, scene FROM done JOIN smooth USING (dataset, scene) WHERE done AND smooth",
                              sim=SIM, goals=GOALS, near=NEAR, first=FIRST, trimmed=TRIMMED, there=THERE, done=DONE,
                              thin="SELECT * FROM trimmed WHERE step > 0 AND (step - 1) % 4 = 0", smooth=_turns("thin")))
def op_valid_scenes(spark, sf_dir):
    return Y.valid_scenes(agents(spark, sf_dir), aims(spark, sf_dir), rate=4)


@query("op_done", sql("walk", "SELECT * FROM done", sim=SIM, goals=GOALS, near=NEAR, there=THERE, done=DONE))
def op_done(spark, sf_dir):
    return Y.done_scenes(agents(spark, sf_dir), aims(spark, sf_dir))


@query("op_offset_ids", sql("walk", "SELECT dataset, scene, step AS frame, CAST(pedestrian + shift AS BIGINT) AS pedestrian, x, y FROM sim JOIN sizes USING (dataset, scene) WHERE scene % 2 = 0", sim=SIM, sizes=SIZES))
def op_offset_ids(spark, sf_dir):
    """Every second scene counts as invalid, but uses up its ids."""
    rows = agents(spark, sf_dir)
    return Y.offset_ids(rows.where("scene % 2 = 0"), rows)


@query("op_start_clash", sql("walk", """SELECT DISTINCT b.dataset, b.scene, b.pedestrian, a.pedestrian AS other FROM starts a JOIN starts b USING (dataset, scene)
    WHERE a.pedestrian < b.pedestrian AND ((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) < 4 OR (b.x - a.gx) * (b.x - a.gx) + (b.y - a.gy) * (b.y - a.gy) < 4)""",
    sim=SIM, starts=STARTS))
def op_start_clash(spark, sf_dir):
    starts = agents(spark, sf_dir).where("step = 0").withColumn("x", F.col("x") / 2).withColumn("y", F.col("y") / 2)
    starts = starts.withColumn("gx", -F.col("x")).withColumn("gy", -F.col("y"))
    return Y.start_clashes(starts)


@query("pl_synthetic", sql("walk", """SELECT dataset, (step - 1) // 4 AS frame, CAST(pedestrian + shift AS BIGINT) AS pedestrian, x, y
    FROM thin JOIN done USING (dataset, scene) JOIN smooth USING (dataset, scene) JOIN sizes USING (dataset, scene) WHERE done AND smooth""",
    sim=SIM, goals=GOALS, near=NEAR, first=FIRST, trimmed=TRIMMED, there=THERE, done=DONE,
    thin="SELECT * FROM trimmed WHERE step > 0 AND (step - 1) % 4 = 0", smooth=_turns("thin"), sizes=SIZES))
def pl_synthetic(spark, sf_dir):
    return crowd_tracks(agents(spark, sf_dir), aims(spark, sf_dir), rate=4)[0]


@query("op_midpoint", MIDPOINT_SQL)
def op_midpoint(spark, sf_dir):
    return midpoints(station_points(station_lines(spark, sf_dir)))


# Every row is a control point. Of five pedestrians one keeps its whole path; those of the others are cut into persons of 1, 2, 5 and 6 points.
LENGTHS = (1, 2, 5, 6)


@query("op_resample", sql("walk", "SELECT dataset, frame, pedestrian, round(x, 6) AS x, round(y, 6) AS y FROM curves",
    numbered=f"SELECT *, row_number() OVER (PARTITION BY pedestrian ORDER BY frame) - 1 AS place, {list(LENGTHS)}[CAST(pedestrian % 5 AS INTEGER) + 1] AS size FROM walk",
    pts=f"""SELECT 'walk' AS dataset, pedestrian * 1000000 + coalesce(place // size, 0) AS pedestrian, frame + event_id % 7 AS f,
        CAST(xc AS DOUBLE) * {real(SCALE_X)} AS x, CAST(yc AS DOUBLE) * {real(SCALE_Y)} AS y FROM numbered""", **SPLINE))
def op_resample(spark, sf_dir):
    rows = segments(walk(spark, sf_dir), ["pedestrian"], "frame")
    size = F.get(F.lit(list(LENGTHS)), (F.col("pedestrian") % 5).cast("int"))
    person = F.col("pedestrian") * 1_000_000 + F.coalesce(F.floor((F.col("row_no") - 1) / size), F.lit(0))
    points = rows.select(F.lit("walk").alias("dataset"), person.alias("pedestrian"), F.col("xc").cast("double").alias("x"), F.col("yc").cast("double").alias("y"),
                         (F.col("frame") + F.col("event_id") % 7).alias("f"))
    found = resample(points)
    return found.select("dataset", "frame", "pedestrian", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
