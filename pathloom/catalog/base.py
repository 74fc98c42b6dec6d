"""Registry of queries, each with the SQL that must give the same result, and the inputs
and common table expressions they share."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.catalog import adapter
from pathloom.config import SceneConfig
from pathloom.functions.forecast import kalman_weights
from pathloom.operators.frames import split_frames
from pathloom.operators.kinds import path_kind, type_scenes
from pathloom.operators.scenes import cut_scenes, scene_rows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CONFIG = SceneConfig()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return add


# --- inputs -----------------------------------------------------------------------------

def walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.walk(spark, sf_dir)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.tracks(spark, sf_dir)


def split_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.stored(spark, sf_dir, "split", lambda: split_frames(tracks(spark, sf_dir), CONFIG))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.stored(spark, sf_dir, "scenes", lambda: scene_rows(
        cut_scenes(split_tracks(spark, sf_dir), CONFIG).withColumn("path_kind", path_kind(CONFIG)), CONFIG))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.stored(spark, sf_dir, "typed", lambda: type_scenes(scenes(spark, sf_dir), split_tracks(spark, sf_dir), CONFIG))


def lines(spark: SparkSession, sf_dir: str, text: str, path: str = "'/in/walk.txt'") -> DataFrame:
    """Raw lines of some format, one per event, by SQL text both engines understand."""
    return walk(spark, sf_dir).selectExpr(f"{path} AS path", f"{text} AS value", "event_id", "pedestrian", "frame", "xc", "yc")


def rounded(rows: DataFrame, *names: str) -> DataFrame:
    """Doubles whose last bit may depend on the engine."""
    return rows.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in rows.columns])


# --- the same inputs in SQL ------------------------------------------------------------------

def real(value: float) -> str:
    """A literal that is a double, not a decimal."""
    return f"CAST('{value!r}' AS DOUBLE)"


_STEP = "(dataset, split, frame)"
_PEDS = "PARTITION BY dataset, split, pedestrian ORDER BY frame, x, y"
_AHEAD = f"({_PEDS} ROWS BETWEEN CURRENT ROW AND 20 FOLLOWING)"


def _forecast_sql(axis: str) -> str:
    terms = [f"{real(w)} * path[{k + 1}].{axis}" for k, w in enumerate(kalman_weights(CONFIG.obs_len, CONFIG.pred_len))]
    return " + ".join([real(0.0), *terms])


def dist_sql(ax: str, ay: str, bx: str, by: str) -> str:
    return f"sqrt((({ax}) - ({bx})) * (({ax}) - ({bx})) + (({ay}) - ({by})) * (({ay}) - ({by})))"


def within_sql(ax: str, ay: str, bx: str, by: str) -> str:
    limit = real(math.cos(math.radians(CONFIG.inter_pos_range)))
    la, lb = f"sqrt(({ax}) * ({ax}) + ({ay}) * ({ay}))", f"sqrt(({bx}) * ({bx}) + ({by}) * ({by}))"
    return f"({la} > 0 AND {lb} > 0 AND ({ax}) * ({bx}) + ({ay}) * ({by}) >= {limit} * {la} * {lb})"


PARTS: dict[str, str] = {
    "e": """SELECT event_id, user_id AS pedestrian, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events""",
    "walk": """SELECT event_id, pedestrian,
        CAST(10 * ((pedestrian * 37) % 500 + rn - 1) + 30 * sum(CASE WHEN event_id % 40 = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS frame,
        CAST((pedestrian % 16) * 1000 + sum(2 * (k - 45) + 20 * (pedestrian % 5 - 2)) OVER w AS BIGINT) AS xc,
        CAST(((pedestrian // 16) % 8) * 1000 + sum(7 * (event_id % 11) - 35) OVER w AS BIGINT) AS yc
        FROM e WINDOW w AS (PARTITION BY pedestrian ORDER BY rn ROWS UNBOUNDED PRECEDING)""",
    "tracks": f"""SELECT CASE WHEN pedestrian % 3 = 0 THEN 'plaza' ELSE 'street' END AS dataset, frame, pedestrian,
        CAST(xc AS DOUBLE) / {real(adapter.UNITS)} AS x, CAST(yc AS DOUBLE) / {real(adapter.UNITS)} AS y FROM walk""",
    "ranked": """SELECT dataset, frame, row_number() OVER (PARTITION BY dataset ORDER BY frame) - 1 AS r,
        count(*) OVER (PARTITION BY dataset) AS n FROM (SELECT DISTINCT dataset, frame FROM tracks)""",
    "parts": f"""SELECT dataset, frame, CASE WHEN r < floor(n * {real(0.6)}) THEN 'train'
        WHEN r < floor(n * {real(0.6)}) + floor(n * {real(0.2)}) THEN 'val' ELSE 'test' END AS split FROM ranked""",
    "st": "SELECT tracks.*, split FROM tracks JOIN parts USING (dataset, frame)",
    "stats": """SELECT *, count(*) OVER (PARTITION BY dataset, split, frame) AS n_rows,
        count(*) OVER (PARTITION BY dataset, split, frame, floor(x / 10), floor(y / 10)) > 1 AS is_close FROM st""",
    "win": f"""SELECT dataset, split, pedestrian, row_number() OVER ({_PEDS}) AS row_no,
        list({{'frame': frame, 'x': x, 'y': y}}) OVER {_AHEAD} AS path,
        CAST(sum(n_rows) OVER {_AHEAD} AS BIGINT) AS n_rows, bool_or(is_close) OVER {_AHEAD} AS is_close FROM stats""",
    "cand": f"""SELECT *, path[1].frame AS start, path[21].frame AS stop,
        (path[1].x - path[21].x) * (path[1].x - path[21].x) + (path[1].y - path[21].y) * (path[1].y - path[21].y) > 0 AS moved,
        list_sort([path[j + 1].frame - path[j].frame for j in range(1, 21)])[11] * {real(1.5)}
          > list_max([path[j + 1].frame - path[j].frame for j in range(1, 21)]) AS is_continuous,
        n_rows >= 42 AS is_active FROM win WHERE len(path) = 21 AND (row_no - 1) % 2 = 0""",
    "sc": """SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY list_position(['train', 'val', 'test'], split), pedestrian, start) - 1 AS scene
        FROM cand WHERE moved AND is_continuous AND is_active AND is_close""",
    "kinds": f"""SELECT *, {dist_sql('path[1].x', 'path[1].y', 'path[21].x', 'path[21].y')} AS travelled,
        {dist_sql(_forecast_sql('x'), _forecast_sql('y'), 'path[21].x', 'path[21].y')} AS fde FROM sc""",
    "own_kind": "SELECT *, CASE WHEN travelled < 1 THEN 1 WHEN fde < 0.5 THEN 2 END AS kind FROM kinds",
    "all_steps": """SELECT dataset, split, scene, pedestrian, kind, i, path[i + 1].frame AS frame, path[i + 1].x AS x, path[i + 1].y AS y,
        path[i].frame AS pframe, path[i].x AS px, path[i].y AS py FROM own_kind, range(1, 21) AS places(i)""",
    "steps": "SELECT * FROM all_steps WHERE i >= 9 AND kind IS NULL",
    "cone_hits": f"""SELECT s.dataset, s.scene, {within_sql('s.x - s.px', 's.y - s.py', 't.x - b.x', 't.y - b.y')} AS leads,
        {within_sql('s.x - s.px', 's.y - s.py', '-(t.x - b.x)', '-(t.y - b.y)')} AS avoids
        FROM steps s JOIN st t ON t.dataset = s.dataset AND t.split = s.split AND t.frame = s.frame AND t.pedestrian <> s.pedestrian
        LEFT JOIN st b ON b.dataset = s.dataset AND b.split = s.split AND b.frame = s.pframe AND b.pedestrian = t.pedestrian
        WHERE (s.x - t.x) * (s.x - t.x) + (s.y - t.y) * (s.y - t.y) <= 25
          AND {within_sql('s.x - s.px', 's.y - s.py', 't.x - s.x', 't.y - s.y')}""",
    "cones": """SELECT dataset, scene, true AS cone, coalesce(bool_or(leads), false) AS leader,
        coalesce(bool_or(avoids), false) AS avoidance FROM cone_hits GROUP BY dataset, scene""",
    "walkers": f"""SELECT s.dataset, s.scene, t.pedestrian AS other, avg({dist_sql('s.x', 's.y', 't.x', 't.y')}) AS mean_dist,
        stddev_pop({dist_sql('s.x', 's.y', 't.x', 't.y')}) AS std_dist, count(*) AS steps
        FROM steps s JOIN st t ON t.dataset = s.dataset AND t.split = s.split AND t.frame = s.frame AND t.pedestrian <> s.pedestrian
        GROUP BY s.dataset, s.scene, t.pedestrian""",
    "grouped": f"""SELECT dataset, scene, other, mean_dist, std_dist, steps FROM walkers
        WHERE steps >= 2 AND mean_dist < {real(0.8)} AND std_dist < {real(0.2)}""",
    "groups": "SELECT DISTINCT dataset, scene, true AS is_group FROM grouped",
    "typed": """SELECT k.*, coalesce(cone, false) AS cone, coalesce(leader, false) AS leader, coalesce(avoidance, false) AS avoidance,
        coalesce(is_group, false) AS is_group,
        CASE WHEN kind IS NOT NULL THEN kind WHEN coalesce(cone, false) OR coalesce(is_group, false) THEN 3 ELSE 4 END AS tag
        FROM own_kind k LEFT JOIN cones USING (dataset, scene) LEFT JOIN groups USING (dataset, scene)""",
    "subs": """SELECT *, CASE WHEN tag <> 3 THEN '' ELSE concat_ws(',', CASE WHEN leader THEN '1' END, CASE WHEN avoidance THEN '2' END,
        CASE WHEN is_group THEN '3' END, CASE WHEN NOT (leader OR avoidance OR is_group) THEN '4' END) END AS sub_tags FROM typed""",
    "draws": """SELECT *, CAST(CAST('0x' || substr(md5(concat_ws(':', '42', dataset, CAST(scene AS VARCHAR))), 1, 8) AS BIGINT) AS DOUBLE)
        / CAST(4294967296 AS DOUBLE) AS u FROM subs""",
    "accepted": f"SELECT * FROM draws WHERE u < CASE WHEN tag = 1 THEN {real(0.1)} ELSE 1 END",
    "renumbered": """SELECT * EXCLUDE (scene), row_number() OVER (PARTITION BY dataset
        ORDER BY list_position(['train', 'val', 'test'], split), pedestrian, start) - 1 AS scene FROM accepted""",
}


_CURVE = "dataset, pedestrian"
_LAG, _STEP = "lag({0}) OVER (PARTITION BY dataset, pedestrian ORDER BY k)", "lead({0}) OVER (PARTITION BY dataset, pedestrian ORDER BY k)"

# Positions on the frame grid from the control points ``pts`` (dataset, pedestrian, f, x, y in metres): lines for up to five points, else the
# spline. Its bends at the inner knots solve a tridiagonal system, one step of the recursion for each knot, forward and then back.
SPLINE: dict[str, str] = {
    "knots": f"""SELECT *, row_number() OVER (PARTITION BY {_CURVE} ORDER BY f, x, y) - 1 AS k, count(*) OVER (PARTITION BY {_CURVE}) AS n,
        min(f) OVER (PARTITION BY {_CURVE}) AS first FROM pts""",
    "spans": f"""SELECT *, {_STEP.format('f')} AS f2, {_STEP.format('x')} AS x2, {_STEP.format('y')} AS y2, CAST({_STEP.format('f')} - f AS DOUBLE) AS h FROM knots""",
    "slopes": "SELECT *, (x2 - x) / h AS sx, (y2 - y) / h AS sy FROM spans WHERE f2 IS NOT NULL",
    "inner_knots": f"SELECT *, {_LAG.format('h')} AS g, 6 * (sx - {_LAG.format('sx')}) AS rx, 6 * (sy - {_LAG.format('sy')}) AS ry FROM slopes WHERE n > 5",
    "eq": f"""SELECT {_CURVE}, k, n, h, g, rx, ry, g - CASE WHEN k = n - 2 THEN h * h / g ELSE 0 END AS lo,
        2 * (g + h) + CASE WHEN k = 1 THEN g * (g + h) / h ELSE 0 END + CASE WHEN k = n - 2 THEN h * (g + h) / g ELSE 0 END AS di,
        h - CASE WHEN k = 1 THEN g * g / h ELSE 0 END AS up FROM inner_knots WHERE k >= 1""",
    "fwd": f"""SELECT {_CURVE}, k, up, di, rx, ry FROM eq WHERE k = 1
        UNION ALL SELECT e.dataset, e.pedestrian, e.k, e.up, e.di - e.lo / b.di * b.up, e.rx - e.lo / b.di * b.rx, e.ry - e.lo / b.di * b.ry
        FROM fwd b JOIN eq e ON e.dataset = b.dataset AND e.pedestrian = b.pedestrian AND e.k = b.k + 1""",
    "back": f"""SELECT f.dataset, f.pedestrian, f.k, f.rx / f.di AS mx, f.ry / f.di AS my FROM fwd f JOIN eq ON eq.dataset = f.dataset AND eq.pedestrian = f.pedestrian AND eq.k = f.k WHERE f.k = n - 2
        UNION ALL SELECT f.dataset, f.pedestrian, f.k, (f.rx - f.up * b.mx) / f.di, (f.ry - f.up * b.my) / f.di
        FROM back b JOIN fwd f ON f.dataset = b.dataset AND f.pedestrian = b.pedestrian AND f.k = b.k - 1""",
    "bends": f"""SELECT {_CURVE}, k, mx, my FROM back
        UNION ALL SELECT dataset, pedestrian, 0, ((g + h) * a.mx - g * b.mx) / h, ((g + h) * a.my - g * b.my) / h
          FROM eq JOIN back a USING (dataset, pedestrian, k) JOIN back b ON b.dataset = eq.dataset AND b.pedestrian = eq.pedestrian AND b.k = 2 WHERE k = 1
        UNION ALL SELECT dataset, pedestrian, n - 1, ((g + h) * a.mx - h * b.mx) / g, ((g + h) * a.my - h * b.my) / g
          FROM eq JOIN back a USING (dataset, pedestrian, k) JOIN back b ON b.dataset = eq.dataset AND b.pedestrian = eq.pedestrian AND b.k = n - 3 WHERE k = n - 2""",
    "grid": """SELECT s.*, a.mx AS ax, a.my AS ay, b.mx AS bx, b.my AS by_, unnest(generate_series(
          CASE WHEN f = first THEN f // 10 * 10 + 10 ELSE CAST(ceil(f / 10) AS BIGINT) * 10 END, f2 - 1, 10)) AS frame
        FROM slopes s LEFT JOIN bends a USING (dataset, pedestrian, k)
        LEFT JOIN bends b ON b.dataset = s.dataset AND b.pedestrian = s.pedestrian AND b.k = s.k + 1""",
    "curves": """SELECT dataset, frame, pedestrian,
          CASE WHEN n <= 5 THEN sx * (frame - f) + x ELSE a * x + b * x2 + ((a * a * a - a) * ax + (b * b * b - b) * bx) * h * h / 6 END AS x,
          CASE WHEN n <= 5 THEN sy * (frame - f) + y ELSE a * y + b * y2 + ((a * a * a - a) * ay + (b * b * b - b) * by_) * h * h / 6 END AS y
        FROM (SELECT *, (frame - f) / h AS b, 1 - (frame - f) / h AS a FROM grid)""",
}


def sql(upto: str, select: str, **more: str) -> str:
    """``select`` over the shared tables up to and including ``upto``, and some of its own."""
    names = list(PARTS)
    tables = {n: PARTS[n] for n in names[:names.index(upto) + 1]} | more
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({body})" for n, body in tables.items()) + "\n" + select
