"""The library's operators over the driver's tables, each with the DuckDB statement that gives the same rows.

Proxies: a lineitem row is a point (frame l_suppkey, label l_linenumber), an orders row a frame of the scene
o_custkey, a supplier row a box, a documents row a file, and events are a depth image (row user_id, column the hour).
Floating results are rounded where sums could differ in their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom.functions import geometry as G
from depthloom.operators import chain, detection, imaging, quality, raycast, voxel

Query = Callable[[SparkSession, str], DataFrame]
GRID = G.Grid(0.4, (0.0, -0.4, 0.0), (12, 8, 4))
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

POINTS = """p AS (SELECT l_suppkey AS frame, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity * 0.1 AS x, l_discount * 20 AS y,
  l_tax * 20 AS z, l_linenumber AS label, l_linenumber * 35 AS r FROM lineitem)"""
CELLS = f"""{POINTS}, c AS (SELECT * FROM (SELECT *, CAST(floor((x - 0.0) / 0.4) AS BIGINT) AS ix, CAST(floor((y - -0.4) / 0.4) AS BIGINT) AS iy,
  CAST(floor((z - 0.0) / 0.4) AS BIGINT) AS iz FROM p) WHERE ix >= 0 AND ix < 12 AND iy >= 0 AND iy < 8 AND iz >= 0 AND iz < 4)"""
LAST = f"""{CELLS}, o AS (SELECT frame, ix, iy, iz, arg_max(label, row(l_orderkey, l_linenumber, l_partkey, frame, l_extendedprice)) AS sem FROM c GROUP BY ALL)"""
ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "frame", "l_extendedprice")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return read(spark, sf_dir, "lineitem").select(
        c("l_suppkey").alias("frame"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", (c("l_quantity") * 0.1).alias("x"), (c("l_discount") * 20).alias("y"), (c("l_tax") * 20).alias("z"), c("l_linenumber").alias("label"), (c("l_linenumber") * 35).alias("r")
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.with_cells(points(spark, sf_dir), GRID)


def surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.last_label(cells(spark, sf_dir), "label", [F.col(c) for c in ORDER])


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return read(spark, sf_dir, "supplier").select(
        c("s_suppkey").alias("frame"), c("s_suppkey").alias("box"), (c("s_suppkey") % 5 + F.lit(0.5)).alias("bx"), (c("s_suppkey") % 3 * F.lit(0.5)).alias("by"), F.lit(0.8).alias("bz"), (c("s_nationkey") * F.lit(0.25)).alias("yaw"),
        (c("s_suppkey") % 4 + F.lit(1.0)).alias("sx"), F.lit(1.5).alias("sy"), F.lit(1.6).alias("sz"), (c("s_nationkey") % 7 + 1).alias("cls"),
    )


BOXES = """x AS (SELECT s_suppkey AS frame, s_suppkey AS box, s_suppkey % 5 + CAST(0.5 AS DOUBLE) AS bx, s_suppkey % 3 * CAST(0.5 AS DOUBLE) AS b_y, CAST(0.8 AS DOUBLE) AS bz,
  s_nationkey * CAST(0.25 AS DOUBLE) AS yaw, s_suppkey % 4 + CAST(1.0 AS DOUBLE) AS sx, CAST(1.5 AS DOUBLE) AS sy, CAST(1.6 AS DOUBLE) AS sz, s_nationkey % 7 + 1 AS cls FROM supplier)"""


def pairs_sql(margin: float) -> str:
    return f"""{POINTS}, {BOXES}, i AS (SELECT x.box, x.cls, p.label FROM p JOIN x ON p.frame = x.frame
  WHERE abs((p.x - bx) * cos(yaw) + (p.y - b_y) * sin(yaw)) <= sx / 2 + CAST({margin} AS DOUBLE) AND abs((p.y - b_y) * cos(yaw) - (p.x - bx) * sin(yaw)) <= sy / 2 + CAST({margin} AS DOUBLE)
  AND abs(p.z - bz) <= sz / 2 + CAST({margin} AS DOUBLE))"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("scene"), "o_orderkey", "o_orderdate", G.token("sample", F.col("o_orderkey")).alias("token"), "o_totalprice", "o_orderstatus")


FRAMES = "f AS (SELECT o_custkey AS scene, o_orderkey, o_orderdate, md5('sample:' || o_orderkey) AS token, o_totalprice, o_orderstatus FROM orders)"


def image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame a weekday: row user, column hour, depth the mean value in metres; missing below 0.3 or above 8."""
    e = read(spark, sf_dir, "events")
    z = F.sum(F.round(F.col("value") * 100).cast("long")).cast("double") / F.count(F.lit(1)) / 1000
    grouped = e.groupBy(F.dayofweek("ts").cast("long").alias("frame"), F.col("user_id").alias("v"), F.hour("ts").cast("long").alias("u")).agg(z.alias("depth"))
    return grouped.withColumn("z", F.when((F.col("depth") > 0.3) & (F.col("depth") < 8), F.col("depth")))


IMAGE = """g AS (SELECT dayofweek(ts) + 1 AS frame, user_id AS v, hour(ts) AS u,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 1000 AS depth FROM events GROUP BY ALL),
m AS (SELECT *, CASE WHEN depth > 0.3 AND depth < 8 THEN depth END AS z FROM g)"""


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


KEY = "l_orderkey, l_linenumber, l_partkey, frame, l_extendedprice"


@query(f"WITH {POINTS} SELECT {KEY}, z AS ex, 0.0 - x AS ey, 0.0 - y AS ez, 0.0 - y AS gx, x AS gy, z AS gz FROM p")
def q_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir)
    e = G.camera_to_ego(F.col("x"), F.col("y"), F.col("z"))
    g = G.ego_to_speckle(F.col("x"), F.col("y"), F.col("z"))
    plus = F.lit(0.0)
    return p.select(*ORDER, *[(v + plus).alias(n) for n, v in zip(("ex", "ey", "ez", "gx", "gy", "gz"), (*e, *g), strict=True)])


@query(
    f"""WITH {POINTS}, n AS (SELECT *, (x * 100 - 250.0) / 300.0 AS a, (y * 100 - 50.0) / 300.0 AS b FROM p WHERE z > 1e-4),
s AS (SELECT *, CAST(1.0 AS DOUBLE) + 0.1 * (a * a + b * b) + 0.01 * (a * a + b * b) * (a * a + b * b) AS k FROM n)
SELECT {KEY}, a * k * z AS cx, b * k * z AS cy, z AS cz FROM s"""
)
def q_deproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir).where(G.usable_depth(F.col("z")))
    f, cx, cy = F.lit(300.0), F.lit(250.0), F.lit(50.0)
    x, y, z = G.deproject(F.col("x") * 100, F.col("y") * 100, F.col("z"), f, f, cx, cy, 0.1, 0.01)
    return p.select(*ORDER, x.alias("cx"), y.alias("cy"), z.alias("cz"))


@query(f"WITH {POINTS} SELECT {KEY}, CASE WHEN x < 0.3 OR x > 4.0 THEN CAST(0 AS DOUBLE) ELSE x END AS depth FROM p")
def q_mask_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).select(*ORDER, G.masked_depth(F.col("x"), (0.3, 4.0)).alias("depth"))


@query(
    f"""WITH {POINTS} SELECT frame, CAST(floor((x - 0.0) / 0.4) AS BIGINT) AS ix, CAST(floor((y - 0.0) / 0.4) AS BIGINT) AS iy, CAST(floor((z - 0.0) / 0.4) AS BIGINT) AS iz,
count(*) AS points, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z, CAST(round_even(avg(r), 0) AS SMALLINT) AS r FROM p GROUP BY ALL"""
)
def q_voxel_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = voxel.downsample(points(spark, sf_dir), 0.4, colours=("r",))
    return out.withColumns({c: F.round(c, 6) for c in ("x", "y", "z")})


_CELL04 = f"{POINTS}, c AS (SELECT *, CAST(floor((x - 0.0) / 0.3) AS BIGINT) AS ix, CAST(floor((y - 0.0) / 0.3) AS BIGINT) AS iy, CAST(floor((z - 0.0) / 0.3) AS BIGINT) AS iz FROM p)"
_NEAR = "FROM {0} a JOIN {0} b ON a.frame = b.frame AND abs(a.ix - b.ix) <= 1 AND abs(a.iy - b.iy) <= 1 AND abs(a.iz - b.iz) <= 1 GROUP BY a.frame, a.ix, a.iy, a.iz"


@query(
    f"""WITH {_CELL04}, n AS (SELECT frame, ix, iy, iz, count(*) AS n FROM c GROUP BY ALL),
k AS (SELECT a.frame, a.ix, a.iy, a.iz, sum(b.n) AS near {_NEAR.format("n")})
SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.frame, c.l_extendedprice FROM c JOIN k USING (frame, ix, iy, iz) WHERE near >= 6"""
)
def q_sor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.radius_filter(points(spark, sf_dir), 0.3, 6).select(*ORDER)


@query(
    f"""WITH {POINTS}, c0 AS (SELECT *, CAST(floor((x - 1.0) / 0.3) AS BIGINT) AS jx, CAST(floor((y - 0.3) / 0.3) AS BIGINT) AS jy, CAST(floor((z - -1.5) / 0.3) AS BIGINT) AS jz FROM p),
t AS (SELECT frame, max(jx) + 1 AS tx, max(jy) + 1 AS ty, max(jz) + 1 AS tz FROM c0 GROUP BY frame),
c AS (SELECT c0.*, CASE WHEN tx > 0 THEN ((jx % tx) + tx) % tx ELSE jx END AS ix, CASE WHEN ty > 0 THEN ((jy % ty) + ty) % ty ELSE jy END AS iy,
  CASE WHEN tz > 0 THEN ((jz % tz) + tz) % tz ELSE jz END AS iz FROM c0 JOIN t USING (frame)),
d AS (SELECT DISTINCT frame, ix, iy, iz FROM c), k AS (SELECT a.frame, a.ix, a.iy, a.iz, count(*) AS near {_NEAR.format("d")})
SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.frame, c.l_extendedprice FROM c JOIN k USING (frame, ix, iy, iz) WHERE near >= 4"""
)
def q_speckle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.speckle_filter(points(spark, sf_dir), 0.3, (1.0, 0.3, -1.5), 4).select(*ORDER)


@query(f"WITH {LAST} SELECT * FROM o")
def q_label_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surfaces(spark, sf_dir)


@query(
    f"""WITH {CELLS}, v AS (SELECT frame, ix, iy, iz, label % 3 AS sem, count(*) AS votes FROM c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY frame, ix, iy, iz ORDER BY votes DESC, sem) AS k FROM v)
SELECT frame, ix, iy, iz, sem, votes AS most FROM r WHERE k = 1"""
)
def q_label_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.voted_label(cells(spark, sf_dir).withColumn("label", F.col("label") % 3), "label")


@query(f"WITH {CELLS} SELECT frame, ix, iy, iz, max(label) AS sem FROM c GROUP BY ALL")
def q_label_amax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.highest_label(cells(spark, sf_dir), "label")


@query(f"WITH {CELLS} SELECT DISTINCT frame, ix, iy, iz FROM c")
def q_occupied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.occupied(cells(spark, sf_dir))


RAYS = raycast.crossed_sql(GRID, "(SELECT l_suppkey AS frame, l_quantity * 0.1 AS x, l_discount * 20 AS y, l_tax * 20 AS z FROM lineitem) s")


@query(RAYS)
def q_raycast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raycast.crossed(points(spark, sf_dir), GRID)


@query(f"WITH {CELLS}, y AS ({RAYS}) SELECT * FROM y EXCEPT SELECT frame, ix, iy, iz FROM c")
def q_free_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.free_only(raycast.crossed(points(spark, sf_dir), GRID), cells(spark, sf_dir))


TRISTATE = f"{LAST}, y AS ({RAYS}), s AS (SELECT frame, ix, iy, iz, sem FROM o UNION ALL SELECT *, 17 FROM (SELECT * FROM y EXCEPT SELECT frame, ix, iy, iz FROM c))"


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rays = raycast.crossings(points(spark, sf_dir), GRID)
    return voxel.tristate_at_once(cells(spark, sf_dir), "label", [F.col(c) for c in ORDER], rays)


@query(f"WITH {TRISTATE} SELECT * FROM s")
def q_tristate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state(spark, sf_dir)


@query(
    f"""WITH {LAST}, d AS (SELECT DISTINCT frame FROM o), g AS (SELECT frame, a.range AS ix, b.range AS iy, e.range AS iz FROM d, range(12) a, range(8) b, range(4) e)
SELECT frame, ix, iy, iz, coalesce(sem, 17) AS sem, sem IS NOT NULL AS observed FROM g LEFT JOIN o USING (frame, ix, iy, iz)"""
)
def q_densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.densify(surfaces(spark, sf_dir), GRID)


@query(f"WITH {TRISTATE} SELECT sem, count(*) AS cells FROM s WHERE sem <> 17 GROUP BY sem")
def q_class_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.class_histogram(state(spark, sf_dir))


@query(
    f"""WITH {TRISTATE} SELECT frame, ix, iy, arg_max(sem, iz) FILTER (sem <> 17) AS top, max(iz) FILTER (sem <> 17) AS top_z, bool_or(sem = 17) AS any_free FROM s GROUP BY frame, ix, iy"""
)
def q_bev_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.bev_top(state(spark, sf_dir))


@query(f"WITH {CELLS} SELECT frame, greatest(min(ix) - 2, 0) AS x0, least(max(ix) + 3, 12) AS x1, greatest(min(iy) - 2, 0) AS y0, least(max(iy) + 3, 8) AS y1 FROM c GROUP BY frame")
def q_bev_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.bev_bounds(cells(spark, sf_dir), GRID, 2)


@query(
    f"""WITH {CELLS}, o AS (SELECT DISTINCT frame, ix, iy, iz FROM c)
SELECT frame, ix, iy, iz, CAST(k.range AS INTEGER) AS corner, round((ix + 0.5) * CAST(0.4 AS DOUBLE) + 0.0 + (k.range & 1) * 0.38 - 0.19, 6) AS x,
round((iy + 0.5) * CAST(0.4 AS DOUBLE) - 0.4 + ((k.range >> 1) & 1) * 0.38 - 0.19, 6) AS y, round((iz + 0.5) * CAST(0.4 AS DOUBLE) + 0.0 + ((k.range >> 2) & 1) * 0.38 - 0.19, 6) AS z
FROM o, range(8) k"""
)
def q_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = voxel.cube_corners(voxel.occupied(cells(spark, sf_dir)), GRID)
    return out.withColumns({c: F.round(c, 6) for c in ("x", "y", "z")})


@query(
    f"""WITH {TRISTATE}, r AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY ix, iy, iz) AS k FROM s WHERE sem = 17) SELECT frame, ix, iy, iz FROM r WHERE (k - 1) % 8 = 0"""
)
def q_free_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    free = state(spark, sf_dir).where(F.col("sem") == voxel.FREE)
    return voxel.every_nth(free, 8, ("frame",), [F.col(c) for c in voxel.CELL]).drop("sem")


@query(
    f"""WITH {IMAGE}, n AS (SELECT a.frame, a.v, a.u, median(b.z) AS med FROM m a JOIN m b ON a.frame = b.frame AND b.v BETWEEN a.v - 2 AND a.v + 2 AND b.u BETWEEN a.u - 2 AND a.u + 2 GROUP BY ALL)
SELECT frame, v, u, round(CASE WHEN z IS NOT NULL THEN coalesce(med, depth) ELSE 0 END, 9) AS d1 FROM m JOIN n USING (frame, v, u)"""
)
def q_median5x5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = imaging.median5x5(image(spark, sf_dir))
    return out.select("frame", "v", "u", F.round(F.when(F.col("z").isNotNull(), F.coalesce("med", "depth")).otherwise(0.0), 9).alias("d1"))


def _slope_sql(group: str, place: str) -> str:
    w = f"(PARTITION BY {group} ORDER BY {place})"
    return f"""CASE WHEN count(*) OVER (PARTITION BY {group}) = 1 THEN 0.0 WHEN row_number() OVER {w} = 1 THEN lead(k) OVER {w} - k
  WHEN row_number() OVER {w} = count(*) OVER (PARTITION BY {group}) THEN k - lag(k) OVER {w} ELSE (lead(k) OVER {w} - lag(k) OVER {w}) / 2 END"""


@query(
    f"""WITH {IMAGE}, q AS (SELECT *, CASE WHEN depth > 0.3 THEN depth END AS k FROM m), s AS (SELECT *, {_slope_sql("frame, u", "v")} AS gy, {_slope_sql("frame, v", "u")} AS gx FROM q)
SELECT frame, v, u, CASE WHEN k IS NOT NULL AND coalesce(sqrt(gy * gy + gx * gx), 0) < 0.05 THEN depth ELSE 0 END AS kept FROM s"""
)
def q_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imaging.gradient_reject(image(spark, sf_dir), value="depth").select("frame", "v", "u", "kept")


@query(
    f"""WITH {FRAMES} SELECT scene, token, coalesce(lag(token) OVER w, 'EOF') AS prev, coalesce(lead(token) OVER w, 'EOF') AS next FROM f WINDOW w AS (PARTITION BY scene ORDER BY o_orderdate, token)"""
)
def q_frame_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.linked(frames(spark, sf_dir), "scene", ["o_orderdate", "token"]).select("scene", "token", "prev", "next")


@query(
    f"""WITH {FRAMES} SELECT scene, count(*) AS nbr_samples, arg_min(token, row(o_orderdate, token)) AS first_sample_token, arg_max(token, row(o_orderdate, token)) AS last_sample_token FROM f GROUP BY scene"""
)
def q_scene_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.scene_rollup(frames(spark, sf_dir), "scene", ["o_orderdate", "token"])


@query(f"""WITH {FRAMES} SELECT CAST(floor(o_totalprice / 1000) AS BIGINT) AS k, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM f GROUP BY k""")
def q_calib_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.first_per_key(frames(spark, sf_dir), [F.floor(F.col("o_totalprice") / 1000).alias("k")], "o_totalprice", ["o_orderkey"])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, c_name AS scene, n_name AS K, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
)
def q_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data rows with their sample (orders), scene (customer) and calibration (nation)."""
    data = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_orderkey").alias("sample_token"), F.lit("CAM_FRONT").alias("filename"))
    customer = read(spark, sf_dir, "customer")
    sample = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("token"), F.col("o_custkey").alias("scene_token"), "o_orderstatus")
    scene = customer.select(F.col("c_custkey").alias("token"), F.col("c_name").alias("name"), "c_nationkey")
    k = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("token"), F.col("n_name").alias("camera_intrinsic"))
    cal = sample.join(scene.select(F.col("token").alias("scene_token"), "c_nationkey"), "scene_token").select(F.col("token").alias("sample_token"), F.col("c_nationkey").alias("calibrated_sensor_token"), "o_orderstatus")
    return chain.tasks(data.join(cal, "sample_token"), sample, scene, k).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "scene", "K", "o_orderstatus")


@query(f"""WITH {FRAMES}, r AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY o_orderdate, o_orderkey) AS k FROM f) SELECT scene, token FROM r WHERE k <= 3""")
def q_limit_per_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.first_rows(frames(spark, sf_dir), 3, "scene", ["o_orderdate", "o_orderkey"]).select("scene", "token")


@query("""WITH r AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) SELECT event_id, user_id FROM r WHERE (k - 1) % 4 = 0""")
def q_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel.every_nth(read(spark, sf_dir, "events").select("event_id", "user_id"), 4, ("user_id",), [F.col("event_id")])


_BRANDS = {f"brand#{i}{j}": detection.CLASSES[(i * 5 + j) % 13] for i in range(1, 5) for j in range(1, 6)}


@query(
    f"""WITH b(name, cls) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _BRANDS.items())})
SELECT p_partkey, coalesce(cls, 'objects') AS cls13 FROM part LEFT JOIN b ON lower(p_brand) = b.name"""
)
def q_class_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", detection.class_of(F.col("p_brand"), _BRANDS).alias("cls13"))


@query(f"WITH {pairs_sql(0.05)}, n AS (SELECT box, count(*) AS n FROM i GROUP BY box) SELECT box, coalesce(n, 0) AS num_lidar_pts FROM x LEFT JOIN n USING (box)")
def q_points_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.points_per_box(points(spark, sf_dir), boxes(spark, sf_dir)).select("box", "num_lidar_pts")


@query(f"WITH {pairs_sql(0.05)}, n AS (SELECT box, count(*) AS n FROM i GROUP BY box) SELECT box, cls FROM x SEMI JOIN (SELECT box FROM n WHERE n >= 100) USING (box)")
def q_min_pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir)
    return detection.with_least_points(detection.points_per_box(points(spark, sf_dir), b), b, 100)[1].select("box", "cls")


@query(f"WITH {pairs_sql(0.1)} SELECT box, count(*) AS points, round(avg(CAST(label = cls AS INTEGER)), 9) AS rate FROM i GROUP BY box HAVING count(*) >= 5")
def q_label_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.label_rates(points(spark, sf_dir), boxes(spark, sf_dir)).withColumn("rate", F.round("rate", 9))


_CORNER_U = ", ".join(f"200.0 * (-(b_y + ({a}) * sx / 2 * sin(yaw) + ({b}) * sy / 2 * cos(yaw))) / (bx + 3.0 + ({a}) * sx / 2 * cos(yaw) - ({b}) * sy / 2 * sin(yaw)) + 160.0" for a in (-1, 1) for b in (-1, 1))
_CORNER_V = ", ".join(f"-200.0 * (bz + ({d}) * sz / 2) / (bx + 3.0 + ({a}) * sx / 2 * cos(yaw) - ({b}) * sy / 2 * sin(yaw)) + 120.0" for a in (-1, 1) for b in (-1, 1) for d in (-1, 1))
_CORNER_F = ", ".join(f"bx + 3.0 + ({a}) * sx / 2 * cos(yaw) - ({b}) * sy / 2 * sin(yaw)" for a in (-1, 1) for b in (-1, 1))
IOU = f"""{BOXES}, q AS (SELECT box, least({_CORNER_F}) AS f, greatest(least({_CORNER_U}), 0.0) AS x1, greatest(least({_CORNER_V}), 0.0) AS y1, least(greatest({_CORNER_U}), 320.0) AS x2, least(greatest({_CORNER_V}), 240.0) AS y2 FROM x),
k AS (SELECT *, greatest(0.0, least(x2, 220.0) - greatest(x1, 100.0)) * greatest(0.0, least(y2, 150.0) - greatest(y1, 50.0)) AS i FROM q),
iou AS (SELECT box, CASE WHEN f > 0.05 AND (x2 - x1) * (y2 - y1) + 12000.0 - i > 0 THEN round(i / ((x2 - x1) * (y2 - y1) + 12000.0 - i), 9) END AS iou FROM k)"""


def ious(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    iou = G.projected_overlap(
        (c("bx") + 3.0, c("by"), c("bz")), c("yaw"), (c("sx") / 2, c("sy") / 2, c("sz") / 2), F.lit(200.0), F.lit(200.0), F.lit(160.0), F.lit(120.0), (F.lit(100.0), F.lit(50.0), F.lit(120.0), F.lit(100.0)), F.lit(320.0), F.lit(240.0)
    )
    return boxes(spark, sf_dir).select("box", F.round(iou, 9).alias("iou"))


@query(f"WITH {IOU} SELECT * FROM iou")
def q_box_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ious(spark, sf_dir)


@query(f"WITH {IOU} SELECT count(iou) AS n, round(avg(iou), 3) AS mean, round(median(iou), 3) AS median, round(avg(CASE WHEN iou > 0.5 THEN 1.0 WHEN iou <= 0.5 THEN 0.0 END), 3) AS gt05 FROM iou")
def q_iou_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.rate_summary(ious(spark, sf_dir), "iou")


@query(
    f"""WITH {BOXES}, t AS (SELECT box, cos(yaw) AS c, sin(yaw) AS s FROM x)
SELECT box, CASE WHEN 2 * c + 1 > 0 THEN round(sqrt(greatest(2 * c + 1 + 1, 0)) / 2, 9) ELSE round(s / (2 * (sqrt(greatest(2.0 - 2 * c, 0)) / 2)), 9) END AS qw,
CASE WHEN 2 * c + 1 > 0 THEN round(s / (2 * (sqrt(greatest(2 * c + 1 + 1, 0)) / 2)), 9) ELSE round(sqrt(greatest(2.0 - 2 * c, 0)) / 2, 9) END AS qz FROM t"""
)
def q_yaw_quaternion(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = boxes(spark, sf_dir).select("box", G.yaw_quaternion(F.col("yaw")).alias("q"))
    return q.select("box", F.round(F.col("q")[0], 9).alias("qw"), F.round(F.col("q")[3], 9).alias("qz"))


@query("SELECT o_orderkey, o_totalprice FROM orders, (SELECT median(o_totalprice) AS m FROM orders) WHERE m > 0 AND o_totalprice < m * CAST(0.05 AS DOUBLE)")
def q_qc_low_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.low_counts(read(spark, sf_dir, "orders"), "o_totalprice").select("o_orderkey", "o_totalprice")


@query(
    "SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS median, round(quantile_cont(l_extendedprice, 0.05), 6) AS p5, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem GROUP BY l_returnflag"
)
def q_qc_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.percentiles(read(spark, sf_dir, "lineitem"), "l_extendedprice", {"median": 0.5, "p5": 0.05, "p95": 0.95}, ["l_returnflag"])
    return out.withColumns({"p5": F.round("p5", 6), "p95": F.round("p95", 6)})


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def q_qc_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = read(spark, sf_dir, "orders").select("o_orderkey")
    return chain.missing(expected, read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query(
    """SELECT c_custkey FROM (SELECT c_custkey, c_acctbal AS f, c_nationkey AS c, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 20 END AS w FROM customer)
WHERE NOT (f > 0 AND f > 0 AND c > 0 AND c <= coalesce(w, 1000000) AND c > 0 AND c <= coalesce(w, 1000000))"""
)
def q_qc_intrinsics(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("c_mktsegment") != "BUILDING", F.lit(20))
    f, c = F.col("c_acctbal"), F.col("c_nationkey")
    return read(spark, sf_dir, "customer").where(~quality.legal_intrinsics(f, f, c, c, size, size)).select("c_custkey")


@query("SELECT doc_id, md5(text) AS md5, CAST(strlen(text) AS BIGINT) AS bytes, replace(source || '/' || doc_id, '\\', '/') AS file FROM documents")
def q_manifest_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.replace(F.concat_ws("/", "source", F.col("doc_id").cast("string")), F.lit("\\"), F.lit("/"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("md5"), F.octet_length("text").cast("long").alias("bytes"), path.alias("file"))


@query(
    """WITH a AS (SELECT doc_id AS key, md5(text) AS s FROM documents WHERE lang <> 'de'), b AS (SELECT doc_id AS key, CASE WHEN source = 'src1' THEN n_chars || ':' || strlen(text) ELSE md5(text) END AS s FROM documents WHERE lang <> 'fr')
SELECT key, CASE WHEN b.s IS NULL THEN 'only_a' WHEN a.s IS NULL THEN 'only_b' WHEN a.s = b.s THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b USING (key)"""
)
def q_manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    a = d.where("lang <> 'de'").select(F.col("doc_id").alias("key"), F.md5("text").alias("signature"))
    md5 = F.when(F.col("source") != "src1", F.md5("text"))
    b = d.where("lang <> 'fr'").select(F.col("doc_id").alias("key"), quality.signature(md5, F.col("n_chars"), F.octet_length("text")).alias("signature"))
    return quality.manifest_diff(a, b)


@query("SELECT o_orderstatus AS status, count(*) AS frames FROM orders GROUP BY 1")
def q_status_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.status_tally(read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS product, count(*) AS n FROM {t}" for t in ("lineitem", "orders", "supplier", "documents", "embeddings")))
def q_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for t in ("lineitem", "orders", "supplier", "documents", "embeddings"):
        one = read(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("product"), "n")
        out = one if out is None else out.union(one)
    return out


@query(
    """SELECT l_orderkey AS frame, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS boxes FROM lineitem WHERE l_quantity > 10 GROUP BY l_orderkey"""
)
def q_boxes2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_linenumber").cast("string").alias("cls"), F.col("l_partkey").alias("cls13"),
        detection.valid_bb2d(F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity") - 10, F.lit(1.0))).alias("bbox"),
    )
    out = detection.boxes_by_frame(b, ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("frame", F.array_join(F.transform("boxes", lambda x: F.concat_ws(":", x["cls"], x["cls13"].cast("string"))), ",").alias("boxes"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda e: CAST(e AS DOUBLE) * CAST(e AS DOUBLE)))), 9) AS norm FROM embeddings")
def q_vector_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.round(G.norm(F.col("embedding").cast("array<double>")), 9).alias("norm"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.page') AS page FROM events")
def q_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.page").alias("page"))


@query("SELECT page_id, regexp_extract(url, '([0-9]+)', 1) AS number, string_split(url, '/')[3] AS host, contains(url, 'https') AS https, format('{:06d}', page_id) AS name FROM pages")
def q_path_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", F.regexp_extract(url, "([0-9]+)", 1).alias("number"), F.get(F.split(url, "/"), 2).alias("host"), url.contains("https").alias("https"), F.format_string("%06d", "page_id").alias("name"))


@query("SELECT o_orderkey, md5('sd:' || o_orderstatus || ':' || o_orderkey || ':cam') AS camera, md5('sd:' || o_orderstatus || ':' || o_orderkey || ':lid') AS lidar FROM orders")
def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (F.col("o_orderstatus"), F.col("o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", G.token("sd", *key, "cam").alias("camera"), G.token("sd", *key, "lid").alias("lidar"))


@query(f"WITH {POINTS} SELECT {KEY}, (r + l_linenumber + 7) / CAST(3.0 AS DOUBLE) / CAST(255.0 AS DOUBLE) AS intensity, (greatest(-1.0, least(5.4, x + 3.0)) - -1.0) / 6.4 AS ramp FROM p")
def q_point_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = G.intensity(F.col("r"), F.col("l_linenumber"), F.lit(7))
    return points(spark, sf_dir).select(*ORDER, i.alias("intensity"), G.height_share(F.col("x") + 3.0).alias("ramp"))


@query(
    """SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 AND s_suppkey % 2 = 0 THEN NULL ELSE coalesce(CASE WHEN s_nationkey % 3 <> 0 THEN s_acctbal END, 0.0) END AS tx,
CASE WHEN s_nationkey % 3 = 0 AND s_suppkey % 2 = 0 THEN NULL ELSE CAST(coalesce(CASE WHEN s_suppkey % 2 <> 0 THEN 0.5 END, 1.0) AS DOUBLE) END AS qw FROM supplier"""
)
def q_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(F.col("s_nationkey") % 3 != 0, F.array("s_acctbal", F.lit(0.0), F.lit(0.0)))
    r = F.when(F.col("s_suppkey") % 2 != 0, F.array(F.lit(0.5), F.lit(0.5), F.lit(0.5), F.lit(0.5)))
    out = read(spark, sf_dir, "supplier").select("s_suppkey", G.pose(t, r).alias("pose"))
    return out.select("s_suppkey", F.col("pose.translation")[0].alias("tx"), F.col("pose.rotation")[0].alias("qw"))


@query("SELECT p_partkey FROM part WHERE NOT (least(p_size / 5.0, p_retailprice / 200.0) > 0.02 AND greatest(p_size / 5.0, p_retailprice / 200.0) < 8 AND sqrt(p_size * p_size * CAST(1.0 AS DOUBLE) + 0.0) <= 40)")
def q_box_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.array(F.col("p_size") / 5.0, F.col("p_retailprice") / 200.0)
    return read(spark, sf_dir, "part").where(~detection.sane_box(size, F.array(F.col("p_size").cast("double"), F.lit(0.0), F.lit(0.0)))).select("p_partkey")


@query("SELECT l_returnflag AS split, CAST(l_linenumber * 3 AS INTEGER) AS label, l_linenumber * 3 <= 16 AS legal, count(*) AS n FROM lineitem GROUP BY ALL")
def q_legal_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of labels by split; those above 16 are told apart."""
    label = (F.col("l_linenumber") * 3).cast("int")
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("split"), label.alias("label"))
    return rows.groupBy("split", "label", voxel.legal_label(F.col("label")).alias("legal")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT c_custkey AS key FROM customer INTERSECT SELECT o_custkey FROM orders"""
)
def q_common_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")).intersect(read(spark, sf_dir, "orders").select("o_custkey"))


@query(
    """SELECT p_partkey, CASE WHEN regexp_full_match('12', '[0-9]+') THEN p_partkey = 12 END OR contains(p_name, 'red') AS wanted FROM part"""
)
def q_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depthloom.functions.names import wanted

    return read(spark, sf_dir, "part").select("p_partkey", (wanted(F.format_string("img-%06d", "p_partkey"), ["12"]) | wanted(F.col("p_name"), ["red"])).alias("wanted"))


@query(f"""WITH {IMAGE} SELECT frame, coalesce(median(CASE WHEN depth > 0.3 THEN depth END), 0.0) AS median_depth FROM g GROUP BY frame""")
def q_median_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imaging.median_depth(image(spark, sf_dir))


@query(
    """WITH e AS (SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 50 = 0 THEN 0 WHEN doc_id % 50 = 1 THEN 1 ELSE n_chars END AS count, CAST(strlen(text) AS BIGINT) AS bytes, (doc_id % 40) / 10.0 AS near, doc_id FROM documents),
f AS (SELECT CAST(doc_id AS VARCHAR) AS key, CAST(strlen(text) AS BIGINT) + CASE WHEN doc_id % 11 = 5 THEN 1 ELSE 0 END AS length FROM documents WHERE doc_id % 7 <> 3),
s AS (SELECT e.*, length, (SELECT quantile_cont(count, 0.5) FROM e) AS m FROM e LEFT JOIN f USING (key))
SELECT 'error' AS level, CASE WHEN length IS NULL THEN 'missing' WHEN length <> bytes THEN 'size' ELSE 'empty' END AS code, key FROM s WHERE length IS NULL OR length <> bytes OR count = 0
UNION ALL SELECT 'warning', 'low_count', key FROM s WHERE m > 0 AND count < m * CAST(0.05 AS DOUBLE)
UNION ALL SELECT 'warning', 'near', key FROM s WHERE near > 0 AND near < 1"""
)
def q_qc_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = read(spark, sf_dir, "documents"), F.col("doc_id")
    key, size = i.cast("string").alias("key"), F.octet_length("text").cast("long")
    count = F.when(i % 50 == 0, 0).when(i % 50 == 1, 1).otherwise(F.col("n_chars")).cast("long")
    entries = d.select(key, i.cast("string").alias("file"), count.alias("count"), size.alias("bytes"), (i % 40 / 10.0).alias("median_depth"))
    files = d.where(i % 7 != 3).select(i.cast("string").alias("file"), (size + F.when(i % 11 == 5, 1).otherwise(0)).alias("length"))
    return quality.file_issues(entries, files)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 25 = 0")
def q_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sampled(read(spark, sf_dir, "orders").select("o_orderkey"), 25, "o_orderkey")


@query(
    """SELECT o_orderkey AS token, c_name AS scene, 'img-' || CASE WHEN l_orderkey < 1000000 THEN lpad(CAST(l_orderkey AS VARCHAR), 6, '0') ELSE CAST(l_orderkey AS VARCHAR) END AS frame
FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1"""
)
def q_token_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("token"), F.col("o_custkey").alias("scene_token"))
    scene = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("token"), F.col("c_name").alias("name"))
    folder = F.when(F.col("l_linenumber") == 1, "CAM_FRONT").otherwise("LIDAR_TOP")
    data = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sample_token"), F.concat(F.lit("samples/"), folder, F.format_string("/img-%06d.jpg", "l_orderkey")).alias("filename"))
    return chain.frame_of_token(sample, scene, data)


@query(f"WITH {POINTS} SELECT {KEY}, upper(p_brand) AS category FROM p JOIN part ON l_partkey = p_partkey")
def q_annotation_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    annotation = points(spark, sf_dir).select(*ORDER, F.col("l_partkey").alias("instance_token"))
    instance = part.select(F.col("p_partkey").alias("token"), F.col("p_brand").alias("category_token"))
    category = part.select(F.col("p_brand").alias("token"), F.upper("p_brand").alias("name")).distinct()
    return chain.annotated(annotation, instance, category).select(*ORDER, "category")


@query(
    """WITH a AS (SELECT o_custkey, o_orderkey, row_number() OVER w AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
b AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_totalprice > 50000)
SELECT o_custkey, o_orderkey, o_totalprice AS fresh FROM a LEFT JOIN b USING (o_custkey, r, n)"""
)
def q_zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    values = o.where("o_totalprice > 50000").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("fresh"))
    return chain.zipped(o.select("o_custkey", "o_orderkey"), values, "o_custkey", ["o_orderkey"], "fresh")


def turned_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes, turned about a slanted axis, as centre, rotation and half size."""
    b, half = boxes(spark, sf_dir), F.col("yaw") / 2
    q = F.array(F.cos(half), F.sin(half) * 0.6, F.lit(0.0), F.sin(half) * 0.8)
    return b.select("frame", "box", F.array("bx", "by", "bz").alias("centre"), G.quaternion_matrix(q).alias("rot"), F.array(F.col("sx") / 2, F.col("sy") / 2, F.col("sz") / 2).alias("half"))


TURNED = f"""{BOXES}, h AS (SELECT *, cos(yaw / 2) AS qw, sin(yaw / 2) * 0.6 AS qx, CAST(0.0 AS DOUBLE) AS qy, sin(yaw / 2) * 0.8 AS qz FROM x),
t AS (SELECT *, 1 - 2 * (qy * qy + qz * qz) AS m00, 2 * (qx * qy - qw * qz) AS m01, 2 * (qx * qz + qw * qy) AS m02, 2 * (qx * qy + qw * qz) AS m10, 1 - 2 * (qx * qx + qz * qz) AS m11,
  2 * (qy * qz - qw * qx) AS m12, 2 * (qx * qz - qw * qy) AS m20, 2 * (qy * qz + qw * qx) AS m21, 1 - 2 * (qx * qx + qy * qy) AS m22 FROM h)"""
_INSIDE = " AND ".join(f"abs((p.x - bx) * m0{j} + (p.y - b_y) * m1{j} + (p.z - bz) * m2{j}) <= s{'xyz'[j]} / 2 + CAST(0.05 AS DOUBLE)" for j in range(3))
CORNERS = f"""{TURNED}, k AS (SELECT t.*, CAST(c.range AS INTEGER) AS corner, sx / 2 * (2 * (c.range & 1) - 1) AS a, sy / 2 * (2 * ((c.range >> 1) & 1) - 1) AS b, sz / 2 * (2 * ((c.range >> 2) & 1) - 1) AS d FROM t, range(8) c),
v AS (SELECT box, corner, m00 * a + m01 * b + m02 * d + bx AS x, m10 * a + m11 * b + m12 * d + b_y AS y, m20 * a + m21 * b + m22 * d + bz AS z FROM k)"""


@query(f"WITH {POINTS}, {TURNED}, i AS (SELECT t.box, count(*) AS n FROM p JOIN t ON p.frame = t.frame WHERE {_INSIDE} GROUP BY t.box) SELECT t.box, coalesce(n, 0) AS num_lidar_pts FROM t LEFT JOIN i USING (box)")
def q_points_in_oriented_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the range join over cells that the detection line uses."""
    b = turned_boxes(spark, sf_dir).withColumn("coeffs", F.transform("half", lambda h: h * 2)).withColumnRenamed("centre", "translation")
    n = detection.oriented_pairs(points(spark, sf_dir).select("frame", "x", "y", "z"), b, 0.05).groupBy("box").agg(F.count(F.lit(1)).alias("n"))
    return b.select("box").join(n, "box", "left").select("box", F.coalesce("n", F.lit(0)).cast("long").alias("num_lidar_pts"))


@query(f"WITH {CORNERS} SELECT box, corner, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM v")
def q_box_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = turned_boxes(spark, sf_dir).select("box", F.posexplode(G.box_corners(F.col("centre"), F.col("rot"), F.col("half"))).alias("corner", "p"))
    return b.select("box", "corner", *[F.round(F.col("p")[i], 6).alias(c) for i, c in enumerate("xyz")])


@query(
    f"""WITH {CORNERS}, f AS (SELECT box, min(x + 5) AS near, greatest(min(200.0 * -y / (x + 5) + 160.0), 0.0) AS x1, greatest(min(200.0 * -z / (x + 5) + 120.0), 0.0) AS y1,
  least(max(200.0 * -y / (x + 5) + 160.0), 320.0) AS x2, least(max(200.0 * -z / (x + 5) + 120.0), 240.0) AS y2 FROM v GROUP BY box),
i AS (SELECT *, greatest(0.0, least(x2, 220.0) - greatest(x1, 100.0)) * greatest(0.0, least(y2, 150.0) - greatest(y1, 50.0)) AS i FROM f)
SELECT box, CASE WHEN near > 0.05 AND box % 5 <> 0 AND (x2 - x1) * (y2 - y1) + 12000.0 - i > 0 THEN round(i / ((x2 - x1) * (y2 - y1) + 12000.0 - i), 6) END AS iou FROM i"""
)
def q_oriented_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("centre")
    box = F.when(F.col("box") % 5 != 0, F.array(*[F.lit(v) for v in (100.0, 50.0, 120.0, 100.0)]))
    iou = G.oriented_overlap(F.array(c[0] + 5, c[1], c[2]), F.col("rot"), F.col("half"), F.lit(200.0), F.lit(200.0), F.lit(160.0), F.lit(120.0), box, F.lit(320.0), F.lit(240.0))
    return turned_boxes(spark, sf_dir).select("box", F.round(iou, 6).alias("iou"))


_SIGN = "CASE WHEN m00 + m11 + m22 > 0 THEN qw WHEN m00 >= m11 AND m00 >= m22 THEN qx WHEN m11 >= m22 THEN qy ELSE qz END"


@query(f"WITH {TURNED} SELECT box, " + ", ".join(f"round({q} * CASE WHEN {_SIGN} < 0 THEN -1.0 ELSE 1.0 END + 0.0, 6) AS {q}" for q in ("qw", "qx", "qy", "qz")) + " FROM t")
def q_quaternion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rotation's quaternion is the one that it was made of, with the leading part positive."""
    q = G.matrix_quaternion(F.col("rot"))
    return turned_boxes(spark, sf_dir).select("box", *[(F.round(q[i], 6) + F.lit(0.0)).alias(n) for i, n in enumerate(("qw", "qx", "qy", "qz"))])


@query(f"WITH {TURNED} SELECT box, " + ", ".join(f"CASE WHEN box % 9 = 0 THEN {float(i == j)} ELSE round(m{i}{j}, 6) + 0.0 END AS m{i}{j}" for i in range(3) for j in range(3)) + " FROM t")
def q_proper_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bases that are stretched along their axes, mirrored in the first one or not finite give their rotation, or none."""
    from depthloom.functions.rotations import proper_rotation

    bad, flip = F.col("box") % 9 == 0, F.when(F.col("box") % 2 == 0, -1.5).otherwise(0.7)
    stretched = F.transform("rot", lambda r: F.array(F.when(bad, F.lit(float("nan"))).otherwise(r[0] * flip), r[1] * 1.25, r[2] * 0.5))
    out = turned_boxes(spark, sf_dir).select("box", proper_rotation(stretched).alias("r"))
    return out.select("box", *[(F.round(F.col("r")[i][j], 6) + F.lit(0.0)).alias(f"m{i}{j}") for i in range(3) for j in range(3)])


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_captured, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp FROM orders")
def q_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_captured"), F.date_format("o_orderdate", "yyyyMMdd_HHmmss").alias("stamp"))


@query(
    f"""WITH {FRAMES}, old AS (SELECT scene, token, o_totalprice AS price, 0 AS late, row_number() OVER (PARTITION BY scene ORDER BY o_orderdate, token) AS place FROM f WHERE o_orderkey % 3 <> 0),
added AS (SELECT scene, token, o_totalprice * 2 AS price, row_number() OVER (PARTITION BY scene ORDER BY o_orderdate, token) AS place FROM f WHERE o_orderkey % 2 = 0),
x AS (SELECT * FROM old WHERE token NOT IN (SELECT token FROM added)
  UNION ALL SELECT a.scene, a.token, a.price, coalesce(o.late, 1), coalesce(o.place, a.place) FROM added a LEFT JOIN old o USING (scene, token))
SELECT scene, token, price, coalesce(lag(token) OVER w, 'EOF') AS prev, coalesce(lead(token) OVER w, 'EOF') AS next FROM x WINDOW w AS (PARTITION BY scene ORDER BY late, place)"""
)
def q_extended_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the frames are known, every other frame comes (again): known ones keep their place, new ones go to the tail."""
    f = frames(spark, sf_dir).select("scene", "token", "o_orderdate", "o_orderkey", F.col("o_totalprice").alias("price"))
    added = f.where("o_orderkey % 2 = 0").withColumn("price", F.col("price") * 2)
    return chain.extended(f.where("o_orderkey % 3 <> 0"), added, "scene", ["o_orderdate", "token"]).select("scene", "token", "price", "prev", "next")


@query(
    f"""WITH {FRAMES} SELECT o_orderstatus AS scene, token, coalesce(lag(token) OVER w, 'EOF') AS prev, coalesce(lead(token) OVER w, 'EOF') AS next, count(*) OVER (PARTITION BY o_orderstatus) AS nbr_samples
FROM f WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, token)"""
)
def q_sliced_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three scenes that hold everything, ordered a month at a time."""
    f = frames(spark, sf_dir).withColumns({"scene": F.col("o_orderstatus"), "month": F.date_format("o_orderdate", "yyyy-MM")})
    return chain.linked_by_slices(f, ["scene"], "month", ["o_orderdate", "token"]).select("scene", "token", "prev", "next", "nbr_samples")


@query(f"""WITH {FRAMES}, n AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS place FROM f) SELECT token, place FROM n WHERE place % 25 = 0""")
def q_sampled_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 25th manifest entry in order of keys, as the quality report takes them."""
    placed = chain.placed(frames(spark, sf_dir).select("token"), ["token"], "place")
    return quality.sampled(placed, 25, "place").select("token", "place")


@query(f"""WITH {FRAMES} SELECT scene, token FROM f WHERE token IN (SELECT md5('sample:' || doc_id) FROM documents WHERE n_chars < 2000)""")
def q_warned_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that the report's warnings name: short documents warn of the frame of their number."""
    said = read(spark, sf_dir, "documents").where("n_chars < 2000").select(F.concat(F.lit("low_count "), G.token("sample", F.col("doc_id")), F.lit(": "), F.col("n_chars").cast("string")).alias("message"))
    return quality.warned_frames(said, frames(spark, sf_dir).select("scene", "token"))


_HUE = "(SELECT *, t - floor(t) AS hue FROM (SELECT DISTINCT p_brand AS name, CAST(('0x' || substr(md5(p_brand), 1, 8))::BIGINT AS DOUBLE) * CAST(0.61803398875 AS DOUBLE) AS t FROM part))"


@query(
    f"""WITH k AS (SELECT name, hue * 6 + 5.0 - floor((hue * 6 + 5.0) / 6) * 6 AS kr, hue * 6 + 3.0 - floor((hue * 6 + 3.0) / 6) * 6 AS kg, hue * 6 + 1.0 - floor((hue * 6 + 1.0) / 6) * 6 AS kb FROM {_HUE})
SELECT name, """
    + ", ".join(f"CASE WHEN name = 'Brand#11' THEN {n} ELSE CAST(floor((1 - CAST(0.75 AS DOUBLE) * greatest(0.0, least(k{c}, 4 - k{c}, 1.0))) * 255) AS INTEGER) END AS {c}" for c, n in (("r", 1), ("g", 2), ("b", 3)))
    + " FROM k"
)
def q_hashed_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours of names outside the palette; one brand stands for a name inside."""
    named = read(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct()
    colour = G.hashed_colour(F.col("name"), {"Brand#11": (1, 2, 3)})
    return named.select("name", *[colour[i].alias(c) for i, c in enumerate("rgb")])


@query("SELECT split, i, name FROM (SELECT lang AS split, doc_id AS i, 'img-' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS name, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 7")
def q_limit_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from depthloom.functions import names
    from depthloom.plans import frames as prepare

    rows = read(spark, sf_dir, "documents").select(F.col("lang").alias("split"), F.col("doc_id").alias("i"), names.frame_name(F.col("doc_id")).alias("name"))
    return prepare.limited(rows, 7, "split").select("split", "i", "name")


@query(
    """WITH b AS (SELECT s_suppkey AS s, j, (j + s_suppkey) % 5 <> 0 AS fine, (j + s_suppkey) % 3 <> 0 AS two FROM supplier, range(4) r(j) WHERE j < s_nationkey % 4)
SELECT (SELECT count(*) FROM supplier) AS frames, count_if(NOT fine) AS dropped, count_if(fine) AS kept, count_if(fine AND NOT two) AS no2d FROM b"""
)
def q_parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the boxes of metadata rows: a fifth lacks a coordinate, a third has an empty 2-D box; some frames have none."""
    from depthloom.plans import frames as prepare

    s = F.col("s_suppkey")
    row = lambda *v: F.array(*[F.lit(x) for x in v])
    three = F.array(row(1.0, 0.0, 0.0), row(0.0, 1.0, 0.0), row(0.0, 0.0, 1.0))
    j = lambda x: (x + s) % 5 != 0
    box = lambda x: F.struct(F.lit("bed").alias("cls"), F.when(j(x), row(0.0, 1.0, 2.0)).otherwise(row(0.0, 1.0)).alias("centroid"), row(1.0, 1.0, 1.0).alias("coeffs"), three.alias("basis"), F.when((x + s) % 3 != 0, row(1.0, 2.0, 3.0, 4.0)).otherwise(row(1.0, 2.0, 0.0, 4.0)).alias("bb2d"))
    held = F.filter(F.array(*[F.lit(i) for i in range(4)]), lambda x: x < F.col("s_nationkey") % 4)
    meta = read(spark, sf_dir, "supplier").select(s.alias("i"), three.alias("Rtilt"), F.transform(held, box).alias("boxes"))
    wanted = read(spark, sf_dir, "supplier").select(s.alias("meta_row"), F.lit("train").alias("split"), s.cast("string").alias("name"))
    return prepare.boxes(wanted, meta)[1]


@query(
    f"""WITH {TURNED} SELECT box, """
    + ", ".join(f"round({e}, 6) + 0.0 AS {n}" for n, e in (("x", "m01 * bx + m11 * b_y + m21 * bz"), ("y", "-(m00 * bx + m10 * b_y + m20 * bz)"), ("z", "m02 * bx + m12 * b_y + m22 * bz")))
    + " FROM t"
)
def q_gravity_to_ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = G.gravity_to_ego(F.col("rot"), F.col("centre"))
    return turned_boxes(spark, sf_dir).select("box", *[(F.round(v[i], 6) + F.lit(0.0)).alias(c) for i, c in enumerate("xyz")])


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
