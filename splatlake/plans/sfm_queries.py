"""Structure-from-motion queries over the camera and cloud fixtures, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..operators import neighbors as N, sfm as M, splats as S
from . import fixtures as X
from .fixtures import oracle
from .registry import query

PARAMS = """cam AS (SELECT *, CASE WHEN model_id IN (0, 2, 3) THEN [f0, cx, cy, 0.01e0] ELSE [f0, f1, cx, cy, 0.01e0] END AS params FROM cameras_fx)"""
SHARED = "model_id IN (0, 2, 3)"


def cameras(spark, d):
    rows = X.cameras_fx(spark, d)
    k = F.lit(0.01)
    shared = F.col("model_id").isin(0, 2, 3)
    return rows.withColumn("params", F.when(shared, F.array("f0", "cx", "cy", k)).otherwise(F.array(F.col("f0"), F.col("f1"), F.col("cx"), F.col("cy"), k))).drop("f0", "f1", "cx", "cy")


@query("intrinsics", oracle(f"SELECT camera_id, round(f0, 6) AS fx, round(CASE WHEN {SHARED} THEN f0 ELSE f1 END, 6) AS fy, round(cx, 6) AS cx, round(cy, 6) AS cy FROM cameras_fx", views="cameras_fx"))
def _(spark, d):
    return M.intrinsics(cameras(spark, d)).select("camera_id", *[r6(c).alias(c) for c in ("fx", "fy", "cx", "cy")])


POSE = """img AS (SELECT scene_id, point_id AS image_id, rot_0/n AS qw, rot_1/n AS qx, rot_2/n AS qy, rot_3/n AS qz, x AS tx, y AS ty, z AS tz FROM
  (SELECT *, sqrt(rot_0*rot_0+rot_1*rot_1+rot_2*rot_2+rot_3*rot_3) AS n FROM splats_emb) t)"""
ROT = """rot AS (SELECT *, 1-2*qy*qy-2*qz*qz AS r00, 2*qx*qy-2*qw*qz AS r01, 2*qz*qx+2*qw*qy AS r02, 2*qx*qy+2*qw*qz AS r10, 1-2*qx*qx-2*qz*qz AS r11, 2*qy*qz-2*qw*qx AS r12,
  2*qz*qx-2*qw*qy AS r20, 2*qy*qz+2*qw*qx AS r21, 1-2*qx*qx-2*qy*qy AS r22 FROM img)"""


def images(spark, d):
    rows = S.normalize_quat(X.splats_emb(spark, d))
    return rows.select("scene_id", F.col("point_id").alias("image_id"), *[F.col(f"rot_{i}").alias(q) for i, q in enumerate(("qw", "qx", "qy", "qz"))],
                       *[F.col(a).alias(f"t{a}") for a in "xyz"])


@query("quat_to_rotmat", oracle("SELECT scene_id, image_id, " + ", ".join(f"round(r{i}{j}, 6) + 0.0 AS r{i}{j}" for i in range(3) for j in range(3)) + " FROM rot", POSE, ROT, views="splats_emb"))
def _(spark, d):
    return M.quat_to_rotmat(images(spark, d)).select("scene_id", "image_id", *[r6(f"r{i}{j}").alias(f"r{i}{j}") for i in range(3) for j in range(3)])


@query("camera_to_world", oracle("SELECT scene_id, image_id, " + ", ".join(f"round(-(r0{i}*tx+r1{i}*ty+r2{i}*tz), 6) + 0.0 AS center_{a}" for i, a in enumerate("xyz"))
    + ", round(r10, 6) + 0.0 AS m01, round(r02, 6) + 0.0 AS m20 FROM rot", POSE, ROT, views="splats_emb"))
def _(spark, d):
    rows = M.camera_to_world(images(spark, d))
    m = lambda i, j: F.col("camtoworld")[i][j]
    return rows.select("scene_id", "image_id", *[r6(f"center_{a}").alias(f"center_{a}") for a in "xyz"], r6(m(0, 1)).alias("m01"), r6(m(2, 0)).alias("m20"))


DIMS = """dim AS (SELECT model_id AS scene_id, camera_id, width, height FROM cameras_fx),
org AS (SELECT scene_id, arg_min(width, camera_id) AS width, arg_min(height, camera_id) AS height FROM dim GROUP BY scene_id),
eff AS (SELECT *, new_width/greatest(width, 1)::DOUBLE AS scale_w, new_height/greatest(height, 1)::DOUBLE AS scale_h FROM (SELECT *, CASE WHEN scene_id = 0 THEN width ELSE width*2 END AS new_width,
  CASE WHEN scene_id = 0 THEN height WHEN scene_id = 3 THEN height*3 ELSE height*2 END AS new_height FROM org) t)"""


def scales(spark, d):
    cams = X.cameras_fx(spark, d).select(F.col("model_id").alias("scene_id"), "camera_id", "width", "height")
    first = cams.groupBy("scene_id").agg(F.min_by("width", "camera_id").alias("w"), F.min_by("height", "camera_id").alias("h"))
    k = F.col("scene_id")
    dims = first.select("scene_id", F.when(k == 0, F.col("w")).otherwise(F.col("w") * 2).alias("new_width"),
                        F.when(k == 0, F.col("h")).when(k == 3, F.col("h") * 3).otherwise(F.col("h") * 2).alias("new_height"))
    return M.effective_scale(cams, dims)


@query("effective_scale", oracle("""SELECT scene_id, round(scale_w, 6) AS scale_w, round(scale_h, 6) AS scale_h, abs(width/height::DOUBLE - new_width/new_height::DOUBLE) > 0.05 AS aspect_mismatch,
    abs(scale_w-1) < 0.01 AND abs(scale_h-1) < 0.01 AS is_identity FROM eff""", DIMS, views="cameras_fx"))
def _(spark, d):
    return scales(spark, d).select("scene_id", r6("scale_w").alias("scale_w"), r6("scale_h").alias("scale_h"), "aspect_mismatch", "is_identity")


@query("scale_intrinsics", oracle("""SELECT camera_id, list_transform(p, lambda v: round(v, 6)) AS params, CAST(round_even(width*1.37e0, 0) AS BIGINT) AS width, CAST(round_even(height*1.5e0, 0) AS BIGINT) AS height FROM
    (SELECT *, CASE WHEN model_id IN (0, 2, 3) THEN [params[1]*sqrt(1.37e0*1.5e0), params[2]*1.37e0, params[3]*1.5e0, params[4]] ELSE [params[1]*1.37e0, params[2]*1.5e0, params[3]*1.37e0, params[4]*1.5e0, params[5]] END AS p FROM cam) t""",
    PARAMS, views="cameras_fx"))
def _(spark, d):
    rows = cameras(spark, d)
    factors = rows.select("model_id").distinct().withColumns({"scale_w": F.lit(1.37), "scale_h": F.lit(1.5)})
    return M.scale_intrinsics(rows, factors, ["model_id"]).select("camera_id", F.transform("params", lambda v: F.round(v, 6)).alias("params"), "width", "height")


@query("validate_intrinsics", oracle("""SELECT camera_id, list_filter([CASE WHEN NOT cx BETWEEN 0.3e0*width AND 0.7e0*width THEN 'cx_off_center' END, CASE WHEN NOT cy BETWEEN 0.3e0*height AND 0.7e0*height THEN 'cy_off_center' END,
    CASE WHEN NOT degrees(2*atan(width/(2*f0))) BETWEEN 8 AND 160 THEN 'fov_x_out_of_range' END, CASE WHEN NOT degrees(2*atan(height/(2*f1))) BETWEEN 8 AND 160 THEN 'fov_y_out_of_range' END,
    CASE WHEN greatest(f0, f1)/greatest(least(f0, f1), 1e-6) >= 2 THEN 'focal_ratio' END, CASE WHEN camera_id % 17 = 0 THEN 'width_mismatch' END], lambda v: v IS NOT NULL) AS violations FROM cameras_fx""", views="cameras_fx"))
def _(spark, d):
    rows = X.cameras_fx(spark, d).withColumnsRenamed({"f0": "fx", "f1": "fy"})
    rows = rows.withColumn("image_width", F.col("width") + F.when(F.col("camera_id") % 17 == 0, 1).otherwise(0))
    return M.validate_intrinsics(rows).select("camera_id", "violations")


NAMED = """nam AS (SELECT user_id AS scene_id, event_id AS image_id, 'shot.' || event_id || '.jpg' AS name FROM events),
fil AS (SELECT scene_id, name FROM nam WHERE image_id % 5 = 0 UNION ALL SELECT scene_id, 'shot.' || image_id || '.jpeg' FROM nam WHERE image_id % 3 = 0
  UNION ALL SELECT scene_id, 'shot.' || image_id || '.png' FROM nam WHERE image_id % 6 = 0 UNION ALL SELECT scene_id, 'shot.' || image_id || '.bmp' FROM nam WHERE image_id % 7 = 0),
rsv AS (SELECT *, CASE WHEN image_id % 5 = 0 THEN name WHEN image_id % 6 = 0 THEN 'shot.' || image_id || '.png' WHEN image_id % 3 = 0 THEN 'shot.' || image_id || '.jpeg' END AS resolved_name FROM nam)"""


def named(spark, d):
    rows = X.table(spark, d, "events").select(F.col("user_id").alias("scene_id"), F.col("event_id").alias("image_id"))
    k = F.col("image_id")
    path = lambda ending: F.concat(F.lit("shot."), "image_id", F.lit(f".{ending}"))
    files = None
    for n, ending in ((5, "jpg"), (3, "jpeg"), (6, "png"), (7, "bmp")):
        some = rows.filter(k % n == 0).select("scene_id", path(ending).alias("name"))
        files = some if files is None else files.unionByName(some)
    return rows.withColumn("name", path("jpg")), files


@query("resolve_image_names", oracle("SELECT scene_id, image_id, name, resolved_name FROM rsv", NAMED))
def _(spark, d):
    return M.resolve_image_names(*named(spark, d)).select("scene_id", "image_id", "name", "resolved_name")


@query("build_views", oracle(f"""SELECT rsv.scene_id, rsv.image_id, resolved_name AS image_name, round(f0, 6) AS fx, round(CASE WHEN {SHARED} THEN f0 ELSE f1 END, 6) AS fy, round(c.cx, 6) AS cx, round(c.cy, 6) AS cy,
    c.width, c.height, round(-(r00*tx+r10*ty+r20*tz), 6) + 0.0 AS center_x FROM rsv JOIN rot ON rot.image_id = rsv.image_id % (SELECT count(*) FROM rot) JOIN cameras_fx c ON c.camera_id = 1 + rsv.image_id % (SELECT count(*) FROM cameras_fx) WHERE resolved_name IS NOT NULL""",
    NAMED, POSE, ROT, views=["splats_emb", "cameras_fx"]))
def _(spark, d):
    rows, files = named(spark, d)
    poses, lenses = images(spark, d).drop("scene_id").withColumnRenamed("image_id", "pose_id"), cameras(spark, d)
    rows = rows.withColumns({"pose_id": F.col("image_id") % poses.count(), "camera_id": 1 + F.col("image_id") % lenses.count()}).join(poses, "pose_id")  # all poses, all cameras
    cams = rows.select("scene_id", "camera_id").distinct().join(lenses, "camera_id")
    v = M.build_views(rows, cams, files)
    k = lambda i, j: r6(F.col("k")[i][j])
    return v.select("scene_id", "image_id", "image_name", k(0, 0).alias("fx"), k(1, 1).alias("fy"), k(0, 2).alias("cx"), k(1, 2).alias("cy"), "width", "height",
                    r6(F.col("camtoworld")[0][3]).alias("center_x"))


@query("crop_views", oracle("SELECT camera_id, round(cx - 10 - model_id, 6) AS cx, round(cy - 20, 6) AS cy, 190 - model_id AS width, 130 AS height FROM cameras_fx", views="cameras_fx"))
def _(spark, d):
    rows = X.cameras_fx(spark, d)
    windows = rows.select("model_id").distinct().select("model_id", (10 + F.col("model_id")).alias("left"), F.lit(20).alias("top"), F.lit(200).alias("right"), F.lit(150).alias("bottom"))
    return M.crop_views(rows, windows, ["model_id"]).select("camera_id", r6("cx").alias("cx"), r6("cy").alias("cy"), "width", "height")


@query("staleness", oracle("""SELECT user_id AS scene_id, count_if(event_id % 101 = 0) AS added, count_if(event_id % 97 = 0 AND event_id % 101 <> 0) AS removed,
    count_if(event_id % 89 = 0 AND event_id % 97 <> 0 AND event_id % 101 <> 0) AS changed, count_if(event_id % 101 = 0 OR event_id % 97 = 0 OR event_id % 89 = 0) > 0 AS stale FROM events GROUP BY user_id"""))
def _(spark, d):
    k = F.col("event_id")
    files = X.table(spark, d, "events").select(F.col("user_id").alias("scene_id"), F.concat(F.lit("f"), "event_id").alias("path"), "event_id", (k * 3).alias("size"), (k * 7).alias("mtime_ns"),
                                               F.when(k % 4 != 0, 640).alias("width"), F.lit(480).alias("height"))
    now = files.filter((k % 97 != 0) | (k % 101 == 0)).withColumn("size", F.col("size") + F.when(k % 89 == 0, 1).otherwise(0))
    return M.staleness(files.filter(k % 101 != 0), now)


REG = """reg AS (SELECT *, registered_images / greatest(1, image_count)::DOUBLE AS ratio, least(24, greatest(1, image_count)) AS need FROM (SELECT user_id AS scene_id, count(*) AS image_count,
  count_if(event_type = 'click' OR event_id % 3 = 0) AS registered_images, count_if(event_id % 2 = 0) AS points3d FROM events GROUP BY user_id) t)"""


@query("registration_stats", oracle("""SELECT scene_id, image_count, registered_images, points3d, CAST(printf('%.4f', ratio) AS DOUBLE) AS registered_ratio, CAST(need AS INT) AS min_registered_images,
    registered_images >= need AS meets_min_registered_images, ratio >= 0.45e0 AS meets_min_registered_ratio, registered_images >= need AND ratio >= 0.45e0 AS meets_quality_target FROM reg""", REG))
def _(spark, d):
    rows = X.table(spark, d, "events").select(F.col("user_id").alias("scene_id"), "event_id", "event_type")
    counts = rows.groupBy("scene_id").agg(F.count("*").alias("image_count"))
    return M.registration_stats(counts, rows.filter("event_type = 'click' OR event_id % 3 = 0"), rows.filter("event_id % 2 = 0"))


@query("attempt_sequence", oracle("""SELECT camera_id, CASE WHEN len(s) > 0 THEN s ELSE ['SIMPLE_PINHOLE'] END AS sequence FROM (SELECT camera_id, list_transform(list_sort(list_transform(list_distinct(l), lambda m: {'p': list_position(l, m), 'm': m})), lambda q: q.m) AS s FROM
    (SELECT camera_id, list_filter([a, upper(trim(' Opencv ')), CASE WHEN camera_id % 2 = 0 THEN 'SIMPLE_RADIAL' ELSE '' END, a, 'PINHOLE'][1:1+(camera_id%5)], lambda v: v <> '') AS l FROM (SELECT camera_id, CASE model_id WHEN 0 THEN '' WHEN 1 THEN 'PINHOLE' ELSE 'SIMPLE_RADIAL' END AS a FROM cameras_fx) t) u) w""", views="cameras_fx"))
def _(spark, d):
    model = F.when(F.col("model_id") == 0, " ").when(F.col("model_id") == 1, "pinhole").otherwise("Simple_Radial ")
    more = F.array(F.lit(" Opencv "), F.when(F.col("camera_id") % 2 == 0, "simple_radial").otherwise(""), model, F.lit("PINHOLE"))
    rows = X.cameras_fx(spark, d).select("camera_id", model.alias("camera_model"), F.slice(more, F.lit(1), (F.col("camera_id") % 5).cast("int")).alias("candidates"))
    return M.attempt_sequence(rows).select("camera_id", "sequence")


ATT = """att AS (SELECT o_custkey AS scene_id, o_orderkey AS attempt_no, 'M' || o_orderkey % 4 AS camera_model, o_orderkey % 5 <> 0 AS ok, 40 AS image_count, CAST(floor(o_totalprice) AS BIGINT) % 30 AS registered_images,
  CAST(floor(o_totalprice / 11) AS BIGINT) % 900 AS points3d FROM orders),
atr AS (SELECT *, CAST(printf('%.4f', registered_images / 40.0e0) AS DOUBLE) AS ratio, ok AND registered_images >= 24 AND registered_images / 40.0e0 >= 0.45e0 AS meets FROM att),
atc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY meets DESC, CASE WHEN meets THEN attempt_no END, ok DESC, ratio DESC, registered_images DESC, points3d DESC, attempt_no) AS i FROM atr) t WHERE i = 1)"""


def attempts(spark, d):
    price = F.col("o_totalprice")
    return X.table(spark, d, "orders").select(
        F.col("o_custkey").alias("scene_id"), F.col("o_orderkey").alias("attempt_no"), F.concat(F.lit("M"), F.col("o_orderkey") % 4).alias("camera_model"), (F.col("o_orderkey") % 5 != 0).alias("ok"),
        F.lit(40).alias("image_count"), (F.floor(price) % 30).alias("registered_images"), (F.floor(price / 11) % 900).alias("points3d"))


@query("attempt_ladder", oracle("""SELECT scene_id, ok, CASE WHEN ok THEN camera_model ELSE '' END AS selected_camera_model, CASE WHEN ok THEN registered_images ELSE 0 END AS registered_images,
    CASE WHEN ok THEN ratio ELSE 0 END AS registered_ratio, CASE WHEN ok THEN points3d ELSE 0 END AS points3d, ok AND meets AS meets_quality_target, CASE WHEN ok THEN attempt_no END AS attempt_no FROM atc""", ATT))
def _(spark, d):
    return M.attempt_ladder(attempts(spark, d))


@query("largest_reconstruction", oracle("SELECT scene_id, attempt_no AS model_no, registered_images, points3d FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY registered_images DESC, attempt_no) AS i FROM att) t WHERE i = 1", ATT))
def _(spark, d):
    return M.largest_reconstruction(attempts(spark, d).withColumnRenamed("attempt_no", "model_no"))


KNN = """nn AS (SELECT scene_id, point_id, d FROM (SELECT a.scene_id, a.point_id, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) AS d,
    row_number() OVER (PARTITION BY a.scene_id, a.point_id ORDER BY (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) AS i
    FROM splats_emb a JOIN splats_emb b ON a.scene_id = b.scene_id AND a.point_id <> b.point_id) t WHERE i <= 3),
nm AS (SELECT scene_id, point_id, avg(d) AS m FROM nn GROUP BY scene_id, point_id)"""


def scene_radius(spark, d):
    points = X.splats_emb(spark, d)
    return S.scene_extent(points.select("scene_id", "x", "y", "z"))


@query("init_scale_knn", oracle("""SELECT nm.scene_id, point_id, round(m, 6) AS mean_dist, round(ln(greatest(r*0.0001e0, least(r*0.1e0, m))), 6) + 0.0 AS init_log_scale FROM nm JOIN rd USING (scene_id)""", KNN,
    "ctr AS (SELECT scene_id, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM splats_emb GROUP BY scene_id)",
    "rd AS (SELECT v.scene_id, greatest(max(sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz))), 0.01e0) AS r FROM splats_emb v JOIN ctr USING (scene_id) GROUP BY v.scene_id)", views="splats_emb"))
def _(spark, d):
    rows = N.init_scale_knn(X.splats_emb(spark, d), scene_radius(spark, d), leaf=16, fanout=4)
    return rows.select("scene_id", "point_id", r6("mean_dist").alias("mean_dist"), r6("init_log_scale").alias("init_log_scale"))


@query("init_scale_knn_volume")
def _(spark, d):
    """Large cloud; rows only, the pairwise twin is too slow there."""
    points = X.splats_li(spark, d).select("scene_id", "point_id", "x", "y", "z")
    rows = N.init_scale_knn(points, S.scene_extent(points.select("scene_id", "x", "y", "z")))
    return rows.select("scene_id", "point_id", r6("mean_dist").alias("mean_dist"), r6("init_log_scale").alias("init_log_scale"))
