"""Splat-cloud and diagnostics queries over the fixture clouds, with DuckDB twins."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.order_stats import kth_smallest, lower_median
from ..functions.scalars import r6, round_half_even
from ..operators import diagnostics as D, encodings as E, splats as S
from . import fixtures as X
from .fixtures import oracle
from .registry import query

# DuckDB steps shared by the oracles.
ENC = """flat AS (SELECT scene_id, unnest([scale_raw_0, scale_raw_1, scale_raw_2]) AS s FROM {v}),
enc AS (SELECT o.scene_id, o.opacity_is_logit, f.scale_median, f.scale_median < -0.25 AS scale_is_log
  FROM (SELECT scene_id, (min(opacity_raw) < 0 OR max(opacity_raw) > 1) AS opacity_is_logit FROM {v} GROUP BY scene_id) o
  JOIN (SELECT scene_id, quantile_cont(s, 0.5) AS scale_median FROM flat GROUP BY scene_id) f USING (scene_id))"""
DEC = """dec AS (SELECT v.*, CASE WHEN opacity_is_logit THEN 1/(1+exp(-greatest(-60e0, least(60e0, opacity_raw)))) ELSE opacity_raw END AS opacity,
  CASE WHEN scale_is_log THEN exp(greatest(-20e0, least(20e0, scale_raw_0))) ELSE scale_raw_0 END AS sx,
  CASE WHEN scale_is_log THEN exp(greatest(-20e0, least(20e0, scale_raw_1))) ELSE scale_raw_1 END AS sy,
  CASE WHEN scale_is_log THEN exp(greatest(-20e0, least(20e0, scale_raw_2))) ELSE scale_raw_2 END AS sz
  FROM {v} v JOIN enc USING (scene_id))"""
MED = """med AS (SELECT scene_id, quantile_cont(x, 0.5) AS cx, quantile_cont(y, 0.5) AS cy, quantile_cont(z, 0.5) AS cz FROM {v} GROUP BY scene_id)"""


def steps(view, *names):
    text = {"enc": ENC, "dec": DEC, "med": MED}
    return [text[n].format(v=view) for n in names]


emb, li = X.splats_emb, X.splats_li
KEY = ["scene_id", "point_id"]


# ---- encodings -------------------------------------------------------------

@query("splat_encoding", oracle(
    "SELECT scene_id, opacity_is_logit, scale_is_log, round(scale_median, 6) + 0.0 AS scale_median FROM enc",
    *steps("splats_li", "enc"), views="splats_li"))
def _(spark, d):
    return E.splat_encoding(li(spark, d)).withColumn("scale_median", r6("scale_median"))


@query("decode_opacity", oracle("SELECT scene_id, point_id, round(opacity, 6) + 0.0 AS opacity FROM dec",
                                *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    return E.decode(emb(spark, d)).select(*KEY, r6("opacity").alias("opacity"))


@query("decode_scale", oracle(
    "SELECT scene_id, point_id, round(sx, 6) AS sx, round(sy, 6) AS sy, round(sz, 6) AS sz FROM dec",
    *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    return E.decode(emb(spark, d)).select(*KEY, *[r6(c).alias(c) for c in ("sx", "sy", "sz")])


@query("scale_kind", oracle(
    "SELECT scene_id, CASE WHEN scale_is_log THEN 'log' ELSE 'actual' END AS scale_kind FROM enc",
    *steps("splats_emb", "enc"), views="splats_emb"))
def _(spark, d):
    return E.scale_kind(emb(spark, d))


@query("max_axis_scale", oracle(
    "SELECT scene_id, point_id, round(greatest(sx, sy, sz), 6) AS max_scale FROM dec",
    *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    return S.with_max_scale(E.decode(emb(spark, d))).select(*KEY, r6("max_scale").alias("max_scale"))


# ---- derived columns -------------------------------------------------------

@query("dist_to_center", oracle(
    """SELECT v.scene_id, point_id, round(sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)), 6) AS dist,
       round(sqrt((x-0.1e0)*(x-0.1e0)+(y-0.2e0)*(y-0.2e0)+(z+0.1e0)*(z+0.1e0)), 6) AS seed_dist
       FROM splats_emb v JOIN med USING (scene_id)""", *steps("splats_emb", "med"), views="splats_emb"))
def _(spark, d):
    from_center = S.dist_to_center(emb(spark, d)).withColumnRenamed("dist", "center_dist")
    rows = S.dist_to_seed(from_center, (0.1, 0.2, -0.1))
    return rows.select(*KEY, r6("center_dist").alias("dist"), r6("dist").alias("seed_dist"))


@query("normalize_quat", oracle(
    """SELECT scene_id, point_id, """ + ", ".join(
        f"round(rot_{i}/sqrt(rot_0*rot_0+rot_1*rot_1+rot_2*rot_2+rot_3*rot_3), 6) + 0.0 AS rot_{i}" for i in range(4))
    + " FROM splats_emb", views="splats_emb"))
def _(spark, d):
    return S.normalize_quat(emb(spark, d)).select(*KEY, *[r6(c).alias(c) for c in S.QUAT])


@query("sh_to_rgb", oracle("SELECT scene_id, point_id, " + ", ".join(
    f"round(greatest(0e0, least(1e0, 0.5e0+0.28209479177387814e0*f_dc_{i})), 6) + 0.0 AS {n}" for i, n in enumerate("rgb"))
    + " FROM splats_emb", views="splats_emb"))
def _(spark, d):
    return S.sh_to_rgb(emb(spark, d)).select(*KEY, *[r6(c).alias(c) for c in "rgb"])


@query("quat_to_u8", oracle("SELECT scene_id, point_id, " + ", ".join(
    f"CAST(floor((greatest(-1e0, least(1e0, rot_{i})) + 1) / 2 * 255) AS SMALLINT) AS rot_u8_{i}" for i in range(4))
    + " FROM splats_emb", views="splats_emb"))
def _(spark, d):
    return S.quat_to_u8(emb(spark, d)).select(*KEY, *[f"rot_u8_{i}" for i in range(4)])


@query("rgba_to_u8", oracle("SELECT scene_id, point_id, " + ", ".join(
    f"CAST(floor(greatest(0e0, least(1e0, 0.5e0+0.28209479177387814e0*f_dc_{i})) * 255) AS SMALLINT) AS {n}_u8"
    for i, n in enumerate(("red", "green", "blue"))) + ", CAST(floor(greatest(0e0, least(1e0, opacity)) * 255) AS SMALLINT) AS alpha_u8 FROM dec",
    *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    return S.rgba_to_u8(S.sh_to_rgb(E.decode(emb(spark, d)))).select(*KEY, "red_u8", "green_u8", "blue_u8", "alpha_u8")


@query("default_splat_fields", oracle(
    """SELECT scene_id, point_id, round(x, 6) + 0.0 AS x, 0.01e0 AS sx, 0.01e0 AS sy, 0.01e0 AS sz, 1e0 AS rot_0, 0e0 AS rot_1, 0e0 AS rot_2,
       0e0 AS rot_3, 0.5e0 AS opacity, 0.5e0 AS r, 0.5e0 AS g, 0.5e0 AS b FROM splats_li""", views="splats_li"))
def _(spark, d):
    bare = li(spark, d).select("scene_id", "point_id", r6("x").alias("x"))
    return S.default_splat_fields(bare)


@query("preview_color", oracle("SELECT scene_id, point_id, " + ", ".join(
    f"CAST(floor(greatest(0e0, least(255e0, (f_dc_{i} + 0.5e0) * 255))) AS SMALLINT) AS preview_{n}" for i, n in enumerate("rgb"))
    + " FROM splats_emb", views="splats_emb"))
def _(spark, d):
    return S.preview_color(emb(spark, d)).select(*KEY, "preview_r", "preview_g", "preview_b")


@query("rgb_to_sh_dc", oracle("SELECT scene_id, point_id, " + ", ".join(
    f"round((c{i} / 255e0 - 0.5e0) / 0.28209479177387814e0, 6) + 0.0 AS f_dc_{i}" for i in range(3))
    + ", 1e0 AS rot_0, 0e0 AS rot_1, round(ln(0.1e0/0.9e0), 6) AS opacity_raw FROM (SELECT *, "
    + ", ".join(f"floor(greatest(0e0, least(1e0, 0.5e0+0.28209479177387814e0*f_dc_{i})) * 255) AS c{i}" for i in range(3)) + " FROM splats_emb) t",
    views="splats_emb"))
def _(spark, d):
    shown = S.rgba_to_u8(S.sh_to_rgb(emb(spark, d).withColumn("opacity", F.lit(1.0))))
    cloud = shown.select(*KEY, *[F.col(f"{c}_u8").alias(c) for c in ("red", "green", "blue")])
    return S.points_to_splats(cloud, 0.1).select(*KEY, *[r6(c).alias(c) for c in S.DC], "rot_0", "rot_1", r6("opacity_raw").alias("opacity_raw"))


EXTENT = """mean AS (SELECT scene_id, avg(rot_0) AS mx, avg(rot_1) AS my, avg(rot_2) AS mz FROM splats_emb GROUP BY scene_id),
ext AS (SELECT v.scene_id, greatest(max(sqrt((rot_0-mx)*(rot_0-mx)+(rot_1-my)*(rot_1-my)+(rot_2-mz)*(rot_2-mz))), 0.01e0) AS radius
  FROM splats_emb v JOIN mean USING (scene_id) GROUP BY v.scene_id)"""


def camera_centers(spark, d):
    """Stand-in camera centres derived from the rotation columns."""
    return emb(spark, d).select("scene_id", F.col("rot_0").alias("x"), F.col("rot_1").alias("y"), F.col("rot_2").alias("z"))


@query("scene_extent_from_cameras", oracle(
    "SELECT scene_id, round(radius, 6) AS radius, round(radius * 2, 6) AS extent FROM ext", EXTENT, views="splats_emb"))
def _(spark, d):
    return S.scene_extent(camera_centers(spark, d)).select("scene_id", r6("radius").alias("radius"), r6("extent").alias("extent"))


@query("clamp_scene_bounds", oracle(
    """SELECT scene_id, point_id, round(least(sx, e*0.1e0), 6) AS sx, round(least(sy, e*0.1e0), 6) AS sy, round(least(sz, e*0.1e0), 6) AS sz,
       round(x*k, 6) + 0.0 AS x, round(y*k, 6) + 0.0 AS y, round(z*k, 6) + 0.0 AS z
       FROM (SELECT *, CASE WHEN n > 2*e THEN 2*e/n ELSE 1 END AS k FROM
         (SELECT dec.*, radius*2 AS e, sqrt(x*x+y*y+z*z) AS n FROM dec JOIN ext USING (scene_id)) t) u""",
    *steps("splats_emb", "enc", "dec"), EXTENT, views="splats_emb"))
def _(spark, d):
    rows = S.clamp_scene_bounds(E.decode(emb(spark, d)), S.scene_extent(camera_centers(spark, d)))
    return rows.select(*KEY, *[r6(c).alias(c) for c in ("sx", "sy", "sz", "x", "y", "z")])


@query("recenter_scene", oracle(
    """SELECT 'point' AS kind, v.scene_id, round(x-cx, 6) + 0.0 AS x, round(y-cy, 6) + 0.0 AS y, round(z-cz, 6) + 0.0 AS z FROM splats_emb v JOIN m USING (scene_id)
       UNION ALL SELECT 'camera', v.scene_id, round(rot_0-cx, 6) + 0.0, round(rot_1-cy, 6) + 0.0, round(rot_2-cz, 6) + 0.0 FROM splats_emb v JOIN m USING (scene_id)""",
    "m AS (SELECT scene_id, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM splats_emb GROUP BY scene_id)", views="splats_emb"))
def _(spark, d):
    points, cameras = S.recenter_scene(emb(spark, d), camera_centers(spark, d))
    shown = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), "scene_id", *[r6(c).alias(c) for c in S.XYZ])
    return shown(points, "point").unionByName(shown(cameras, "camera"))


# ---- filters ---------------------------------------------------------------

@query("finite_only", oracle(
    """SELECT scene_id, point_id, round(opacity, 6) AS opacity FROM
       (SELECT * REPLACE (CASE WHEN point_id % 7 = 0 THEN 'NaN'::DOUBLE WHEN point_id % 11 = 0 THEN 'Infinity'::DOUBLE ELSE x END AS x) FROM dec) t
       WHERE isfinite(x) AND isfinite(y) AND isfinite(z) AND isfinite(opacity)""",
    *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    broken = F.when(F.col("point_id") % 7 == 0, float("nan")).when(F.col("point_id") % 11 == 0, float("inf")).otherwise(F.col("x"))
    return S.finite_only(E.decode(emb(spark, d)).withColumn("x", broken)).select(*KEY, r6("opacity").alias("opacity"))


@query("min_opacity", oracle("SELECT scene_id, point_id FROM dec WHERE opacity >= 0.12e0",
                             *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    return S.min_opacity(E.decode(emb(spark, d)), 0.12).select(*KEY)


@query("opacity_ladder", oracle(
    """SELECT scene_id, threshold, count_if(opacity > threshold) AS kept, count(*) - count_if(opacity > threshold) AS pruned,
       round(100.0e0*count_if(opacity > threshold)/count(*), 6) AS kept_percent
       FROM dec, (SELECT unnest([0.05e0, 0.1e0, 0.3e0]) AS threshold) t GROUP BY scene_id, threshold""",
    *steps("splats_li", "enc", "dec"), views="splats_li"))
def _(spark, d):
    return S.opacity_ladder(E.decode(li(spark, d)), (0.05, 0.1, 0.3)).drop("total").withColumn("kept_percent", r6("kept_percent"))


@query("export_opacity", oracle("SELECT scene_id, point_id FROM dec WHERE opacity > 0.3e0",
                                *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    return S.opacity_subset(E.decode(emb(spark, d)), 0.3).select(*KEY)


@query("max_radius", oracle("SELECT scene_id, point_id FROM splats_li WHERE sqrt(x*x+y*y+z*z) <= 1.0051e0", views="splats_li"))
def _(spark, d):
    return S.max_radius(li(spark, d), 1.0051).select(*KEY)


@query("max_scale", oracle("SELECT scene_id, point_id FROM dec WHERE greatest(sx, sy, sz) <= 0.0431e0",
                           *steps("splats_li", "enc", "dec"), views="splats_li"))
def _(spark, d):
    return S.max_scale(E.decode(li(spark, d)), 0.0431).select(*KEY)


def filter_report(flagged, min_retention):
    return (S.flagged_report(flagged, min_retention)
            .withColumn("removed_percent", r6("removed_percent")).withColumn("retention_percent", r6("retention_percent")))


REPORT = """scene_id, count(*) AS input_count, count_if(keep) AS output_count, count(*) - count_if(keep) AS removed_count,
  round((count(*) - count_if(keep)) / count(*)::DOUBLE * 100, 6) AS removed_percent, round(count_if(keep) / count(*)::DOUBLE * 100, 6) AS retention_percent,
  CASE WHEN count_if(keep) / count(*)::DOUBLE < {m} THEN 'below_min_retention' ELSE 'ok' END AS status"""
CONF = """med0 AS (SELECT scene_id, quantile_cont(x, 0.5) AS cx, quantile_cont(y, 0.5) AS cy, quantile_cont(z, 0.5) AS cz FROM {v} GROUP BY scene_id),
dst AS (SELECT dec.*, sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)) AS dist FROM dec JOIN med0 USING (scene_id)),
lim AS (SELECT scene_id, quantile_cont(dist, 0.95) + 0.05e0 AS radius_limit FROM dst GROUP BY scene_id),
flg AS (SELECT dst.*, radius_limit, coalesce(opacity >= 0.1e0 AND greatest(sx, sy, sz) <= {s} AND dist <= radius_limit, false) AS keep
  FROM dst JOIN lim USING (scene_id))"""


@query("confidence_filter", oracle("SELECT scene_id, point_id, round(radius_limit, 6) AS radius_limit FROM flg WHERE keep",
    *steps("splats_emb", "enc", "dec"), CONF.format(v="splats_emb", s="0.06e0"), views="splats_emb"))
def _(spark, d):
    rows = S.confidence_filter(emb(spark, d), opacity_min=0.1, max_scale=0.06, radius_percentile=95, radius_margin=0.05)
    return rows.filter("keep").select(*KEY, r6("radius_limit").alias("radius_limit"))


@query("confidence_filter_report", oracle("SELECT " + REPORT.format(m="0.5e0") + " FROM flg GROUP BY scene_id",
    *steps("splats_li", "enc", "dec"), CONF.format(v="splats_li", s="0.0445e0"), views="splats_li"))
def _(spark, d):
    flagged = S.confidence_filter(li(spark, d), opacity_min=0.1, max_scale=0.0445, radius_percentile=95, radius_margin=0.05)
    return filter_report(flagged, 0.5)


CROP = """flo AS (SELECT scene_id, quantile_cont(opacity, 0.8) AS f FROM dec GROUP BY scene_id),
cor AS (SELECT dec.* FROM dec JOIN flo USING (scene_id) WHERE opacity >= f),
box AS (SELECT scene_id, count(*) AS core_count, """ + ", ".join(
    f"quantile_cont({a}, 0.005) - 0.12e0 AS {a}_lo, quantile_cont({a}, 0.995) + 0.12e0 AS {a}_hi" for a in "xyz") + """ FROM cor GROUP BY scene_id),
flg AS (SELECT dec.*, coalesce(x >= x_lo AND x <= x_hi AND y >= y_lo AND y <= y_hi AND z >= z_lo AND z <= z_hi, false) AS keep
  FROM dec JOIN box USING (scene_id))"""


@query("core_crop", oracle("""SELECT flg.scene_id, point_id, round(x_lo, 6) + 0.0 AS x_lo, round(x_hi, 6) + 0.0 AS x_hi, core_count, core_count >= 1000 AS core_ok
    FROM flg JOIN box USING (scene_id) WHERE keep""", *steps("splats_emb", "enc", "dec"), CROP, views="splats_emb"))
def _(spark, d):
    rows = S.core_crop(emb(spark, d)).filter("keep")
    return rows.select(*KEY, r6("x_lo").alias("x_lo"), r6("x_hi").alias("x_hi"), "core_count", "core_ok")


@query("core_crop_report", oracle("SELECT " + REPORT.format(m="0.65e0") + " FROM flg GROUP BY scene_id",
    *steps("splats_li", "enc", "dec"), CROP, views="splats_li"))
def _(spark, d):
    return filter_report(S.core_crop(li(spark, d)), 0.65)


ROBUST = """mid AS (SELECT scene_id, list_sort(list(x))[(count(*)+1)//2] AS cx, list_sort(list(y))[(count(*)+1)//2] AS cy,
  list_sort(list(z))[(count(*)+1)//2] AS cz FROM {v} GROUP BY scene_id),
rad AS (SELECT v.scene_id, list_sort(list(sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)))) AS l FROM {v} v JOIN mid USING (scene_id) GROUP BY v.scene_id),
rob AS (SELECT mid.*, l[(len(l)+1)//2] AS median_dist, l[greatest(1, CAST(floor(len(l)*0.95e0) AS BIGINT))] AS p95_dist,
  l[greatest(1, CAST(floor(len(l)*0.99e0) AS BIGINT))] AS p99_dist FROM mid JOIN rad USING (scene_id)),
rr AS (SELECT *, greatest(median_dist*3, p95_dist*1.2e0, 0.01e0) AS scene_radius FROM rob)"""


@query("kth_value", oracle("""SELECT scene_id, round(list_sort(list(y))[CAST(floor(count(*)*0.95e0) AS BIGINT)], 6) + 0.0 AS k95,
    round(list_sort(list(y))[(count(*)+1)//2], 6) + 0.0 AS lower_median FROM splats_li GROUP BY scene_id""", views="splats_li"))
def _(spark, d):
    rows = li(spark, d)
    k95 = kth_smallest(rows, ["scene_id"], "y", 0.95)
    mid = lower_median(rows, ["scene_id"], "y")
    return k95.join(mid, "scene_id").select("scene_id", r6("kth").alias("k95"), r6("value").alias("lower_median"))


@query("scene_radius_robust", oracle(
    "SELECT scene_id, round(median_dist, 6) AS median_dist, round(p95_dist, 6) AS p95_dist, round(scene_radius, 6) AS scene_radius FROM rr",
    ROBUST.format(v="splats_emb"), views="splats_emb"))
def _(spark, d):
    rows = S.scene_radius_robust(emb(spark, d))
    return rows.select("scene_id", *[r6(c).alias(c) for c in ("median_dist", "p95_dist", "scene_radius")])


@query("geometry_prune", oracle("""SELECT dec.scene_id, point_id FROM dec JOIN rr USING (scene_id)
    WHERE greatest(sx, sy, sz) < scene_radius*0.15e0 AND sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)) < least(p99_dist, scene_radius*2)""",
    *steps("splats_emb", "enc", "dec"), ROBUST.format(v="splats_emb"), views="splats_emb"))
def _(spark, d):
    return S.geometry_prune(emb(spark, d)).filter("keep").select(*KEY)


@query("retention_guard", oracle("SELECT " + REPORT.format(m="0.9e0") +
    " FROM (SELECT scene_id, opacity >= 0.12e0 AS keep FROM dec) t GROUP BY scene_id", *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    rows = E.decode(emb(spark, d))
    report = S.retention_guard(S.min_opacity(rows, 0.12), rows, 0.9)
    return report.withColumn("removed_percent", r6("removed_percent")).withColumn("retention_percent", r6("retention_percent"))


# ---- order and sampling ----------------------------------------------------

@query("top_opacity", oracle("""SELECT scene_id, point_id, opacity_rank FROM (SELECT scene_id, point_id,
    row_number() OVER (PARTITION BY scene_id ORDER BY opacity_raw DESC, point_id) AS opacity_rank FROM splats_li) t WHERE opacity_rank <= 500""", views="splats_li"))
def _(spark, d):
    # raw logits order like opacities
    rows = li(spark, d).withColumn("opacity", F.col("opacity_raw"))
    return S.top_opacity(rows, 500).select(*KEY, "opacity_rank")


@query("depth_sort", oracle("""SELECT scene_id, point_id, row_number() OVER (PARTITION BY scene_id ORDER BY
      round((x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz-3)*(z-mz-3), 9) DESC, point_id) AS depth_rank FROM splats_emb JOIN m USING (scene_id)""",
    "m AS (SELECT scene_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM splats_emb GROUP BY scene_id)", views="splats_emb"))
def _(spark, d):
    return S.depth_sort(emb(spark, d)).select(*KEY, "depth_rank")


@query("stride_sample", oracle("""SELECT scene_id, point_id FROM (SELECT scene_id, point_id, row_number() OVER (PARTITION BY scene_id ORDER BY point_id) - 1 AS p,
      count(*) OVER (PARTITION BY scene_id) AS n FROM splats_li) t
    WHERE n <= 300 OR list_contains(list_transform(range(300), lambda i: CASE WHEN i = 299 THEN n-1 ELSE CAST(floor(i*((n-1)/299e0)) AS BIGINT) END), p)""", views="splats_li"))
def _(spark, d):
    return S.stride_sample(li(spark, d), 300, ["point_id"]).select(*KEY)


# ---- projections -----------------------------------------------------------

ORTHO = """dst AS (SELECT v.*, x-cx AS dx, y-cy AS dy, z-cz AS dz, sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)) AS dist FROM splats_emb v JOIN med USING (scene_id)),
zoo AS (SELECT scene_id, (520-56)/greatest(quantile_cont(dist, 0.99)*2, 1e-6) AS k FROM dst GROUP BY scene_id),
pan AS (SELECT dst.*, k, unnest([{'v':'front','a':dx,'b':dz},{'v':'side','a':dy,'b':dz},{'v':'top','a':dx,'b':dy}]) AS p FROM dst JOIN zoo USING (scene_id)),
prj AS (SELECT scene_id, point_id, f_dc_0, f_dc_1, f_dc_2, p.v AS view, CAST(trunc(p.a*k+260) AS INT) AS px, CAST(trunc(260-p.b*k) AS INT) AS py FROM pan)"""


@query("ortho_project", oracle("SELECT scene_id, point_id, view, px, py FROM prj WHERE px BETWEEN 0 AND 519 AND py BETWEEN 0 AND 519",
    *steps("splats_emb", "med"), ORTHO, views="splats_emb"))
def _(spark, d):
    return S.ortho_project(emb(spark, d)).select(*KEY, "view", "px", "py")


@query("ortho_tiles", oracle("""SELECT scene_id, view, px, py, count(*) AS n, """ + ", ".join(
    f"arg_max(CAST(floor(greatest(0e0, least(255e0, (f_dc_{i} + 0.5e0) * 255))) AS SMALLINT), point_id) AS preview_{c}" for i, c in enumerate("rgb"))
    + " FROM prj WHERE px BETWEEN 0 AND 519 AND py BETWEEN 0 AND 519 GROUP BY scene_id, view, px, py",
    *steps("splats_emb", "med"), ORTHO, views="splats_emb"))
def _(spark, d):
    return S.ortho_tiles(S.preview_color(S.ortho_project(emb(spark, d))), ["preview_r", "preview_g", "preview_b"])


ANGLES = [i * math.pi / 4 for i in range(8)]


def _turn_sql():
    rows = []
    for i, a in enumerate(ANGLES):
        ca, sa = math.cos(a), math.sin(a)
        rows.append(f"({i}, {ca!r}::DOUBLE, {sa!r}::DOUBLE)")
    return ("""dst AS (SELECT v.*, cx, cy, cz, sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)) AS dist FROM dec v JOIN med USING (scene_id)),
cam AS (SELECT scene_id, greatest(quantile_cont(dist, 0.995), 1e-3)*3.2e0 AS cd FROM dst GROUP BY scene_id),
ang(angle_no, ca, sa) AS (VALUES """ + ", ".join(rows) + """),
rel AS (SELECT scene_id, point_id, angle_no, ca, sa, (sx+sy+sz)/3 AS ms, x-(cx+cd*ca) AS rx, y-(cy+cd*sa) AS ry, z-(cz+cd*0.35e0) AS rz, sqrt(1+0.35e0*0.35e0) AS ln
  FROM dst JOIN cam USING (scene_id), ang),
eye AS (SELECT scene_id, point_id, angle_no, ms, -sa*rx+ca*ry AS vx, (-0.35e0*ca*rx-0.35e0*sa*ry+rz)/ln AS vy, -(ca*rx+sa*ry+0.35e0*rz)/ln AS vz FROM rel),
pix AS (SELECT *, 320+342.0e0*vx/vz AS px, 180-342.0e0*vy/vz AS py FROM eye WHERE vz > 1e-4)""")


@query("turntable_project", oracle("""SELECT scene_id, point_id, angle_no, round(px, 5) + 0.0 AS px, round(py, 5) + 0.0 AS py, round(vz, 6) AS depth,
    round(greatest(1e0, least(6e0, ms*342.0e0/vz*3)), 6) AS disc FROM pix WHERE px >= -20 AND px < 660 AND py >= -20 AND py < 380""",
    *steps("splats_emb", "enc", "dec", "med"), _turn_sql(), views="splats_emb"))
def _(spark, d):
    rows = S.turntable_project(E.decode(emb(spark, d)), ANGLES)
    return rows.select(*KEY, "angle_no", (F.round("px", 5) + 0.0).alias("px"), (F.round("py", 5) + 0.0).alias("py"), r6("depth").alias("depth"), r6("disc").alias("disc"))


# ---- diagnostics -----------------------------------------------------------

DIAG = """bnd AS (SELECT scene_id, count(*) AS count, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, min(z) AS z_min, max(z) AS z_max,
  quantile_cont(opacity_raw, 0.5) AS opacity_raw_p50, quantile_cont(opacity_raw, 0.95) AS opacity_raw_p95, max(opacity_raw) AS opacity_raw_max FROM {v} GROUP BY scene_id),
rds AS (SELECT v.scene_id, quantile_cont(sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)), [0.5, 0.95, 0.99, 1.0]) AS q FROM {v} v JOIN med USING (scene_id) GROUP BY v.scene_id),
raw AS (SELECT scene_id, quantile_cont(s, [0.5, 0.95, 0.99, 1.0]) AS s FROM flat GROUP BY scene_id),
act AS (SELECT scene_id, quantile_cont(CASE WHEN scale_is_log THEN exp(s) ELSE s END, [0.5, 0.95, 0.99, 1.0]) AS a FROM flat JOIN enc USING (scene_id) GROUP BY scene_id)"""
DIAG_OUT = """SELECT scene_id, count, round(x_min, 6) AS x_min, round(x_max, 6) AS x_max, round(y_min, 6) AS y_min, round(y_max, 6) AS y_max,
  round(z_min, 6) AS z_min, round(z_max, 6) AS z_max, round(q[1], 6) AS radius_p50, round(q[2], 6) AS radius_p95, round(q[3], 6) AS radius_p99,
  round(q[4], 6) AS radius_max, round(s[1], 6) AS scale_p50, round(s[2], 6) AS scale_p95, round(s[3], 6) AS scale_p99, round(s[4], 6) AS scale_max,
  round(a[1], 6) AS scale_actual_p50, round(a[2], 6) AS scale_actual_p95, round(a[3], 6) AS scale_actual_p99, round(a[4], 6) AS scale_actual_max,
  round(opacity_raw_p50, 6) + 0.0 AS opacity_raw_p50, round(opacity_raw_p95, 6) AS opacity_raw_p95, round(opacity_raw_max, 6) AS opacity_raw_max,
  CASE WHEN scale_is_log THEN 'log' ELSE 'actual' END AS scale_kind, q[3] <= 100 AND q[4] <= greatest(100, q[3]*20) AS ok
  FROM bnd JOIN rds USING (scene_id) JOIN raw USING (scene_id) JOIN act USING (scene_id) JOIN enc USING (scene_id)"""
DIAG_COLS = ["x_min", "x_max", "y_min", "y_max", "z_min", "z_max", "radius_p50", "radius_p95", "radius_p99", "radius_max", "scale_p50", "scale_p95", "scale_p99",
             "scale_max", "scale_actual_p50", "scale_actual_p95", "scale_actual_p99", "scale_actual_max", "opacity_raw_p50", "opacity_raw_p95", "opacity_raw_max"]


def diagnosed(splats):
    return D.diagnose(splats).select("scene_id", "count", *[r6(c).alias(c) for c in DIAG_COLS], "scale_kind", "ok")


@query("diagnose", oracle(DIAG_OUT, *steps("splats_li", "enc", "med"), DIAG.format(v="splats_li"), views="splats_li"))
def _(spark, d):
    return diagnosed(li(spark, d))


@query("diagnose_emb", oracle(DIAG_OUT, *steps("splats_emb", "enc", "med"), DIAG.format(v="splats_emb"), views="splats_emb"))
def _(spark, d):
    return diagnosed(emb(spark, d))


@query("diagnose_all", oracle("SELECT bool_and(q[3] <= 100 AND q[4] <= greatest(100, q[3]*20)) AS ok, count(*) AS scenes FROM rds",
    *steps("splats_emb", "enc", "med"), DIAG.format(v="splats_emb"), views="splats_emb"))
def _(spark, d):
    return D.diagnose_all(D.diagnose(emb(spark, d)))


@query("summary5", oracle("""SELECT scene_id, round(min(sharpness), 6) AS min, round(quantile_cont(sharpness, 0.1), 6) AS p10, round(quantile_cont(sharpness, 0.5), 6) AS p50,
    round(quantile_cont(sharpness, 0.9), 6) AS p90, round(max(sharpness), 6) AS max FROM frame_stats GROUP BY scene_id""", views="frame_stats"))
def _(spark, d):
    return D.summary5(X.frame_stats(spark, d), "sharpness").select("scene_id", *[r6(c).alias(c) for c in ("min", "p10", "p50", "p90", "max")])


@query("summary10", oracle("SELECT scene_id, " + ", ".join(f"round(quantile_cont(opacity, {p/100}), 6) AS p{p}" for p in D.TEN_POINTS) + " FROM dec GROUP BY scene_id",
    *steps("splats_li", "enc", "dec"), views="splats_li"))
def _(spark, d):
    rows = D.summary10(E.decode(li(spark, d)), "opacity")
    return rows.select("scene_id", *[r6(f"p{p}").alias(f"p{p}") for p in D.TEN_POINTS])


@query("ply_vertex_count", oracle("SELECT scene_id, count(*) AS vertex_count FROM splats_li GROUP BY scene_id", views="splats_li"))
def _(spark, d):
    return D.vertex_count(li(spark, d))


# ---- candidates: every opacity threshold yields one candidate of each scene ----

CANDIDATES = (("t05", 0.05), ("t20", 0.2), ("t45", 0.45))


def candidate_tables(spark, d):
    rows = E.decode(emb(spark, d))
    versions = F.array(*[F.struct(F.lit(n).alias("candidate"), F.lit(t).alias("t")) for n, t in (("base", -1.0), *CANDIDATES)])
    clouds = rows.withColumn("v", F.explode(versions)).filter("opacity > v.t").withColumn("candidate", F.col("v.candidate"))
    diag = D.diagnose(clouds.select("scene_id", "candidate", *S.XYZ, "opacity_raw", *E.SCALES), ["scene_id", "candidate"])
    listing = clouds.groupBy("scene_id", "candidate").agg((F.count("*") * 4096).alias("bytes"))
    metrics = D.candidate_metrics(diag, listing)
    return metrics.filter("candidate <> 'base'"), metrics.filter("candidate = 'base'")


CAND = """ver(candidate, t) AS (VALUES ('base', -1e0), ('t05', 0.05e0), ('t20', 0.2e0), ('t45', 0.45e0)),
cl AS (SELECT dec.*, candidate FROM dec, ver WHERE opacity > t),
cm AS (SELECT scene_id, candidate, quantile_cont(x, 0.5) AS cx, quantile_cont(y, 0.5) AS cy, quantile_cont(z, 0.5) AS cz, count(*) AS point_count,
  CAST(printf('%.2f', CAST(count(*)*4096/1048576.0e0 AS DOUBLE)) AS DOUBLE) AS size_mb FROM cl GROUP BY ALL),
cr AS (SELECT scene_id, candidate, quantile_cont(sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)), 0.99) AS radius_p99,
  max(sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz))) AS radius_max FROM cl JOIN cm USING (scene_id, candidate) GROUP BY ALL),
cf AS (SELECT scene_id, candidate, unnest([scale_raw_0, scale_raw_1, scale_raw_2]) AS s FROM cl),
ck AS (SELECT scene_id, candidate, quantile_cont(s, 0.5) < -0.25 AS lg FROM cf GROUP BY ALL),
cs AS (SELECT scene_id, candidate, quantile_cont(CASE WHEN lg THEN exp(s) ELSE s END, 0.99) AS scale_actual_p99 FROM cf JOIN ck USING (scene_id, candidate) GROUP BY ALL),
met AS (SELECT cm.*, radius_p99, radius_max, scale_actual_p99, CASE WHEN lg THEN 'log' ELSE 'actual' END AS scale_kind,
  radius_p99 <= 100 AND radius_max <= greatest(100, radius_p99*20) AS ok
  FROM cm JOIN cr USING (scene_id, candidate) JOIN cs USING (scene_id, candidate) JOIN ck USING (scene_id, candidate)),
del AS (SELECT c.*, b.point_count AS base_point_count, b.radius_p99 AS base_radius_p99, b.scale_actual_p99 AS base_scale, b.size_mb AS base_size
  FROM met c JOIN met b USING (scene_id) WHERE c.candidate <> 'base' AND b.candidate = 'base'),
sco AS (SELECT *, 100.0e0 - abs(1 - point_count/greatest(1, base_point_count)::DOUBLE)*60 - greatest(0, radius_p99-base_radius_p99)*10
  - greatest(0, scale_actual_p99-base_scale)*20 - CASE WHEN ok THEN 0 ELSE 40 END AS candidate_score FROM del)"""


@query("candidate_metrics", oracle("""SELECT scene_id, candidate, point_count, size_mb, ok, scale_kind, round(radius_p99, 6) AS radius_p99,
    round(scale_actual_p99, 6) AS scale_actual_p99 FROM met WHERE candidate <> 'base'""", *steps("splats_emb", "enc", "dec"), CAND, views="splats_emb"))
def _(spark, d):
    candidates, _base = candidate_tables(spark, d)
    return candidates.select("scene_id", "candidate", "point_count", "size_mb", "ok", "scale_kind", r6("radius_p99").alias("radius_p99"),
                             r6("scale_actual_p99").alias("scale_actual_p99"))


@query("candidate_delta", oracle("""SELECT scene_id, candidate, point_count - base_point_count AS points_delta,
    CAST(printf('%.2f', CAST(100.0e0*(point_count-base_point_count)/greatest(1, base_point_count) AS DOUBLE)) AS DOUBLE) AS points_delta_percent,
    CAST(printf('%.2f', CAST(size_mb-base_size AS DOUBLE)) AS DOUBLE) + 0.0 AS size_mb_delta, round(radius_p99-base_radius_p99, 6) + 0.0 AS radius_p99_delta,
    round(scale_actual_p99-base_scale, 6) + 0.0 AS scale_actual_p99_delta FROM del""", *steps("splats_emb", "enc", "dec"), CAND, views="splats_emb"))
def _(spark, d):
    rows = D.candidate_delta(*candidate_tables(spark, d))
    return rows.select("scene_id", "candidate", "points_delta", "points_delta_percent", (F.col("size_mb_delta") + 0.0).alias("size_mb_delta"),
                       r6("radius_p99_delta").alias("radius_p99_delta"), r6("scale_actual_p99_delta").alias("scale_actual_p99_delta"))


@query("recommend_candidate", oracle("""SELECT scene_id, candidate, CAST(printf('%.2f', CAST(candidate_score AS DOUBLE)) AS DOUBLE) AS score FROM
    (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY candidate_score DESC, candidate) AS i FROM sco) t WHERE i = 1""",
    *steps("splats_emb", "enc", "dec"), CAND, views="splats_emb"))
def _(spark, d):
    rows = D.recommend_candidate(D.candidate_delta(*candidate_tables(spark, d)))
    return rows.select("scene_id", "candidate", round_half_even("candidate_score", 2).alias("score"))


@query("candidates_all_ok", oracle("SELECT scene_id, bool_and(ok) AS ok FROM met GROUP BY scene_id", *steps("splats_emb", "enc", "dec"), CAND, views="splats_emb"))
def _(spark, d):
    candidates, base = candidate_tables(spark, d)
    return D.diagnose_all(candidates.unionByName(base), "scene_id").select("scene_id", "ok")
