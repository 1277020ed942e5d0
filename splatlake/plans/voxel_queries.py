"""Voxel clustering queries over the fixture clouds, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..operators import encodings as E, voxels as V
from . import fixtures as X
from .fixtures import oracle
from .registry import query
from .splat_queries import steps

SIZE = 0.5
KEY = ["scene_id", "point_id"]


def base_points(spark, d):
    rows = E.decode(X.splats_emb(spark, d)).filter(F.col("opacity") >= 0.12)
    return V.voxel_key(V.with_seed(rows), SIZE)


def vox_sql(view="dec", size="0.5e0", seed=("0", "0", "0"), where="opacity >= 0.12e0", prefix=""):
    return f"""{prefix}pts AS (SELECT *, CAST(floor((x-{seed[0]})/{size}) AS BIGINT) AS i, CAST(floor((y-{seed[1]})/{size}) AS BIGINT) AS j,
  CAST(floor((z-{seed[2]})/{size}) AS BIGINT) AS k FROM {view} WHERE {where}),
{prefix}vox AS (SELECT scene_id, i, j, k, count(*) AS n FROM {prefix}pts GROUP BY ALL)"""


def reach_sql(connectivity=26, prefix=""):
    near = {26: "abs(a.i-b.i) <= 1 AND abs(a.j-b.j) <= 1 AND abs(a.k-b.k) <= 1",
            18: "abs(a.i-b.i) <= 1 AND abs(a.j-b.j) <= 1 AND abs(a.k-b.k) <= 1 AND abs(a.i-b.i)+abs(a.j-b.j)+abs(a.k-b.k) <= 2",
            6: "abs(a.i-b.i)+abs(a.j-b.j)+abs(a.k-b.k) <= 1"}[connectivity]
    return f"""{prefix}adj AS (SELECT a.scene_id, a.i, a.j, a.k, b.i AS i2, b.j AS j2, b.k AS k2 FROM {prefix}vox a JOIN {prefix}vox b ON a.scene_id = b.scene_id AND {near}),
{prefix}rch AS (SELECT scene_id, i, j, k, i AS ri, j AS rj, k AS rk FROM {prefix}vox
  UNION SELECT r.scene_id, r.i, r.j, r.k, e.i2, e.j2, e.k2 FROM {prefix}rch r JOIN {prefix}adj e ON r.scene_id = e.scene_id AND r.ri = e.i AND r.rj = e.j AND r.rk = e.k),
{prefix}lab AS (SELECT scene_id, i, j, k, n, c[1] AS ci, c[2] AS cj, c[3] AS ck FROM
  (SELECT scene_id, i, j, k, min([ri, rj, rk]) AS c FROM {prefix}rch GROUP BY ALL) t JOIN {prefix}vox USING (scene_id, i, j, k))"""


def stat_sql(size="0.5e0", seed=("0", "0", "0"), prefix=""):
    return f"""{prefix}cst AS (SELECT *, sqrt((cx-{seed[0]})*(cx-{seed[0]})+(cy-{seed[1]})*(cy-{seed[1]})+(cz-{seed[2]})*(cz-{seed[2]})) AS distance_to_seed FROM
  (SELECT scene_id, ci, cj, ck, CAST(sum(n) AS BIGINT) AS point_count, count(*) AS voxel_count, avg((i+0.5e0)*{size}+{seed[0]}) AS cx, avg((j+0.5e0)*{size}+{seed[1]}) AS cy,
   avg((k+0.5e0)*{size}+{seed[2]}) AS cz FROM {prefix}lab GROUP BY scene_id, ci, cj, ck) t)"""


BASE = steps("splats_emb", "enc", "dec")


@query("voxel_key", oracle("SELECT scene_id, point_id, i, j, k FROM pts", vox_sql("splats_li", "0.1e0", ("0.01e0", "0.02e0", "0.03e0"), "true"), views="splats_li"))
def _(spark, d):
    return V.voxel_key(V.with_seed(X.splats_li(spark, d), (0.01, 0.02, 0.03)), 0.1).select(*KEY, "i", "j", "k")


@query("voxel_occupancy", oracle("SELECT scene_id, i, j, k, n FROM vox", vox_sql("splats_li", "0.1e0", ("0.01e0", "0.02e0", "0.03e0"), "true"), views="splats_li"))
def _(spark, d):
    return V.voxel_occupancy(V.voxel_key(V.with_seed(X.splats_li(spark, d), (0.01, 0.02, 0.03)), 0.1))


def _edges(connectivity):
    name = f"neighbor_edges_{connectivity}"
    sql = oracle("SELECT scene_id, i, j, k, i2, j2, k2 FROM adj WHERE [i2, j2, k2] > [i, j, k]", *BASE, vox_sql(),
                 reach_sql(connectivity).split(",\nrch AS")[0], views="splats_emb")

    @query(name, sql)
    def _(spark, d):
        return V.voxel_edges(V.voxel_occupancy(base_points(spark, d)), connectivity)


def _components(connectivity):
    sql = oracle("SELECT scene_id, i, j, k, n, ci, cj, ck FROM lab", *BASE, vox_sql(), reach_sql(connectivity), views="splats_emb")

    @query(f"voxel_components_{connectivity}", sql)
    def _(spark, d):
        return V.voxel_components(V.voxel_occupancy(base_points(spark, d)), connectivity)


for _c in (6, 18, 26):
    _edges(_c)
    _components(_c)


def stats_of(spark, d, connectivity=18):
    labelled = V.voxel_components(V.voxel_occupancy(base_points(spark, d)), connectivity)
    return labelled, V.component_stats(labelled, SIZE)


LAB = [*BASE, vox_sql(), reach_sql(18), stat_sql()]
STAT_OUT = "scene_id, ci, cj, ck, point_count, voxel_count, round(cx, 6) + 0.0 AS cx, round(cy, 6) + 0.0 AS cy, round(cz, 6) + 0.0 AS cz, round(distance_to_seed, 6) AS distance_to_seed"


def shown(stats):
    return stats.select("scene_id", *V.ROOT, "point_count", "voxel_count", *[r6(c).alias(c) for c in ("cx", "cy", "cz", "distance_to_seed")])


@query("component_stats", oracle(f"SELECT {STAT_OUT} FROM cst", *LAB, views="splats_emb"))
def _(spark, d):
    return shown(stats_of(spark, d)[1])


PICK = """pk{s} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY point_count >= {m} DESC, {o} point_count DESC, ci, cj, ck) AS r FROM cst) t WHERE r = 1)"""
NEAR = "CASE WHEN point_count >= {m} THEN distance_to_seed END NULLS LAST,"


@query("select_component_nearest", oracle(f"SELECT {STAT_OUT} FROM pkn", *LAB, PICK.format(s="n", m=20, o=NEAR.format(m=20)), views="splats_emb"))
def _(spark, d):
    return shown(V.select_component(stats_of(spark, d)[1], "nearest", 20))


@query("select_component_largest", oracle(f"SELECT {STAT_OUT} FROM pkl", *LAB, PICK.format(s="l", m=1000, o=""), views="splats_emb"))
def _(spark, d):
    return shown(V.select_component(stats_of(spark, d)[1], "largest", 1000))


@query("largest_components", oracle(f"SELECT {STAT_OUT}, component_rank FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY point_count DESC, ci, cj, ck) AS component_rank FROM cst) t WHERE component_rank <= 12",
                                    *LAB, views="splats_emb"))
def _(spark, d):
    top = V.largest_components(stats_of(spark, d)[1])
    return top.select("scene_id", *V.ROOT, "point_count", "voxel_count", *[r6(c).alias(c) for c in ("cx", "cy", "cz", "distance_to_seed")], "component_rank")


GROW = """dil AS (SELECT DISTINCT scene_id, i+di AS i, j+dj AS j, k+dk AS k FROM {v}, (SELECT unnest(range(-{r}, {r}+1)) AS di) a, (SELECT unnest(range(-{r}, {r}+1)) AS dj) b,
  (SELECT unnest(range(-{r}, {r}+1)) AS dk) c)"""


@query("dilate", oracle("SELECT scene_id, i, j, k FROM dil", *BASE, vox_sql(where="opacity >= 0.6e0"), GROW.format(v="vox", r=2), views="splats_emb"))
def _(spark, d):
    return V.dilate(V.voxel_occupancy(base_points(spark, d).filter("opacity >= 0.6")), 2)


@query("keep_points_in_voxels", oracle("SELECT scene_id, point_id FROM ppts SEMI JOIN dil USING (scene_id, i, j, k)", *BASE,
    vox_sql(prefix="p"), vox_sql(where="opacity >= 0.6e0"), GROW.format(v="vox", r=1), views="splats_emb"))
def _(spark, d):
    points = base_points(spark, d)
    core = V.dilate(V.voxel_occupancy(points.filter("opacity >= 0.6")), 1)
    return V.keep_points_in_voxels(points, core).select(*KEY)


# Auto parameters: with fewer than `min_high` points the core falls back twice, as scenes of the small fixture do.
AUTO = """p35 AS (SELECT scene_id, greatest({o}, quantile_cont(opacity, 0.35)) AS opacity_floor FROM dec GROUP BY scene_id),
cnt AS (SELECT dec.scene_id, any_value(opacity_floor) AS opacity_floor, count_if(opacity >= opacity_floor) AS n1, count_if(opacity >= {o}) AS n2 FROM dec JOIN p35 USING (scene_id) GROUP BY dec.scene_id),
hi AS (SELECT dec.*, opacity_floor FROM dec JOIN cnt USING (scene_id) WHERE opacity >= CASE WHEN n1 >= {h} THEN opacity_floor WHEN n2 >= {h} THEN {o} ELSE '-inf'::DOUBLE END),
ctr AS (SELECT scene_id, quantile_cont(x, 0.5) AS cx, quantile_cont(y, 0.5) AS cy, quantile_cont(z, 0.5) AS cz FROM hi GROUP BY scene_id),
hst AS (SELECT scene_id, any_value(opacity_floor) AS opacity_floor, count(*) AS high_confidence_count, quantile_cont(sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)), [0.85, 0.90]) AS q,
  quantile_cont(greatest(sx, sy, sz), [0.90, 0.95]) AS s FROM hi JOIN ctr USING (scene_id) GROUP BY scene_id),
aut AS (SELECT *, greatest(q[1]*2.2e0, q[2]*1.75e0, 0.5e0) AS max_radius, greatest(s[1]*1.8e0, s[2]*1.2e0) AS max_scale FROM hst JOIN ctr USING (scene_id))"""
AUTO_OUT = """SELECT scene_id, high_confidence_count, round(opacity_floor, 6) AS opacity_floor, round(cx, 6) + 0.0 AS seed_x, round(cy, 6) + 0.0 AS seed_y,
  round(cz, 6) + 0.0 AS seed_z, round(max_radius, 6) AS used_max_radius, round(max_scale, 6) AS used_max_scale FROM aut"""


def auto_shown(rows):
    return rows.select("scene_id", "high_confidence_count", *[r6(c).alias(c) for c in ("opacity_floor", *V.SEED, "used_max_radius", "used_max_scale")])


@query("auto_cleanup_params", oracle(AUTO_OUT, *steps("splats_li", "enc", "dec"), AUTO.format(o="0.08e0", h=1000), views="splats_li"))
def _(spark, d):
    rows = X.splats_li(spark, d)
    return auto_shown(V.auto_cleanup_params(E.decode(rows), 0.08, size_of=rows))


@query("auto_cleanup_params_fallback", oracle(AUTO_OUT, *BASE, AUTO.format(o="0.3e0", h=35), views="splats_emb"))
def _(spark, d):
    rows = X.splats_emb(spark, d)
    return auto_shown(V.auto_cleanup_params(E.decode(rows), 0.3, min_high=35, size_of=rows))


CLEAN = [*BASE, vox_sql(), reach_sql(26), stat_sql(), PICK.format(s="n", m=30, o=NEAR.format(m=30)),
         "cor AS (SELECT lab.* FROM lab SEMI JOIN pkn USING (scene_id, ci, cj, ck))", GROW.format(v="cor", r=1)]
PARAMS = V.CleanParams(opacity_min=0.12, voxel_size=SIZE, min_component_points=30)


@query("cluster_clean", oracle("SELECT scene_id, point_id FROM pts SEMI JOIN dil USING (scene_id, i, j, k)", *CLEAN, views="splats_emb"))
def _(spark, d):
    return V.cluster_clean(X.splats_emb(spark, d), PARAMS).kept.select(*KEY)


REPORT = """SELECT t.scene_id, input_count, base_count, output_count, component_count, input_count - output_count AS removed_count,
  round((input_count - output_count) / input_count::DOUBLE * 100, 6) AS removed_percent, point_count AS selected_point_count, voxel_count AS selected_voxel_count,
  round(distance_to_seed, 6) AS selected_distance_to_seed
  FROM (SELECT scene_id, count(*) AS input_count FROM dec GROUP BY scene_id) t
  JOIN (SELECT scene_id, CAST(sum(n) AS BIGINT) AS base_count, count(DISTINCT [ci, cj, ck]) AS component_count FROM lab GROUP BY scene_id) b USING (scene_id)
  JOIN (SELECT scene_id, count(*) AS output_count FROM pts SEMI JOIN dil USING (scene_id, i, j, k) GROUP BY scene_id) o USING (scene_id)
  JOIN pkn USING (scene_id)"""
REPORT_COLS = ["scene_id", "input_count", "base_count", "output_count", "component_count", "removed_count"]


def report_shown(report):
    return report.select(*REPORT_COLS, r6("removed_percent").alias("removed_percent"), "selected_point_count", "selected_voxel_count",
                         r6("selected_distance_to_seed").alias("selected_distance_to_seed"))


@query("cluster_clean_report", oracle(REPORT, *CLEAN, views="splats_emb"))
def _(spark, d):
    return report_shown(V.cluster_clean(X.splats_emb(spark, d), PARAMS).report)


AUTO_CLEAN = [*BASE, AUTO.format(o="0.12e0", h=30), "sdd AS (SELECT dec.*, cx AS s1, cy AS s2, cz AS s3, max_scale FROM dec JOIN aut USING (scene_id))",
              vox_sql("sdd", "0.5e0", ("s1", "s2", "s3"), "opacity >= 0.12e0 AND greatest(sx, sy, sz) <= max_scale"), reach_sql(26),
              """cst AS (SELECT *, sqrt((cx-s1)*(cx-s1)+(cy-s2)*(cy-s2)+(cz-s3)*(cz-s3)) AS distance_to_seed FROM
  (SELECT lab.scene_id, ci, cj, ck, CAST(sum(n) AS BIGINT) AS point_count, count(*) AS voxel_count, avg((i+0.5e0)*0.5e0+a.cx) AS cx, avg((j+0.5e0)*0.5e0+a.cy) AS cy,
   avg((k+0.5e0)*0.5e0+a.cz) AS cz, any_value(a.cx) AS s1, any_value(a.cy) AS s2, any_value(a.cz) AS s3 FROM lab JOIN ctr a USING (scene_id) GROUP BY lab.scene_id, ci, cj, ck) t)""",
              PICK.format(s="n", m=30, o=NEAR.format(m=30)),
              "cor AS (SELECT lab.* FROM lab SEMI JOIN pkn USING (scene_id, ci, cj, ck))", GROW.format(v="cor", r=1)]


@query("cluster_clean_auto", oracle(REPORT, *AUTO_CLEAN, views="splats_emb"))
def _(spark, d):
    p = V.CleanParams(opacity_min=0.12, voxel_size=SIZE, min_component_points=30, auto=True, min_high=30)
    return report_shown(V.cluster_clean(X.splats_emb(spark, d), p).report)


@query("cluster_clean_volume")
def _(spark, d):
    """Balanced preset on the large cloud; rows only, the twin's pairwise recursion is too slow there."""
    p = V.CleanParams(preset="balanced", auto=True)
    return report_shown(V.cluster_clean(X.splats_li(spark, d), p).report)
