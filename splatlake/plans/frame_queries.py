"""Frame queries over 8x8 pixel frames and the metric table, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..operators import frames as G, pixels as P
from . import fixtures as X
from .fixtures import oracle
from .registry import query

KEY = ["scene_id", "raw_index"]
# Every pixel with its 4 neighbours under a mirrored border (the edge pixel itself is not repeated).
PIX = """pix AS (SELECT scene_id, raw_index, p, p // 8 AS r, p % 8 AS c, pixels, pixels[p+1] AS v FROM frames8, (SELECT unnest(range(64)) AS p) t),
lap AS (SELECT scene_id, raw_index, v, pixels[8*CASE WHEN r = 0 THEN 1 ELSE r-1 END + c + 1] + pixels[8*CASE WHEN r = 7 THEN 6 ELSE r+1 END + c + 1]
  + pixels[8*r + CASE WHEN c = 0 THEN 1 ELSE c-1 END + 1] + pixels[8*r + CASE WHEN c = 7 THEN 6 ELSE c+1 END + 1] - 4*v AS l FROM pix),
hlt AS (SELECT scene_id, raw_index, avg(v) AS brightness, stddev_pop(v) AS contrast, count_if(v <= 5)/64.0e0 AS dark_ratio, count_if(v >= 250)/64.0e0 AS bright_ratio,
  greatest(count_if(v <= 5), count_if(v >= 250))/64.0e0 AS clipped_ratio, var_pop(l) AS sharpness FROM lap GROUP BY scene_id, raw_index)"""
DIFF = "list_sum(list_transform(list_zip({a}, {b}), lambda q: abs(q[1] - q[2]))) / 64.0e0 / 255"


@query("frame_dims", oracle("SELECT scene_id, arg_min(width, raw_index) AS width, arg_min(height, raw_index) AS height, count(*) AS frames FROM frames8 GROUP BY scene_id", views="frames8"))
def _(spark, d):
    return G.frame_dims(X.frames8(spark, d))


@query("unreadable_count", oracle("SELECT user_id AS scene_id, count(*) AS listed, count_if(event_id % 13 = 0) AS unreadable FROM events GROUP BY user_id"))
def _(spark, d):
    from ..sources.images import unreadable_count
    listed = X.table(spark, d, "events").select(F.col("user_id").alias("scene_id"), F.concat(F.lit("f"), "event_id", F.lit(".png")).alias("path"))
    return unreadable_count(listed, listed.filter("CAST(substr(path, 2, length(path) - 5) AS BIGINT) % 13 <> 0"))


@query("frame_health", oracle("SELECT scene_id, raw_index, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("brightness", "contrast", "dark_ratio", "bright_ratio", "clipped_ratio")) + " FROM hlt", PIX, views="frames8"))
def _(spark, d):
    return P.frame_health(X.frames8(spark, d)).select(*KEY, *[r6(c).alias(c) for c in ("brightness", "contrast", "dark_ratio", "bright_ratio", "clipped_ratio")])


@query("sharpness", oracle("SELECT scene_id, raw_index, round(sharpness, 6) AS sharpness FROM hlt", PIX, views="frames8"))
def _(spark, d):
    return P.frame_health(X.frames8(spark, d)).select(*KEY, r6("sharpness").alias("sharpness"))


@query("downscale_gray")
def _(spark, d):
    """Longest side brought to 4; rows only, the resampling filter has no SQL twin."""
    return P.downscale_gray(X.frames8(spark, d), max_side=4).select(*KEY, "width", "height", F.hex("pixels").alias("pixels"))


@query("consecutive_diff", oracle(f"""SELECT a.scene_id, a.raw_index, round({DIFF.format(a='a.pixels', b='b.pixels')}, 6) AS frame_diff FROM frames8 a
    LEFT JOIN frames8 b ON a.scene_id = b.scene_id AND a.raw_index = b.raw_index + 1""", views="frames8"))
def _(spark, d):
    return P.consecutive_diff(X.frames8(spark, d)).select(*KEY, r6("frame_diff").alias("frame_diff"))


@query("frame_stride_sample", oracle("""SELECT scene_id, raw_index FROM (SELECT *, count(*) OVER (PARTITION BY scene_id) AS n FROM frame_stats) t
    WHERE raw_index % greatest(1, CAST(ceil(n / 16.0e0) AS BIGINT)) = 0""", views="frame_stats"))
def _(spark, d):
    return G.frame_stride_sample(X.frame_stats(spark, d), 16).select(*KEY)


EXPOSED = "brightness >= 8 AND brightness <= 247 AND contrast >= 4 AND clipped_ratio <= 0.92e0"


@query("exposure_gate", oracle(f"SELECT scene_id, raw_index FROM frame_stats WHERE {EXPOSED}", views="frame_stats"))
def _(spark, d):
    return G.exposure_gate(X.frame_stats(spark, d)).select(*KEY)


@query("blur_gate", oracle("SELECT scene_id, raw_index FROM frame_stats WHERE sharpness >= 12.5", views="frame_stats"))
def _(spark, d):
    return G.blur_gate(X.frame_stats(spark, d), 12.5).select(*KEY)


@query("threshold_ladder", oracle("""SELECT scene_id, pass_no, CASE WHEN pass_no = 0 THEN 'strict' ELSE 'coverage_' || pass_no END AS pass, round(s, 6) AS pass_sharpness, round(d, 6) AS pass_diff FROM
    (SELECT scene_id, l.n AS pass_no, ms*l.a AS s, md*l.b AS d, row_number() OVER (PARTITION BY scene_id, CAST(printf('%.6f', CAST(ms*l.a AS DOUBLE)) AS DOUBLE), CAST(printf('%.6f', CAST(md*l.b AS DOUBLE)) AS DOUBLE) ORDER BY l.n) AS i FROM req,
     (SELECT unnest([{'n':0,'a':1.0e0,'b':1.0e0},{'n':1,'a':0.65e0,'b':0.75e0},{'n':2,'a':0.4e0,'b':0.5e0},{'n':3,'a':0.2e0,'b':0.25e0}]) AS l) t) u WHERE i = 1""",
    "req AS (SELECT scene_id, CASE WHEN scene_id % 3 = 0 THEN 0 ELSE max(sharpness) END AS ms, CASE WHEN scene_id % 6 = 0 THEN 0 ELSE min(clipped_ratio) + 0.02e0 END AS md FROM frame_stats GROUP BY scene_id)", views="frame_stats"))
def _(spark, d):
    k = F.col("scene_id")
    req = X.frame_stats(spark, d).groupBy("scene_id").agg(F.when(k % 3 == 0, 0.0).otherwise(F.max("sharpness")).alias("min_sharpness"),
                                                          F.when(k % 6 == 0, 0.0).otherwise(F.min("clipped_ratio") + 0.02).alias("min_frame_diff"))
    return G.ladder_columns(req).select("scene_id", "pass_no", "pass", r6("pass_sharpness").alias("pass_sharpness"), r6("pass_diff").alias("pass_diff"))


# ---- metric-only ladder ----------------------------------------------------

LADDER = G.threshold_ladder(20.0, 0.02)
LAD = "lad(pass_no, pass, ms, md) AS (VALUES " + ", ".join(f"({n}, '{name}', {s!r}::DOUBLE, {dd!r}::DOUBLE)" for n, name, s, dd in LADDER) + ")"
FATE = f"""thr AS (SELECT f.*, pass_no, pass, ms, md, {EXPOSED} AS good, ({EXPOSED}) AND sharpness >= ms AS elig FROM frame_stats f, lad),
num AS (SELECT *, CASE WHEN elig THEN row_number() OVER (PARTITION BY scene_id, pass_no, elig ORDER BY raw_index) - 1 END AS pos,
  count_if(elig) OVER (PARTITION BY scene_id, pass_no) AS n FROM thr),
fat AS (SELECT *, CASE WHEN NOT good THEN 'bad_exposure' WHEN NOT elig THEN 'blur' WHEN n <= 10 OR list_contains(list_transform(range(10), lambda i: CAST(round_even(i * ((n-1)/9.0e0), 0) AS BIGINT)), pos)
  THEN 'kept' ELSE 'thinned' END AS reason FROM num)"""
STAT = """sta AS (SELECT scene_id, pass_no, pass, count(*) AS raw_count, count_if(elig) AS eligible_count, count_if(reason = 'kept') AS kept_count, count_if(reason = 'blur') AS skipped_blur,
  count_if(reason = 'bad_exposure') AS skipped_bad_exposure, count_if(reason = 'thinned') AS temporal_thinned_count, quantile_cont(brightness, 0.1) AS brightness_p10, quantile_cont(clipped_ratio, 0.9) AS clipped_ratio_p90,
  quantile_cont(sharpness, 0.5) FILTER (WHERE good) AS sharpness_p50, min(sharpness) FILTER (WHERE good) AS sharpness_min, min(raw_index) FILTER (WHERE elig) AS eligible_first_raw_index,
  max(raw_index) FILTER (WHERE reason = 'kept') AS selected_last_raw_index,
  CASE WHEN count(*) > 1 THEN CAST(printf('%.3f', CAST((max(raw_index) FILTER (WHERE reason = 'kept') - min(raw_index) FILTER (WHERE reason = 'kept')) / (count(*) - 1)::DOUBLE AS DOUBLE)) AS DOUBLE) END AS selected_raw_index_coverage
  FROM fat GROUP BY scene_id, pass_no, pass)"""
PICKED = """sco AS (SELECT *, least(raw_count, 10, 9) AS target, coalesce(selected_raw_index_coverage, 0) AS sv FROM sta),
key AS (SELECT *, kept_count >= target AS mf, raw_count <= 1 OR coalesce(selected_raw_index_coverage >= 0.9e0, false) AS ms, CASE WHEN target <= 0 THEN 1 ELSE least(1, kept_count / target::DOUBLE) END AS fr, least(1, sv / 0.9e0) AS sr FROM sco),
cho AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY mf AND ms DESC, CASE WHEN mf AND ms THEN pass_no END, (mf AND sv >= 0.9e0) DESC, least(fr, sr) DESC, sv >= 0.9e0 DESC, mf DESC, fr DESC, sr DESC, sv DESC, kept_count DESC, pass_no) AS i FROM key) t WHERE i = 1)"""


def fates(spark, d):
    return G.filter_frames(X.frame_stats(spark, d), LADDER, 10, data=None)


@query("temporal_thin", oracle("SELECT scene_id, raw_index, pass_no, reason FROM fat", LAD, FATE, views="frame_stats"))
def _(spark, d):
    return fates(spark, d).select(*KEY, "pass_no", "reason")


STAT_COLS = ["scene_id", "pass_no", "pass", "raw_count", "eligible_count", "kept_count", "skipped_blur", "skipped_bad_exposure", "temporal_thinned_count", "eligible_first_raw_index",
             "selected_last_raw_index", "selected_raw_index_coverage"]
STAT_FLOATS = ["brightness_p10", "clipped_ratio_p90", "sharpness_p50", "sharpness_min"]


@query("extraction_stats", oracle("SELECT " + ", ".join(STAT_COLS) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in STAT_FLOATS) + " FROM sta", LAD, FATE, STAT, views="frame_stats"))
def _(spark, d):
    return G.extraction_stats(fates(spark, d)).select(*STAT_COLS, *[r6(c).alias(c) for c in STAT_FLOATS])


@query("coverage_targets", oracle("SELECT scene_id, least(count(*), 60, 48) AS target_frames, 0.8e0 AS target_span FROM frame_stats GROUP BY scene_id", views="frame_stats"))
def _(spark, d):
    target, span = G.coverage_targets(F.col("n"), 60)
    return X.frame_stats(spark, d).groupBy("scene_id").agg(F.count("*").alias("n")).select("scene_id", target.alias("target_frames"), span.alias("target_span"))


@query("score_pass", oracle("SELECT scene_id, pass_no, target AS target_frames, mf AS meets_frame_target, ms AS meets_span_target, mf AND ms AS meets_target, round(least(fr, sr), 6) AS balanced FROM key",
                            LAD, FATE, STAT, PICKED, views="frame_stats"))
def _(spark, d):
    rows = G.score_pass(G.extraction_stats(fates(spark, d)), 10, 9, 0.9)
    return rows.select("scene_id", "pass_no", "target_frames", "meets_frame_target", "meets_span_target", "meets_target", r6("pass_score.balanced").alias("balanced"))


@query("choose_pass", oracle("SELECT scene_id, pass, kept_count, selected_raw_index_coverage AS span, pass <> 'strict' AS relaxed FROM cho", LAD, FATE, STAT, PICKED, views="frame_stats"))
def _(spark, d):
    rows = G.choose_pass(G.score_pass(G.extraction_stats(fates(spark, d)), 10, 9, 0.9))
    return rows.select("scene_id", "pass", "kept_count", F.col("selected_raw_index_coverage").alias("span"), "relaxed")


@query("renumber_selected", oracle("SELECT scene_id, raw_index, CAST(i AS INT) AS output_index, printf('frame_%05d', i) AS output_name FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY raw_index) - 1 AS i FROM frame_stats WHERE sharpness >= 12.5) t", views="frame_stats"))
def _(spark, d):
    return G.renumber_selected(G.blur_gate(X.frame_stats(spark, d), 12.5)).select(*KEY, "output_index", "output_name")


# ---- with pixels -----------------------------------------------------------

PLAD = [(0, "strict", 5200.0, 0.1205), (1, "coverage_1", 3380.0, 0.115)]
PLS = "lad(pass_no, pass, ms, md) AS (VALUES " + ", ".join(f"({n}, '{name}', {s!r}::DOUBLE, {dd!r}::DOUBLE)" for n, name, s, dd in PLAD) + ")"
# The greedy chain as a recursion over the sharp enough frames of each pass.
CHAIN = f"""cand AS (SELECT f.scene_id, f.raw_index, pass_no, md, pixels, row_number() OVER (PARTITION BY f.scene_id, pass_no ORDER BY f.raw_index) AS i
  FROM frames8 f JOIN hlt USING (scene_id, raw_index), lad WHERE sharpness >= ms AND {EXPOSED}),
chn AS (SELECT scene_id, pass_no, raw_index, i, true AS kept, NULL::DOUBLE AS frame_diff, pixels AS last FROM cand WHERE i = 1
  UNION ALL SELECT scene_id, pass_no, raw_index, i, frame_diff >= md, frame_diff, CASE WHEN frame_diff >= md THEN pixels ELSE last END FROM
    (SELECT c.scene_id, c.pass_no, c.raw_index, c.i, c.md, c.pixels, h.last, {DIFF.format(a='h.last', b='c.pixels')} AS frame_diff
     FROM chn h JOIN cand c ON h.scene_id = c.scene_id AND h.pass_no = c.pass_no AND c.i = h.i + 1) t)"""


def measured(spark, d):
    return P.frame_health(X.frames8(spark, d))


@query("near_dup_gate", oracle("SELECT scene_id, raw_index, pass_no, kept, round(frame_diff, 6) AS frame_diff FROM chn", PIX, PLS, CHAIN, views="frames8"))
def _(spark, d):
    rows = G.near_dup_gate(G.exposure_gate(measured(spark, d)), PLAD, chunk=16)
    return rows.select(*KEY, "pass_no", "kept", r6("frame_diff").alias("frame_diff"))


FULL = f"""allp AS (SELECT hlt.*, pass_no, pass, ms, md FROM hlt, lad),
rea AS (SELECT a.scene_id, a.raw_index, a.pass_no, a.pass, CASE WHEN NOT ({EXPOSED}) THEN 'bad_exposure' WHEN sharpness < ms THEN 'blur' WHEN NOT kept THEN 'near_duplicate' ELSE 'kept' END AS reason
  FROM allp a LEFT JOIN chn c USING (scene_id, raw_index, pass_no)),
pos AS (SELECT *, row_number() OVER (PARTITION BY scene_id, pass_no, reason ORDER BY raw_index) - 1 AS p, count_if(reason = 'kept') OVER (PARTITION BY scene_id, pass_no) AS n FROM rea),
fin AS (SELECT scene_id, raw_index, pass_no, pass, CASE WHEN reason = 'kept' AND n > 12 AND NOT list_contains(list_transform(range(12), lambda i: CAST(round_even(i * ((n-1)/11.0e0), 0) AS BIGINT)), p)
  THEN 'thinned' ELSE reason END AS reason FROM pos)"""


@query("filter_frames", oracle("SELECT scene_id, raw_index, pass_no, reason FROM fin", PIX, PLS, CHAIN, FULL, views="frames8"))
def _(spark, d):
    return G.filter_frames(measured(spark, d), PLAD, 12, chunk=16).select(*KEY, "pass_no", "reason")


ALAD = G.threshold_ladder(5200.0, 0.1205)
ALS = "lad(pass_no, pass, ms, md) AS (VALUES " + ", ".join(f"({n}, '{name}', {s!r}::DOUBLE, {dd!r}::DOUBLE)" for n, name, s, dd in ALAD) + ")"
BEST = """sm AS (SELECT scene_id, pass_no, pass, count(*) AS raw_count, count_if(reason = 'kept') AS kept_count,
  CAST(printf('%.3f', CAST((max(raw_index) FILTER (WHERE reason = 'kept') - min(raw_index) FILTER (WHERE reason = 'kept')) / (count(*) - 1)::DOUBLE AS DOUBLE)) AS DOUBLE) AS span FROM fin GROUP BY ALL),
ky AS (SELECT *, least(raw_count, 12, 11) AS target, kept_count >= least(raw_count, 12, 11) AS mf, coalesce(span >= 0.85e0, false) AS ms, least(1, kept_count / least(raw_count, 12, 11)::DOUBLE) AS fr, least(1, coalesce(span, 0) / 0.85e0) AS sr FROM sm),
ch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY (mf AND ms) DESC, CASE WHEN mf AND ms THEN pass_no END, least(fr, sr) DESC, ms DESC, mf DESC, fr DESC, sr DESC, span DESC, kept_count DESC, pass_no) AS i FROM ky) t WHERE i = 1)"""


@query("select_frames_adaptive", oracle("SELECT fin.scene_id, raw_index FROM fin JOIN ch USING (scene_id, pass_no) WHERE reason = 'kept'", PIX, ALS, CHAIN, FULL, BEST, views="frames8"))
def _(spark, d):
    return G.select_frames_adaptive(measured(spark, d), 5200.0, 0.1205, 12, 11, 0.85)[0]


@query("selection_manifest", oracle("SELECT scene_id, pass AS selected_pass, raw_count, kept_count AS selected_count, span AS selected_span, mf AND ms AS meets_target, pass <> 'strict' AS relaxed FROM ch", PIX, ALS, CHAIN, FULL, BEST, views="frames8"))
def _(spark, d):
    m = G.select_frames_adaptive(measured(spark, d), 5200.0, 0.1205, 12, 11, 0.85)[1]
    return m.select("scene_id", F.col("pass").alias("selected_pass"), "raw_count", F.col("kept_count").alias("selected_count"),
                    F.col("selected_raw_index_coverage").alias("selected_span"), "meets_target", "relaxed")


# ---- cube faces ------------------------------------------------------------

FACE = "fac(face, yaw, pitch) AS (VALUES " + ", ".join(f"('{n}', radians({y!r}::DOUBLE), radians({p!r}::DOUBLE))" for n, (y, p) in P.FACES.items()) + ")"
MAPS = """grd AS (SELECT s.* EXCLUDE (c), face, yaw, pitch, c // face_size AS r, c % face_size AS c FROM (SELECT *, unnest(range(face_size*face_size)) AS c FROM siz) s, fac),
dir AS (SELECT *, ((c+0.5e0)/face_size*2-1)*tan(radians(90.0e0)*0.5e0) AS u, -((r+0.5e0)/face_size*2-1)*tan(radians(90.0e0)*0.5e0) AS v FROM grd),
rot AS (SELECT *, u/sqrt(u*u+v*v+1) AS dx, (v*cos(pitch)-sin(pitch))/sqrt(u*u+v*v+1) AS py, (v*sin(pitch)+cos(pitch))/sqrt(u*u+v*v+1) AS pz FROM dir),
map AS (SELECT *, atan2(dx*cos(yaw)+pz*sin(yaw), pz*cos(yaw)-dx*sin(yaw))/(2*pi())+0.5e0 AS map_x, 0.5e0-asin(greatest(-1e0, least(1e0, py)))/pi() AS map_y FROM rot)"""


@query("cube_face_map", oracle("SELECT camera_id, face, CAST(r AS INT) AS row, CAST(c AS INT) AS col, round(map_x, 6) % 1.0 + 0.0 AS map_x, round(map_y, 6) + 0.0 AS map_y FROM map",
    "siz AS (SELECT camera_id, CAST(2 + camera_id % 3 AS INT) AS face_size FROM cameras_fx)", FACE, MAPS, views="cameras_fx"))
def _(spark, d):
    """Map of every camera's face size; positions are taken modulo one full turn."""
    sizes = X.cameras_fx(spark, d).select("camera_id", (2 + F.col("camera_id") % 3).cast("int").alias("face_size"))
    return P.cube_face_map(sizes).select("camera_id", "face", "row", "col", (r6("map_x") % 1.0 + 0.0).alias("map_x"), r6("map_y").alias("map_y"))


@query("expand_cube_faces")
def _(spark, d):
    """Rows only: a byte may sit on a rounding edge, where sines of two libraries differ."""
    faces = P.expand_cube_faces(X.frames8(spark, d), 4)
    return faces.select(*KEY, "face", "width", "height", F.hex("pixels").alias("pixels"))


# ---- masks and input score -------------------------------------------------

MSK = """msk AS (SELECT scene_id, raw_index, count_if(v > 127)/64.0e0 AS fg_ratio, coalesce(count_if(v > 127)/((max(c) FILTER (WHERE v > 127) - min(c) FILTER (WHERE v > 127) + 1)
  * (max(r) FILTER (WHERE v > 127) - min(r) FILTER (WHERE v > 127) + 1))::DOUBLE, 0) AS bbox_fill,
  coalesce(min(c) FILTER (WHERE v > 127) <= 2 OR min(r) FILTER (WHERE v > 127) <= 2 OR max(c) FILTER (WHERE v > 127) >= 5 OR max(r) FILTER (WHERE v > 127) >= 5, false) AS touches_edge FROM pix GROUP BY scene_id, raw_index)"""


@query("mask_stats", oracle("SELECT scene_id, raw_index, round(fg_ratio, 6) AS fg_ratio, round(bbox_fill, 6) AS bbox_fill, touches_edge FROM msk", PIX, MSK, views="frames8"))
def _(spark, d):
    return P.mask_stats(X.frames8(spark, d)).select(*KEY, r6("fg_ratio").alias("fg_ratio"), r6("bbox_fill").alias("bbox_fill"), "touches_edge")


@query("mask_summary", oracle("""SELECT scene_id, count(*) AS mask_count, round(quantile_cont(fg_ratio, 0.1), 6) AS fg_ratio_p10, round(quantile_cont(fg_ratio, 0.5), 6) AS fg_ratio_p50,
    round(quantile_cont(bbox_fill, 0.9), 6) AS bbox_fill_p90, CAST(printf('%.2f', CAST(100.0e0*count_if(touches_edge)/count(*) AS DOUBLE)) AS DOUBLE) AS edge_touch_percent FROM msk GROUP BY scene_id""", PIX, MSK, views="frames8"))
def _(spark, d):
    s = G.mask_summary(P.mask_stats(X.frames8(spark, d)))
    return s.select("scene_id", "mask_count", *[r6(c).alias(c) for c in ("fg_ratio_p10", "fg_ratio_p50", "bbox_fill_p90")], "edge_touch_percent")


@query("pair_masks", oracle("SELECT event_id, user_id AS scene_id FROM events WHERE event_id % 4 <> 1"))
def _(spark, d):
    rows = X.table(spark, d, "events").select("event_id", F.col("user_id").alias("scene_id"))
    masks = rows.withColumn("name", F.concat(F.lit("masks/frame.v"), "event_id", F.lit(".png")))
    images = rows.filter("event_id % 4 <> 1").withColumn("name", F.concat(F.lit("images/frame.v"), "event_id", F.lit(".jpg")))
    return G.pair_masks(masks, images).select("event_id", "scene_id")


SUMM = """smy AS (SELECT user_id AS scene_id, count(*) + user_id % 50 - 20 AS frame_count, avg(value) * (user_id % 9) AS sharpness_p10, CASE WHEN user_id % 11 = 0 THEN NULL ELSE (user_id % 30) / 1000.0e0 END AS diff_p50,
  (user_id % 30) / 100.0e0 AS diff_p90, user_id % 20 AS brightness_p10, 230 + user_id % 20 AS brightness_p90, user_id % 12 AS contrast_p10, (user_id % 8) / 10.0e0 AS clipped_p90,
  user_id % 3 AS mask_count, CASE WHEN user_id % 13 = 0 THEN NULL ELSE (user_id % 10) / 10.0e0 END AS fg_p50, user_id % 60 AS edge_touch_percent FROM events GROUP BY user_id)"""
SUMM_COLS = ["frame_count", "sharpness_p10", "diff_p50", "diff_p90", "brightness_p10", "brightness_p90", "contrast_p10", "clipped_p90", "mask_count", "fg_p50", "edge_touch_percent"]


@query("score_inputs", oracle("""SELECT scene_id, greatest(0, least(100, 100 - CASE WHEN frame_count < 48 THEN 20 WHEN frame_count < 90 THEN 8 ELSE 0 END - CASE WHEN sharpness_p10 < 35 THEN 18 WHEN sharpness_p10 < 80 THEN 8 ELSE 0 END
    - CASE WHEN diff_p50 < 0.015e0 THEN 10 ELSE 0 END - CASE WHEN diff_p90 > 0.22e0 THEN 12 ELSE 0 END - CASE WHEN brightness_p10 < 12 OR brightness_p90 > 243 THEN 10 ELSE 0 END
    - CASE WHEN contrast_p10 < 5 THEN 10 ELSE 0 END - CASE WHEN clipped_p90 > 0.55e0 THEN 8 ELSE 0 END - CASE WHEN mask_count = 0 THEN 12 ELSE CASE WHEN coalesce(fg_p50, 0) < 0.08e0 THEN 14 ELSE 0 END
    + CASE WHEN coalesce(fg_p50, 1) > 0.75e0 THEN 14 ELSE 0 END + CASE WHEN edge_touch_percent > 35 THEN 10 ELSE 0 END END)) AS score,
    list_filter([CASE WHEN frame_count < 48 THEN 'low_frame_count' END, CASE WHEN sharpness_p10 < 35 THEN 'blurry_frames' END, CASE WHEN diff_p50 < 0.015e0 THEN 'near_duplicate_frames' END,
      CASE WHEN diff_p90 > 0.22e0 THEN 'large_view_jumps_or_exposure_changes' END, CASE WHEN brightness_p10 < 12 OR brightness_p90 > 243 THEN 'bad_exposure_frames' END, CASE WHEN contrast_p10 < 5 THEN 'low_contrast_frames' END,
      CASE WHEN clipped_p90 > 0.55e0 THEN 'clipped_frames' END, CASE WHEN mask_count > 0 AND coalesce(fg_p50, 0) < 0.08e0 THEN 'mask_too_small' END, CASE WHEN mask_count > 0 AND coalesce(fg_p50, 1) > 0.75e0 THEN 'mask_too_large' END,
      CASE WHEN mask_count > 0 AND edge_touch_percent > 35 THEN 'mask_touches_edges' END, CASE WHEN mask_count = 0 THEN 'missing_masks' END], lambda v: v IS NOT NULL) AS problems FROM smy""", SUMM))
def _(spark, d):
    k = F.col("user_id")
    rows = X.table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.avg("value").alias("v")).select(
        k.alias("scene_id"), (F.col("n") + k % 50 - 20).alias("frame_count"), (F.col("v") * (k % 9)).alias("sharpness_p10"), F.when(k % 11 != 0, (k % 30) / 1000.0).alias("diff_p50"),
        ((k % 30) / 100.0).alias("diff_p90"), (k % 20).alias("brightness_p10"), (230 + k % 20).alias("brightness_p90"), (k % 12).alias("contrast_p10"), ((k % 8) / 10.0).alias("clipped_p90"),
        (k % 3).alias("mask_count"), F.when(k % 13 != 0, (k % 10) / 10.0).alias("fg_p50"), (k % 60).alias("edge_touch_percent"))
    return G.score_inputs(rows).select("scene_id", "score", "problems")


@query("assess_scene", oracle("""SELECT scene_id, frame_count, sampled_count, round(sharpness_p10, 6) AS sharpness_p10, round(diff_p50, 6) AS diff_p50, round(brightness_p90, 8) AS brightness_p90, round(fg_p50, 6) AS fg_p50, mask_count, edge_touch_percent,
      greatest(0, 100 - CASE WHEN frame_count < 48 THEN 20 WHEN frame_count < 90 THEN 8 ELSE 0 END - CASE WHEN sharpness_p10 < 35 THEN 18 WHEN sharpness_p10 < 80 THEN 8 ELSE 0 END - CASE WHEN diff_p50 < 0.015e0 THEN 10 ELSE 0 END
      - CASE WHEN diff_p90 > 0.22e0 THEN 12 ELSE 0 END - CASE WHEN brightness_p10 < 12 OR brightness_p90 > 243 THEN 10 ELSE 0 END - CASE WHEN contrast_p10 < 5 THEN 10 ELSE 0 END - CASE WHEN clipped_p90 > 0.55e0 THEN 8 ELSE 0 END
      - CASE WHEN fg_p50 < 0.08e0 THEN 14 ELSE 0 END - CASE WHEN fg_p50 > 0.75e0 THEN 14 ELSE 0 END - CASE WHEN edge_touch_percent > 35 THEN 10 ELSE 0 END) AS score
    FROM cnt JOIN met USING (scene_id) JOIN (SELECT scene_id, quantile_cont(fg_ratio, 0.5) AS fg_p50, CAST(printf('%.2f', CAST(100.0e0*count_if(touches_edge)/count(*) AS DOUBLE)) AS DOUBLE) AS edge_touch_percent FROM smp JOIN msk USING (scene_id, raw_index) GROUP BY scene_id) m USING (scene_id)""",
    PIX, MSK, "cnt AS (SELECT scene_id, count(*) AS frame_count, count(*) AS mask_count FROM frames8 GROUP BY scene_id)",
    "smp AS (SELECT f.*, row_number() OVER (PARTITION BY scene_id ORDER BY raw_index) AS i FROM frames8 f JOIN cnt USING (scene_id) WHERE raw_index % greatest(1, CAST(ceil(frame_count / 20.0e0) AS BIGINT)) = 0)",
    f"dif AS (SELECT a.scene_id, a.raw_index, {DIFF.format(a='a.pixels', b='b.pixels')} AS frame_diff FROM smp a LEFT JOIN smp b ON a.scene_id = b.scene_id AND a.i = b.i + 1)",
    """met AS (SELECT scene_id, count(*) AS sampled_count, quantile_cont(sharpness, 0.1) AS sharpness_p10, quantile_cont(frame_diff, 0.5) AS diff_p50, quantile_cont(frame_diff, 0.9) AS diff_p90, quantile_cont(brightness, 0.1) AS brightness_p10,
      quantile_cont(brightness, 0.9) AS brightness_p90, quantile_cont(contrast, 0.1) AS contrast_p10, quantile_cont(clipped_ratio, 0.9) AS clipped_p90 FROM dif JOIN hlt USING (scene_id, raw_index) GROUP BY scene_id)""", views="frames8"))
def _(spark, d):
    frames = X.frames8(spark, d)
    rows = G.assess_scene(frames, frames, max_frames=20)
    return rows.select("scene_id", "frame_count", "sampled_count", *[r6(c).alias(c) for c in ("sharpness_p10", "diff_p50", "fg_p50")], F.round("brightness_p90", 8).alias("brightness_p90"), "mask_count", "edge_touch_percent", "score")


@query("crop_window", oracle("""SELECT model_id, l AS left, t AS top, l + cw AS right, t + ch AS bottom FROM (SELECT *, greatest(0, least(w - cw, CAST(round_even((x0+x1)*0.5e0 - cw*0.5e0, 0) AS INT))) AS l, greatest(0, least(h - ch, CAST(round_even((y0+y1)*0.5e0 - ch*0.52e0, 0) AS INT))) AS t FROM
    (SELECT *, least(w, CAST(round_even(s, 0) AS INT)) AS cw, least(h, CAST(round_even(s*1.15e0, 0) AS INT)) AS ch FROM (SELECT *, greatest(x1-x0, y1-y0)*1.36e0 AS s FROM box) a) b) c""",
    """box AS (SELECT model_id, quantile_cont(cx-180-camera_id%50, 0.15) AS x0, quantile_cont(cy-170-camera_id%40, 0.15) AS y0, quantile_cont(cx+190+camera_id%30, 0.85) AS x1, quantile_cont(cy+150+camera_id%60, 0.85) AS y1,
      CAST(max(width) AS INT) AS w, CAST(max(height) AS INT) AS h FROM cameras_fx GROUP BY model_id)""", views="cameras_fx"))
def _(spark, d):
    k = F.col("camera_id")
    boxes = X.cameras_fx(spark, d).select("model_id", (F.col("cx") - 180 - k % 50).alias("x0"), (F.col("cy") - 170 - k % 40).alias("y0"), (F.col("cx") + 190 + k % 30).alias("x1"), (F.col("cy") + 150 + k % 60).alias("y1"), "width", "height")
    return G.crop_window(boxes, keys=("model_id",))


@query("temporal_chunks", oracle("""SELECT scene_id, CAST(chunk AS INT) AS chunk, list_concat(f, list_transform(range(7 - len(f)), lambda i: f[len(f)])) AS frames, CAST(len(f) AS INT) AS real_count FROM
    (SELECT scene_id, raw_index // 7 AS chunk, list(raw_index ORDER BY raw_index) AS f FROM frame_stats GROUP BY ALL) t""", views="frame_stats"))
def _(spark, d):
    return G.temporal_chunks(X.frame_stats(spark, d), 7)


@query("image_pair_metrics", oracle("""SELECT scene_id, raw_index, round(-10*log10(greatest(1e-10, mse)), 6) AS psnr, round(l1, 6) AS l1 FROM (SELECT a.scene_id, a.raw_index, avg(pow((a.v-b.v)/255.0e0, 2)) AS mse,
    sum(abs(a.v-b.v)/255.0e0 * w)/greatest(sum(w), 1e-6) AS l1 FROM (SELECT *, CASE WHEN v > 127 THEN 1.0e0 ELSE 0.05e0 END AS w FROM pix) a JOIN pix b ON a.scene_id = b.scene_id AND a.p = b.p AND b.raw_index = a.raw_index + 1 GROUP BY a.scene_id, a.raw_index) t""", PIX, views="frames8"))
def _(spark, d):
    frames = X.frames8(spark, d)
    truth = frames.select("scene_id", (F.col("raw_index") - 1).alias("raw_index"), F.col("pixels").alias("truth"))
    pairs = frames.withColumnRenamed("pixels", "render").join(truth, ["scene_id", "raw_index"])
    pairs = pairs.withColumn("mask", F.transform("render", lambda v: (v > 127).cast("int")))
    return P.image_pair_metrics(pairs, mask="mask").select(*KEY, r6("psnr").alias("psnr"), r6("l1").alias("l1"))


@query("blank_image_check", oracle("""SELECT scene_id, raw_index, CAST(printf('%.4f', CAST(count_if(v < 245)/64.0e0 AS DOUBLE)) AS DOUBLE) AS non_white_ratio, CAST(printf('%.4f', CAST(count_if(v > 10)/64.0e0 AS DOUBLE)) AS DOUBLE) AS non_black_ratio, stddev_pop(v) > 3 AS varied,
    list_filter([CASE WHEN NOT stddev_pop(v) > 3 THEN 'screenshot has too little pixel variation' END, CASE WHEN count_if(v < 245)/64.0e0 < 0.05 THEN 'screenshot appears mostly white/blank' END, CASE WHEN count_if(v > 10)/64.0e0 < 0.05 THEN 'screenshot appears mostly black/blank' END], lambda q: q IS NOT NULL) AS problems
    FROM (SELECT scene_id, raw_index, CASE raw_index % 10 WHEN 3 THEN 250 + v % 2 WHEN 4 THEN v % 3 ELSE v END AS v FROM pix) t GROUP BY scene_id, raw_index""", PIX, views="frames8"))
def _(spark, d):
    frames = X.frames8(spark, d)
    k = F.col("raw_index") % 10
    odd = F.when(k == 3, F.transform("pixels", lambda v: (250 + v % 2).cast("int"))).when(k == 4, F.transform("pixels", lambda v: (v % 3).cast("int"))).otherwise(F.col("pixels"))
    return P.blank_image_check(frames.withColumn("pixels", odd)).select(*KEY, "non_white_ratio", "non_black_ratio", "varied", "problems")


@query("running_psnr", oracle("SELECT scene_id, raw_index, round(list_reduce(l, lambda a, b: 0.9e0*a + 0.1e0*b), 6) AS running_psnr, best_psnr FROM seq",
    """seq AS (SELECT scene_id, raw_index, list(sharpness) OVER w AS l, max(sharpness) OVER w AS best_psnr FROM frame_stats WINDOW w AS (PARTITION BY scene_id ORDER BY raw_index))""", views="frame_stats"))
def _(spark, d):
    rows = G.running_psnr(X.frame_stats(spark, d), "sharpness", order="raw_index")
    return rows.select(*KEY, r6("running_psnr").alias("running_psnr"), "best_psnr")


@query("apply_image_model")
def _(spark, d):
    """Rows only: inverts every frame; frames whose first level is below 40 make the function fail and stay as they were."""
    def load():
        def invert(image):
            if image[0, 0] < 40:
                raise ValueError("too dark")
            return 255 - image
        return invert
    rows = P.apply_image_model(X.frames8(spark, d), load)
    return rows.select(*KEY, "width", "height", F.hex("pixels").alias("pixels"), "status")


@query("apply_image_model_temporal")
def _(spark, d):
    """Rows only: averages runs of five frames."""
    def load():
        return lambda images: [sum(i.astype("float64") for i in images) / len(images)] * len(images)
    rows = P.apply_image_model(X.frames8(spark, d), load, chunk=5)
    return rows.select(*KEY, F.hex("pixels").alias("pixels"), "status")
