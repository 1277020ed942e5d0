"""Delivery, page-asset and capture-scope queries, with DuckDB twins.

Orders play deliveries and their lines the files of a folder; web pages get a
viewer tail built from their own id, since the raw ones reference no assets.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import delivery as D
from . import fixtures as X
from .fixtures import oracle
from .registry import query

NAMES = "['START_HERE.html', 'preview.html', 'diagnostics.json', 'manifest.json', 'index.js', 'index.css', 'settings.json']"
LISTING = f"""lst AS (SELECT DISTINCT l_orderkey AS delivery, {NAMES}[l_linenumber] AS name, 100 AS bytes FROM lineitem
  UNION ALL SELECT DISTINCT l_orderkey, 'scene_' || l_orderkey || '.sog', 200 FROM lineitem WHERE l_orderkey % 3 <> 0
  UNION ALL SELECT DISTINCT l_orderkey, 's' || l_orderkey || '_high_quality.ply', 300 FROM lineitem WHERE l_orderkey % 5 <> 0)"""
DELIV = """dlv AS (SELECT o_orderkey AS delivery, o_orderkey % 2 = 0 AS manifest_present, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 8 = 0 WHEN o_orderkey % 6 = 0 THEN NULL ELSE true END AS manifest_ok,
  CASE WHEN o_orderkey % 10 = 0 THEN 'other.sog' END AS manifest_sog, 'load scene_' || o_orderkey || '.sog and index.css' || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ' settings.json' END AS preview_text,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'open scene_' || o_orderkey || '.sog' END AS start_text, o_orderkey % 3 = 1 AS diagnostics_present, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 = 1 END AS diagnostics_ok FROM orders)"""
VALID = """fnd AS (SELECT delivery, list(name) AS names, min(name) FILTER (WHERE name LIKE '%.sog') AS fs, min(name) FILTER (WHERE name LIKE '%_high_quality.ply') AS fp FROM lst GROUP BY delivery),
exp AS (SELECT d.*, coalesce(names, []) AS names, coalesce(nullif(manifest_sog, ''), fs, '') AS sog, coalesce(fp, '') AS ply FROM dlv d LEFT JOIN fnd USING (delivery)),
prb AS (SELECT delivery, sog, ply, list_filter(list_concat([CASE WHEN manifest_present AND manifest_ok IS NULL THEN 'manifest unreadable' END, CASE WHEN manifest_present AND NOT manifest_ok THEN 'manifest ok is not true' END,
  CASE WHEN sog = '' THEN 'missing SOG asset' END, CASE WHEN ply = '' THEN 'missing high-quality PLY asset' END],
  list_transform(""" + NAMES + """, lambda n: CASE WHEN NOT list_contains(names, n) THEN 'missing ' || n END),
  [CASE WHEN sog <> '' AND NOT list_contains(names, sog) THEN 'missing ' || sog END, CASE WHEN ply <> '' AND NOT list_contains(names, ply) THEN 'missing ' || ply END,
   CASE WHEN list_contains(names, 'preview.html') AND NOT contains(preview_text, sog) THEN 'preview.html does not reference ' || sog END,
   CASE WHEN list_contains(names, 'preview.html') AND NOT contains(preview_text, 'settings.json') THEN 'preview.html does not reference settings.json' END,
   CASE WHEN list_contains(names, 'START_HERE.html') AND sog <> '' AND NOT contains(start_text, sog) THEN 'START_HERE.html does not reference ' || sog END,
   CASE WHEN diagnostics_present AND diagnostics_ok IS NULL THEN 'diagnostics unreadable' END, CASE WHEN diagnostics_present AND NOT diagnostics_ok THEN 'diagnostics ok is not true' END]), lambda v: v IS NOT NULL) AS problems FROM exp)"""


def listing(spark, d):
    lines = X.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("delivery"), "l_linenumber").distinct()
    base = F.element_at(F.array(*[F.lit(n) for n in D.BASE_REQUIRED]), F.col("l_linenumber"))
    orders = lines.select("delivery").distinct()
    return (lines.select("delivery", base.alias("name"), F.lit(100).alias("bytes"))
            .unionByName(orders.filter("delivery % 3 <> 0").select("delivery", F.concat(F.lit("scene_"), "delivery", F.lit(".sog")).alias("name"), F.lit(200).alias("bytes")))
            .unionByName(orders.filter("delivery % 5 <> 0").select("delivery", F.concat(F.lit("s"), "delivery", F.lit("_high_quality.ply")).alias("name"), F.lit(300).alias("bytes"))))


def deliveries(spark, d):
    k = F.col("delivery")
    rows = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("delivery"))
    name = F.concat(F.lit("scene_"), "delivery", F.lit(".sog"))
    return rows.select(
        "delivery", (k % 2 == 0).alias("manifest_present"), F.when(k % 4 == 0, k % 8 == 0).when(k % 6 == 0, F.lit(None)).otherwise(F.lit(True)).alias("manifest_ok"),
        F.when(k % 10 == 0, "other.sog").alias("manifest_sog"), F.lit(None).cast("string").alias("manifest_ply"),
        F.concat(F.lit("load "), name, F.lit(" and index.css"), F.when(k % 7 == 0, "").otherwise(" settings.json")).alias("preview_text"),
        F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("open "), name)).alias("start_text"),
        (k % 3 == 1).alias("diagnostics_present"), F.when(k % 5 != 0, k % 2 == 1).alias("diagnostics_ok"))


@query("validate_delivery", oracle("SELECT delivery, sog, ply, problems, len(problems) = 0 AS ok FROM prb", LISTING, DELIV, VALID))
def _(spark, d):
    return D.validate_delivery(deliveries(spark, d), listing(spark, d))


PATHS = "['clean_output/clean_opa0.10_standard.ply', 'clean_output/b_standard.ply', 'delivery/professional/x_standard.ply', 'web.sog', 'a.splat', 'delivery/web/splat/z.splat', 'x_high_quality.ply']"
ASSETS = f"""pth AS (SELECT DISTINCT l_orderkey AS delivery, {PATHS}[l_linenumber] AS path, 1000 * l_linenumber AS bytes FROM lineitem),
agg AS (SELECT delivery, list(path) AS p, bool_or(starts_with(path, 'clean_output/')) AS work FROM pth GROUP BY delivery),
asd AS (SELECT o_orderkey AS delivery, coalesce(p, []) AS p, CASE WHEN o_orderkey % 5 = 0 THEN 'delivery' WHEN coalesce(work, false) THEN 'workspace' ELSE 'flat_output' END AS kind FROM orders LEFT JOIN agg ON delivery = o_orderkey),
nam AS (SELECT *, CASE WHEN kind = 'delivery' THEN list_filter(['clean_output/b_standard.ply'], lambda v: list_contains(p, v)) WHEN kind = 'workspace' THEN
   list_filter(['clean_output/clean_opa0.10_standard.ply', 'clean_output/b_standard.ply', 'delivery/professional/x_standard.ply'], lambda v: list_contains(p, v))
   ELSE list_filter(['x_high_quality.ply'], lambda v: list_contains(p, v)) END[1] AS ply,
  CASE WHEN kind <> 'delivery' AND list_contains(p, 'web.sog') THEN 'web.sog' END AS sog,
  CASE WHEN kind = 'workspace' THEN list_filter(['a.splat', 'delivery/web/splat/z.splat'], lambda v: list_contains(p, v))[1] END AS splat FROM asd)"""
ASSETS_OUT = f"""delivery, kind, ply, 1000 * list_position({PATHS}, ply) AS ply_bytes, sog, 1000 * list_position({PATHS}, sog) AS sog_bytes, splat, 1000 * list_position({PATHS}, splat) AS splat_bytes"""


def folders(spark, d):
    paths = [p.strip(" '") for p in PATHS.strip("[]").split(",")]
    at = F.element_at(F.array(*[F.lit(p) for p in paths]), F.col("l_linenumber"))
    files = X.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("delivery"), at.alias("path"), (F.col("l_linenumber") * 1000).alias("bytes")).distinct()
    rows = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("delivery"), (F.col("o_orderkey") % 5 == 0).alias("manifest_has_files"),
                                              F.when(F.col("o_orderkey") % 5 == 0, "clean_output/b_standard.ply").alias("manifest_ply"))
    return rows, files


@query("resolve_assets", oracle(f"SELECT {ASSETS_OUT} FROM nam", ASSETS))
def _(spark, d):
    return D.resolve_assets(*folders(spark, d))


SCORE = """sin AS (SELECT o_orderkey AS delivery, o_orderkey % 4 <> 0 AS validation_ok, CASE WHEN o_orderkey % 4 = 0 THEN ['missing index.js', 'missing index.css'] ELSE [] END AS vp,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(floor(o_totalprice * 40) AS BIGINT) END AS web_bytes, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(floor(o_totalprice * 90) AS BIGINT) END AS ply_bytes,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS point_count, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 41) / 1.5e0 END AS radius_p99,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 11 <> 0 END AS diagnostics_ok FROM orders),
spr AS (SELECT *, coalesce(web_bytes / 1048576.0e0, 0) AS web, list_filter(list_concat(vp, [CASE WHEN web_bytes IS NULL THEN 'missing web asset' END, CASE WHEN ply_bytes IS NULL THEN 'missing PLY file' END,
  CASE WHEN coalesce(web_bytes / 1048576.0e0, 0) > 12 THEN printf('SOG is larger than mobile budget (%.1fMB > 12.0MB)', web_bytes / 1048576.0e0) END,
  CASE WHEN coalesce(point_count, 0) < 120000 THEN 'point count is too low (' || coalesce(point_count, 0) || ' < 120000)' END,
  CASE WHEN ply_bytes IS NOT NULL AND NOT diagnostics_ok THEN 'PLY diagnostics failed' END]), lambda v: v IS NOT NULL) AS problems FROM sin),
sco AS (SELECT delivery, problems, len(problems) = 0 AS ok, CAST(printf('%.2f', CAST(web AS DOUBLE)) AS DOUBLE) AS sog_mb, CAST(printf('%.2f', CAST(coalesce(ply_bytes / 1048576.0e0, 0) AS DOUBLE)) AS DOUBLE) AS ply_mb,
  greatest(0, 100 - CASE WHEN validation_ok THEN 0 ELSE 40 END - CASE WHEN web > 12 THEN 20 ELSE 0 END - CASE WHEN coalesce(point_count, 0) < 120000 THEN 20 ELSE 0 END
  - CASE WHEN coalesce(radius_p99 > 20, false) THEN 10 ELSE 0 END - least(10, len(problems) * 3)) AS score FROM spr)"""


def scored(spark, d):
    k = F.col("o_orderkey")
    size = lambda n: F.floor(F.col("o_totalprice") * n)
    rows = X.table(spark, d, "orders").select(
        k.alias("delivery"), F.col("o_custkey").alias("config"), (k % 4 != 0).alias("validation_ok"),
        F.when(k % 4 == 0, F.array(F.lit("missing index.js"), F.lit("missing index.css"))).otherwise(F.array().cast("array<string>")).alias("validation_problems"),
        F.when(k % 9 != 0, size(40)).alias("web_bytes"), F.when(k % 7 != 0, size(90)).alias("ply_bytes"), F.when(k % 7 != 0, F.floor("o_totalprice")).alias("point_count"),
        F.when(k % 7 != 0, (k % 41) / 1.5).alias("radius_p99"), F.when(k % 7 != 0, k % 11 != 0).alias("diagnostics_ok"))
    return D.score_delivery(rows)


@query("score_delivery", oracle("SELECT * FROM sco", SCORE))
def _(spark, d):
    return scored(spark, d).select("delivery", "problems", "ok", "sog_mb", "ply_mb", "score")


@query("benchmark_gates", oracle("""SELECT o_custkey AS config, bool_and(ok AND score >= 85) AS ok, count(*) AS scene_count, count_if(score >= 85) AS meeting
    FROM sco JOIN orders ON o_orderkey = delivery GROUP BY o_custkey""", SCORE))
def _(spark, d):
    gated = D.benchmark_gates(scored(spark, d))
    meeting = gated.groupBy("config").agg(F.count_if("meets_min_score").alias("meeting"))
    return D.benchmark_verdict(gated, "config").join(meeting, "config")


# ---- page assets -----------------------------------------------------------

TAIL = """pgs AS (SELECT page_id, url, html || '<link rel="stylesheet" href="css/' || page_id || '/index.css"><link rel="icon" href="i.png"><SCRIPT type=module src=''/js/p' || page_id || '.js''></SCRIPT>'
  || '<script src="https://cdn.example.com/lib.js"></script><script src="data:text/plain,x"></script><link href="//h.example.com/m' || page_id || '.css" rel=modulepreload>'
  || CASE WHEN page_id % 3 = 0 THEN '<script>fetch("scene' || page_id || '.sog"); load("../cfg/settings.json")</script>' ELSE '<script>fetch(''./a/b.json'')</script>' END AS html FROM pages)"""
JOINED = r"""ref AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS host, regexp_extract(url, '^([a-z]+:)', 1) AS scheme,
  regexp_replace(regexp_replace(substr(url, 1 + length(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1))), '[?#].*$', ''), '[^/]*$', '') AS folder FROM pages),
ast AS (SELECT page_id, host || folder || 'css/' || page_id || '/index.css' AS asset FROM ref UNION SELECT page_id, host || '/js/p' || page_id || '.js' FROM ref
  UNION SELECT page_id, 'https://cdn.example.com/lib.js' FROM ref UNION SELECT page_id, scheme || '//h.example.com/m' || page_id || '.css' FROM ref
  UNION SELECT page_id, host || folder || 'scene' || page_id || '.sog' FROM ref WHERE page_id % 3 = 0
  UNION SELECT page_id, host || regexp_replace(folder, '[^/]+/$', '') || 'cfg/settings.json' FROM ref WHERE page_id % 3 = 0
  UNION SELECT page_id, host || folder || 'a/b.json' FROM ref WHERE page_id % 3 <> 0)"""


def viewer_pages(spark, d):
    k = F.col("page_id").cast("string")
    more = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<script>fetch("scene'), k, F.lit('.sog"); load("../cfg/settings.json")</script>'))).otherwise("<script>fetch('./a/b.json')</script>")
    tail = F.concat(F.lit('<link rel="stylesheet" href="css/'), k, F.lit('/index.css"><link rel="icon" href="i.png"><SCRIPT type=module src=\'/js/p'), k, F.lit(".js'></SCRIPT>"),
                    F.lit('<script src="https://cdn.example.com/lib.js"></script><script src="data:text/plain,x"></script><link href="//h.example.com/m'), k,
                    F.lit('.css" rel=modulepreload>'), more)
    return X.table(spark, d, "pages").select("page_id", "url", F.concat("html", tail).alias("html"))


@query("extract_page_assets", oracle("SELECT page_id, asset FROM ast", JOINED))
def _(spark, d):
    return D.extract_page_assets(viewer_pages(spark, d))


@query("missing_page_assets", oracle("SELECT page_id, unnest(['.sog', 'settings.json']) AS missing FROM pages WHERE page_id % 3 <> 0"))
def _(spark, d):
    pages = viewer_pages(spark, d)
    return D.missing_page_assets(pages, D.extract_page_assets(pages))


# ---- capture metadata ------------------------------------------------------

@query("classify_projection", oracle("""SELECT camera_id, CASE WHEN a BETWEEN 1.85e0 AND 2.15e0 THEN 'equirectangular' ELSE 'perspective' END AS projection,
    CASE WHEN a BETWEEN 1.85e0 AND 2.15e0 THEN 'cubemap_frames' ELSE 'perspective_frames' END AS reconstruction_mode,
    CASE WHEN a BETWEEN 1.85e0 AND 2.15e0 THEN 'auto-detected 2:1-ish aspect ratio (' ELSE 'auto-detected non-2:1 aspect ratio (' END || printf('%.2f', a) || ')' AS reason
    FROM (SELECT camera_id, (width + camera_id % 300) / height::DOUBLE AS a FROM cameras_fx) t""", views="cameras_fx"))
def _(spark, d):
    rows = X.cameras_fx(spark, d).withColumn("width", F.col("width") + F.col("camera_id") % 300)
    return D.classify_projection(rows).select("camera_id", "projection", "reconstruction_mode", "reason")
