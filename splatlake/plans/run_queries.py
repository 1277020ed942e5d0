"""Run-table queries over the `runs` fixture, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diagnostics as D, runs as R
from . import fixtures as X
from .fixtures import oracle
from .registry import query

ROUND3 = "CAST(printf('%.3f', CAST(selected_count / target_frames::DOUBLE AS DOUBLE)) AS DOUBLE)"
# Summary rows built from the fixture: flags and problem texts follow from the run's own numbers.
SUM = f"""rc AS (SELECT run_id, sweep_id, concat('run_', run_id) AS output_name, ok, score, point_count, best_psnr, train_sec, effective_mode AS sr_mode,
  CASE WHEN effective_mode = 'off' THEN '1' ELSE '2' END AS sr_effective_scale,
  CASE WHEN run_id % 19 = 0 THEN 'model_worker_failed_copied_originals' ELSE 'done' END AS sr_status,
  requested_mode <> effective_mode OR run_id % 19 = 0 AS sr_fallback,
  {ROUND3} AS extraction_coverage_ratio, {ROUND3} >= 1 AS extraction_meets_target,
  CASE WHEN run_id % 23 = 0 THEN NULL ELSE span END AS extraction_temporal_coverage, CASE WHEN run_id % 17 = 0 THEN 0.6e0 END AS extraction_temporal_target,
  registered_ratio AS colmap_registered_ratio, CASE WHEN run_id % 3 = 0 THEN registered_ratio >= 0.5e0 END AS colmap_meets_quality_target,
  selected_count % 4 = 0 AS extraction_relaxed,
  list_filter([CASE WHEN run_id % 6 = 0 THEN 'clipped_frames' END, CASE WHEN run_id % 10 = 0 THEN 'low_contrast_frames' END], lambda v: v IS NOT NULL) AS sr_risk_flags,
  list_filter([CASE WHEN point_count < 120000 THEN concat('point count is too low (', point_count, ' < 120000)') END,
    CASE WHEN score % 9 = 0 THEN 'missing web asset' END, CASE WHEN score % 8 = 0 THEN 'SOG is larger than mobile budget (13.0MB > 12.0MB)' END], lambda v: v IS NOT NULL) AS problems
  FROM runs)"""
RANKS = """low AS (SELECT *, coalesce(NOT extraction_meets_target, false) AS low_cov, coalesce(extraction_temporal_coverage < coalesce(extraction_temporal_target, 0.8e0), false) AS low_span,
  coalesce(NOT colmap_meets_quality_target, false) OR coalesce(colmap_registered_ratio < 0.45e0, false) AS low_col FROM rc),
rk AS (SELECT *, CASE WHEN extraction_meets_target IS NULL THEN 1 WHEN extraction_meets_target THEN 2 ELSE 0 END AS coverage_rank,
  CASE WHEN extraction_temporal_coverage IS NULL THEN 1 WHEN extraction_temporal_coverage >= coalesce(extraction_temporal_target, 0.8e0) THEN 2 ELSE 0 END AS temporal_rank,
  CASE WHEN colmap_meets_quality_target IS NOT NULL THEN CASE WHEN colmap_meets_quality_target THEN 2 ELSE 0 END WHEN colmap_registered_ratio IS NULL THEN 1
       WHEN colmap_registered_ratio >= 0.45e0 THEN 2 ELSE 0 END AS colmap_rank FROM low)"""
SORTED = "coverage_rank DESC, temporal_rank DESC, colmap_rank DESC, score DESC, point_count DESC, run_id"


def summaries(spark, d):
    mod = lambda n: F.col("run_id") % n == 0
    rows = X.runs(spark, d).withColumn("sr_status", F.when(mod(19), "model_worker_failed_copied_originals").otherwise("done"))
    ratio = R.coverage_ratio()
    return rows.select(
        "run_id", "sweep_id", F.concat(F.lit("run_"), "run_id").alias("output_name"), "ok", "score", "point_count", "best_psnr", "train_sec",
        F.col("effective_mode").alias("sr_mode"), F.when(F.col("effective_mode") == "off", "1").otherwise("2").alias("sr_effective_scale"), "sr_status",
        R.is_fallback("requested_mode", "effective_mode", "sr_status").alias("sr_fallback"),
        ratio.alias("extraction_coverage_ratio"), (ratio >= 1).alias("extraction_meets_target"),
        F.when(~mod(23), F.col("span")).alias("extraction_temporal_coverage"), F.when(mod(17), 0.6).alias("extraction_temporal_target"),
        F.col("registered_ratio").alias("colmap_registered_ratio"), F.when(mod(3), F.col("registered_ratio") >= 0.5).alias("colmap_meets_quality_target"),
        (F.col("selected_count") % 4 == 0).alias("extraction_relaxed"),
        R.problem_list(F.when(mod(6), "clipped_frames"), F.when(mod(10), "low_contrast_frames")).alias("sr_risk_flags"),
        R.problem_list(F.when(F.col("point_count") < 120000, F.concat(F.lit("point count is too low ("), "point_count", F.lit(" < 120000)"))),
                       F.when(F.col("score") % 9 == 0, "missing web asset"),
                       F.when(F.col("score") % 8 == 0, "SOG is larger than mobile budget (13.0MB > 12.0MB)")).alias("problems"))


@query("coverage_ratio", oracle(f"SELECT run_id, {ROUND3} AS coverage_ratio FROM runs", views="runs"))
def _(spark, d):
    return X.runs(spark, d).select("run_id", R.coverage_ratio().alias("coverage_ratio"))


@query("selected_pass", oracle("""SELECT run_id, CASE requested_mode WHEN 'off' THEN span WHEN 'resize' THEN registered_ratio END AS span,
    CASE requested_mode WHEN 'off' THEN selected_count WHEN 'resize' THEN score END AS thinned FROM runs""", views="runs"))
def _(spark, d):
    one = lambda n, span, thin: F.struct(F.lit(n).alias("name"), F.col(span).alias("span"), F.col(thin).alias("thinned"))
    rows = X.runs(spark, d).withColumns({"passes": F.array(one("off", "span", "selected_count"), one("resize", "registered_ratio", "score")),
                                         "selected_pass": F.col("requested_mode")})
    found = R.selected_pass()
    return rows.select("run_id", found["span"].alias("span"), found["thinned"].alias("thinned"))


@query("is_fallback", oracle("SELECT run_id, sr_fallback FROM rc", SUM, views="runs"))
def _(spark, d):
    return summaries(spark, d).select("run_id", "sr_fallback")


@query("run_ranks", oracle("SELECT run_id, coverage_rank, temporal_rank, colmap_rank FROM rk", SUM, RANKS, views="runs"))
def _(spark, d):
    return R.with_ranks(summaries(spark, d)).select("run_id", "coverage_rank", "temporal_rank", "colmap_rank")


@query("rank_runs", oracle(f"SELECT sweep_id, run_id, row_number() OVER (PARTITION BY sweep_id ORDER BY {SORTED}) AS run_rank FROM rk", SUM, RANKS, views="runs"))
def _(spark, d):
    return R.rank_runs(summaries(spark, d)).select("sweep_id", "run_id", "run_rank")


@query("recommend_run", oracle("""SELECT sweep_id, run_id AS recommended_run, score, best_psnr, point_count,
    CASE WHEN low_cov THEN 'coverage' WHEN low_span THEN 'span' WHEN low_col THEN 'colmap' ELSE 'best' END AS weakness FROM
    (SELECT *, row_number() OVER (PARTITION BY sweep_id ORDER BY ok DESC, coverage_rank DESC, temporal_rank DESC, colmap_rank DESC, score DESC, coalesce(best_psnr, -1) DESC,
     point_count DESC, train_sec, run_id) AS i FROM rk) t WHERE i = 1""", SUM, RANKS, views="runs"))
def _(spark, d):
    why = F.col("recommended_reason")
    weakness = (F.when(why.contains("coverage target was missed"), "coverage").when(why.contains("part of the source timeline"), "span")
                .when(why.contains("COLMAP registered too few"), "colmap").otherwise("best"))
    return R.recommend_run(summaries(spark, d)).withColumn("weakness", weakness).drop("recommended_reason")


@query("sweep_counts", oracle("""SELECT sweep_id, count(*) AS run_count, count_if(sr_fallback) AS fallback_count, count_if(low_cov) AS low_coverage_count,
    count_if(low_span) AS low_temporal_coverage_count, count_if(low_col) AS low_colmap_count, count_if(extraction_relaxed) AS relaxed_extraction_count,
    count_if(len(sr_risk_flags) > 0) AS sr_risk_count, count_if(len(problems) > 0) AS problem_count, count_if(extraction_meets_target IS NULL) AS missing_coverage_count
    FROM rk GROUP BY sweep_id""", SUM, RANKS, views="runs"))
def _(spark, d):
    return R.sweep_counts(summaries(spark, d))


@query("resize_vs_off", oracle("""SELECT *, coalesce(best_resize < best_unscaled, false) AS resize_not_better FROM (SELECT sweep_id,
    max(point_count) FILTER (WHERE sr_mode = 'resize') AS best_resize, max(point_count) FILTER (WHERE sr_effective_scale = '1') AS best_unscaled FROM rc GROUP BY sweep_id) t""", SUM, views="runs"))
def _(spark, d):
    return R.resize_vs_off(summaries(spark, d))


@query("action_items", oracle("""SELECT sweep_id, area, count, flags, CASE WHEN count > 4 THEN list_concat(names[1:4], ['+' || (count - 4) || ' more']) ELSE names END AS affected_outputs FROM itm
    UNION ALL SELECT sweep_id, 'visual_review', 1, NULL, [output_name] FROM win WHERE ok AND sweep_id NOT IN (SELECT sweep_id FROM itm)""", SUM, RANKS,
    f"""hit AS (SELECT *, unnest(list_filter([CASE WHEN low_cov OR low_span THEN 'input_coverage' END, CASE WHEN len(sr_risk_flags) > 0 THEN 'sr_consistency' END, CASE WHEN low_col THEN 'colmap' END,
      CASE WHEN sr_fallback THEN 'sr_runtime' END, CASE WHEN extraction_relaxed THEN 'frame_quality' END, CASE WHEN point_count < 120000 THEN 'geometry' END,
      CASE WHEN score % 8 = 0 THEN 'delivery_size' END, CASE WHEN score % 9 = 0 THEN 'delivery_assets' END], lambda v: v IS NOT NULL)) AS area FROM rk)""",
    f"""itm AS (SELECT sweep_id, area, count(*) AS count, list(output_name ORDER BY {SORTED}) AS names,
      CASE WHEN area = 'sr_consistency' THEN array_to_string(list_sort(list_distinct(flatten(list(sr_risk_flags)))), ', ') END AS flags FROM hit GROUP BY sweep_id, area)""",
    """win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sweep_id ORDER BY ok DESC, coverage_rank DESC, temporal_rank DESC, colmap_rank DESC, score DESC,
      coalesce(best_psnr, -1) DESC, point_count DESC, train_sec, run_id) AS i FROM rk) t WHERE i = 1)""", views="runs"))
def _(spark, d):
    items = R.action_items(summaries(spark, d))
    flags = F.when(F.col("area") == "sr_consistency", F.regexp_extract("detail", r"risks: (.*)\. Prefer", 1))
    return items.select("sweep_id", "area", "count", flags.alias("flags"), "affected_outputs")


@query("truncate_names", oracle("""SELECT sweep_id, part, CASE WHEN len(n) <= 4 THEN n ELSE list_concat(n[1:4], ['+' || (len(n) - 4) || ' more']) END AS names FROM
    (SELECT sweep_id, run_id % 64 AS part, list(output_name ORDER BY run_id) AS n FROM rc GROUP BY ALL) t""", SUM, views="runs"))
def _(spark, d):
    """Names are gathered per slice of a sweep, which keeps every gathered list short."""
    rows = summaries(spark, d).withColumn("part", F.col("run_id") % 64)
    named = rows.groupBy("sweep_id", "part").agg(F.sort_array(F.collect_list(F.struct("run_id", "output_name"))).alias("s"))
    return named.select("sweep_id", "part", R.truncate_names(F.transform("s", lambda s: s["output_name"])).alias("names"))


@query("problem_contains", oracle("SELECT run_id, list_bool_or(list_transform(problems, lambda p: contains(lower(p), 'larger than mobile'))) IS TRUE AS heavy FROM rc", SUM, views="runs"))
def _(spark, d):
    return summaries(spark, d).select("run_id", R.problem_contains("Larger than MOBILE").alias("heavy"))


@query("scale_label", oracle("""SELECT run_id, CASE WHEN sx IS NULL THEN '' WHEN sy IS NULL OR abs(sx - sy) < 0.01 THEN format('{:.2g}', sx)
    ELSE format('{:.2g}', sx) || 'x' || format('{:.2g}', sy) END AS label FROM (SELECT run_id, CASE WHEN run_id % 9 = 0 THEN NULL ELSE 1 + span * 3 END AS sx,
    CASE WHEN run_id % 4 = 0 THEN NULL WHEN run_id % 4 = 1 THEN 1 + span * 3 + 0.001e0 ELSE registered_ratio * 30 END AS sy FROM runs) t""", views="runs"))
def _(spark, d):
    k = F.col("run_id") % 4
    rows = X.runs(spark, d).select("run_id", F.when(F.col("run_id") % 9 != 0, 1 + F.col("span") * 3).alias("scale_w"),
                                   F.when(k == 1, 1 + F.col("span") * 3 + 0.001).when(k > 1, F.col("registered_ratio") * 30).alias("scale_h"))
    return rows.select("run_id", R.scale_label().alias("label"))


@query("unique_rows", oracle("SELECT arg_min(run_id, run_id) AS run_id, sweep_id AS output, arg_min(score, run_id) AS score FROM runs GROUP BY sweep_id", views="runs"))
def _(spark, d):
    rows = X.runs(spark, d).select(F.col("sweep_id").alias("output"), F.col("run_id").alias("position"), "run_id", "score")
    return R.unique_rows(rows).select("output", "run_id", "score")


@query("dataset_all_ok", oracle("SELECT sweep_id, bool_and(ok) AS ok FROM runs GROUP BY sweep_id", views="runs"))
def _(spark, d):
    return D.diagnose_all(X.runs(spark, d).select("sweep_id", "ok"), "sweep_id").select("sweep_id", "ok")


# ---- report join -----------------------------------------------------------

def report_tables(spark, d):
    """Six report tables cut out of the runs; each lacks some runs, and the delivery copies fill gaps."""
    runs = X.runs(spark, d)
    mod = lambda n: F.col("run_id") % n == 0
    passes = F.array(F.struct(F.lit("strict").alias("name"), F.col("span").alias("selected_raw_index_coverage"), F.col("score").alias("temporal_thinned_count")),
                     F.struct(F.lit("coverage_1").alias("name"), (F.col("span") / 2).alias("selected_raw_index_coverage"), F.col("score").alias("temporal_thinned_count")))
    extraction = lambda shift: runs.select(
        "run_id", (F.col("selected_count") + shift).alias("selected_count"), F.col("target_frames").cast("bigint").alias("min_frames"),
        F.when(~mod(4), 0.85).alias("min_span"), F.when(mod(2), "strict").when(mod(3), "coverage_1").otherwise("gone").alias("selected_pass"),
        (F.col("selected_count") % 4 == 0).alias("relaxed"), passes.alias("passes"))
    colmap = lambda plus: runs.select("run_id", (F.col("registered_ratio") + plus).alias("registered_ratio"), F.col("point_count").alias("points3d"),
                                      F.when(mod(3), F.col("registered_ratio") >= 0.5).alias("meets_quality_target"))
    return runs.select("run_id", "sweep_id", "score"), {
        "sr_manifest": runs.filter(~mod(9)).select("run_id", F.when(~mod(8), F.col("effective_mode")).alias("effective_mode"), "requested_mode",
                                                   F.when(mod(5), "").otherwise("real-esrgan").alias("sr_model"), F.when(mod(6), 0).otherwise(2).alias("scale"),
                                                   F.when(mod(19), "model_load_fallback").alias("status")),
        "sr_strategy": runs.filter(~mod(4)).select("run_id", F.lit("auto").alias("mode"), F.lit("dat").alias("model"), F.lit(1).alias("scale"),
                                                   R.problem_list(F.when(mod(6), "clipped_frames")).alias("sr_risk_flags")),
        "input_quality": runs.filter(~mod(14)).select("run_id", "score"),
        "colmap": colmap(0.0).filter(~mod(7)), "delivery_colmap": colmap(0.125).filter(~mod(10)),
        "training": runs.filter(~mod(13)).select("run_id", "best_psnr", F.col("train_sec").alias("elapsed_sec")),
        "extraction": extraction(0).filter(~mod(6)), "delivery_extraction": extraction(1000).filter(~mod(12)),
    }


@query("join_run_reports", oracle("""SELECT run_id, sweep_id, score, coalesce(CASE WHEN m AND run_id % 8 <> 0 THEN effective_mode END, CASE WHEN s THEN 'auto' END, '') AS sr_mode,
    coalesce(CASE WHEN m THEN requested_mode END, CASE WHEN s THEN 'auto' END, '') AS sr_requested_mode,
    coalesce(CASE WHEN m AND run_id % 5 <> 0 THEN 'real-esrgan' END, CASE WHEN s THEN 'dat' END, '') AS sr_model,
    coalesce(CASE WHEN m AND run_id % 6 <> 0 THEN 2 END, CASE WHEN s THEN 1 END) AS sr_scale,
    CASE WHEN m AND run_id % 19 = 0 THEN 'model_load_fallback' ELSE '' END AS sr_status,
    coalesce(m AND run_id % 8 <> 0 AND requested_mode <> effective_mode, false) OR (m AND run_id % 19 = 0) AS sr_fallback,
    CASE WHEN s AND run_id % 6 = 0 THEN ['clipped_frames'] ELSE [] END AS sr_risk_flags,
    sel AS extraction_selected_count, CASE WHEN x OR xd THEN target_frames END AS extraction_target_frames,
    CAST(printf('%.3f', CAST(sel / target_frames::DOUBLE AS DOUBLE)) AS DOUBLE) AS extraction_coverage_ratio, CAST(printf('%.3f', CAST(sel / target_frames::DOUBLE AS DOUBLE)) AS DOUBLE) >= 1 AS extraction_meets_target,
    CASE WHEN x OR xd THEN selected_count % 4 = 0 END AS extraction_relaxed,
    CASE WHEN x OR xd THEN CASE WHEN run_id % 2 = 0 THEN span WHEN run_id % 3 = 0 THEN span / 2 END END AS extraction_temporal_coverage,
    CASE WHEN (x OR xd) AND run_id % 4 <> 0 THEN 0.85e0 ELSE 0.8e0 END AS extraction_temporal_target,
    CASE WHEN c THEN registered_ratio WHEN cd THEN registered_ratio + 0.125e0 END AS colmap_registered_ratio,
    CASE WHEN (c OR cd) AND run_id % 3 = 0 THEN registered_ratio >= 0.5e0 END AS colmap_meets_quality_target, CASE WHEN c OR cd THEN point_count END AS colmap_points3d,
    CASE WHEN run_id % 14 <> 0 THEN score END AS input_score, CASE WHEN run_id % 13 <> 0 THEN best_psnr END AS best_psnr, CASE WHEN run_id % 13 <> 0 THEN train_sec END AS train_sec
    FROM (SELECT *, run_id % 9 <> 0 AS m, run_id % 4 <> 0 AS s, run_id % 7 <> 0 AS c, run_id % 10 <> 0 AS cd, run_id % 6 <> 0 AS x, run_id % 12 <> 0 AS xd,
      CASE WHEN run_id % 6 <> 0 THEN selected_count WHEN run_id % 12 <> 0 THEN selected_count + 1000 END AS sel FROM runs) t""", views="runs"))
def _(spark, d):
    outputs, reports = report_tables(spark, d)
    return R.join_run_reports(outputs, reports)


# ---- sweep plans -----------------------------------------------------------

PLAN = """cap AS (SELECT p_partkey AS capture, concat(p_name, '.v', p_partkey, '(1)') AS video_name FROM part),
pln AS (SELECT capture, v.n AS variant, s.mode, regexp_replace(video_name, '[^\\p{L}\\p{N}_-]', '_', 'g') || '_' || v.n || '_' || s.mode ||
  CASE WHEN s.mode = 'model' THEN '_real-esrgan' ELSE '' END || '_x' || s.scale AS output_name
  FROM cap, (SELECT unnest([{'n':'cover64'},{'n':'cover96'},{'n':'strict64'}]) AS v) a,
  (SELECT unnest([{'mode':'off','scale':1},{'mode':'resize','scale':2},{'mode':'auto','scale':2},{'mode':'model','scale':2}]) AS s) b)"""


def planned(spark, d):
    captures = X.table(spark, d, "part").select(F.col("p_partkey").alias("capture"), F.concat("p_name", F.lit(".v"), "p_partkey", F.lit("(1)")).alias("video_name"))
    return R.plan_sweep(captures)


@query("safe_label", oracle("SELECT capture, regexp_replace(video_name, '[^\\p{L}\\p{N}_-]', '_', 'g') AS label, trim(regexp_replace(video_name, '[^\\p{L}\\p{N}_-]', '_', 'g'), '_') AS stem FROM cap",
                            PLAN.split(",\npln AS")[0]))
def _(spark, d):
    captures = X.table(spark, d, "part").select(F.col("p_partkey").alias("capture"), F.concat("p_name", F.lit(".v"), "p_partkey", F.lit("(1)")).alias("v"))
    return captures.select("capture", R.safe_label("v").alias("label"), R.asset_stem("v").alias("stem"))


@query("plan_sweep", oracle("SELECT capture, variant, mode, output_name FROM pln", PLAN))
def _(spark, d):
    return planned(spark, d).select("capture", "variant", "mode", "output_name")


@query("completed_vs_skipped", oracle("""SELECT capture, output_name, CASE WHEN dir IS NULL THEN 'missing output_dir' WHEN NOT there THEN 'output directory not found' END AS reason,
    CASE WHEN dir IS NOT NULL AND there THEN 'completed' ELSE 'skipped' END AS status FROM
    (SELECT capture, CASE WHEN capture % 11 = 0 THEN '' ELSE output_name END AS output_name, CASE WHEN capture % 11 = 0 THEN NULL ELSE 'out/' || output_name END AS dir,
     capture % 3 = 0 OR mode = 'off' AS there FROM pln) t""", PLAN))
def _(spark, d):
    plan = planned(spark, d)
    existing = plan.filter("capture % 3 = 0 OR mode = 'off'").select(F.concat(F.lit("out/"), "output_name").alias("output_dir"))
    runs = plan.select("capture", F.when(F.col("capture") % 11 == 0, "").otherwise(F.col("output_name")).alias("output_name"), F.lit("").alias("output_dir"))
    return R.completed_vs_skipped(runs, existing, "out/").select("capture", "output_name", "reason", "status")


# ---- strategies ------------------------------------------------------------

INPUTS = """inp AS (SELECT run_id, CASE run_id % 4 WHEN 0 THEN 1920 WHEN 1 THEN 1280 WHEN 2 THEN 1500 ELSE 960 END AS long_edge, CASE WHEN run_id % 5 = 0 THEN NULL ELSE 30 + score * 2.0e0 END AS sharpness_p10,
  CASE WHEN run_id % 7 = 0 THEN NULL ELSE score + 40 END AS score, selected_count AS frame_count, CASE WHEN run_id % 6 = 0 THEN NULL ELSE selected_count END AS selected_count, 20 AS min_frames,
  CASE WHEN run_id % 8 = 0 THEN NULL ELSE span + 0.5e0 END AS temporal_coverage, CASE WHEN run_id % 9 = 0 THEN 0.6e0 END AS temporal_target,
  list_filter([CASE WHEN run_id % 31 = 0 THEN 'blurry_frames' END, CASE WHEN run_id % 29 = 0 THEN 'clipped_frames' END, CASE WHEN run_id % 5 = 0 THEN 'low_frame_count' END], lambda v: v IS NOT NULL) AS problems,
  span / 4 + 0.01e0 AS diff_p50, span / 4 + 0.02e0 AS diff_p90, CAST(score AS DOUBLE) AS contrast_p10, span / 2 + 0.07e0 AS clipped_p90 FROM runs)"""
FLAGGED = """flg AS (SELECT *, CAST(printf('%.3f', CAST(selected_count / min_frames::DOUBLE AS DOUBLE)) AS DOUBLE) AS coverage_ratio, list_sort(list_distinct(list_filter([
  CASE WHEN list_contains(problems, 'clipped_frames') OR clipped_p90 > 0.55e0 THEN 'clipped_frames' END, CASE WHEN diff_p50 < 0.015e0 THEN 'near_duplicate_frames' END,
  CASE WHEN diff_p90 > 0.22e0 THEN 'large_view_jumps_or_exposure_changes' END, CASE WHEN contrast_p10 < 5 THEN 'low_contrast_frames' END], lambda v: v IS NOT NULL))) AS sr_risk_flags FROM inp)"""
STRAT = """str AS (SELECT *, CASE WHEN long_edge >= 1800 THEN 'large' WHEN list_contains(problems, 'blurry_frames') OR coalesce(sharpness_p10 < 45, false) THEN 'blur'
  WHEN coalesce(coverage_ratio < 1, false) THEN 'missed' WHEN coalesce(temporal_coverage < coalesce(temporal_target, 0.8e0), false) THEN 'partial' WHEN frame_count < 48 THEN 'few'
  WHEN len(sr_risk_flags) > 0 THEN 'risk' WHEN {vram} long_edge < 1400 AND (score IS NULL OR score >= 68) THEN 'model' ELSE 'default' END AS branch FROM flg)"""
MODE = "CASE WHEN branch IN ('blur', 'risk') THEN 'resize' WHEN branch = 'model' THEN 'model' WHEN branch = 'vram' AND long_edge < 1400 THEN 'resize' ELSE 'off' END"


def inputs(spark, d):
    mod = lambda n: F.col("run_id") % n == 0
    k = F.col("run_id") % 4
    return X.runs(spark, d).select(
        "run_id", F.when(k == 0, 1920).when(k == 1, 1280).when(k == 2, 1500).otherwise(960).alias("long_edge"), F.when(~mod(5), 30 + F.col("score") * 2.0).alias("sharpness_p10"),
        F.when(~mod(7), F.col("score") + 40).alias("score"), F.col("selected_count").alias("frame_count"), F.when(~mod(6), F.col("selected_count")).alias("selected_count"),
        F.lit(20).alias("min_frames"), F.when(~mod(8), F.col("span") + 0.5).alias("temporal_coverage"), F.when(mod(9), 0.6).alias("temporal_target"),
        R.problem_list(F.when(mod(31), "blurry_frames"), F.when(mod(29), "clipped_frames"), F.when(mod(5), "low_frame_count")).alias("problems"),
        (F.col("span") / 4 + 0.01).alias("diff_p50"), (F.col("span") / 4 + 0.02).alias("diff_p90"), F.col("score").cast("double").alias("contrast_p10"),
        (F.col("span") / 2 + 0.07).alias("clipped_p90"))


@query("recommend_sr_strategy", oracle(f"SELECT run_id, {MODE} AS mode, CASE WHEN {MODE} = 'off' THEN 1 ELSE 2 END AS scale, coverage_ratio, sr_risk_flags FROM str",
                                       INPUTS, FLAGGED, STRAT.format(vram=""), views="runs"))
def _(spark, d):
    return R.recommend_sr_strategy(inputs(spark, d)).select("run_id", "mode", "scale", "coverage_ratio", "sr_risk_flags")


@query("recommend_sr_strategy_low_vram", oracle(f"SELECT run_id, {MODE} AS mode, branch = 'vram' AS limited FROM str",
                                                INPUTS, FLAGGED, STRAT.format(vram="true THEN 'vram' WHEN"), views="runs"))
def _(spark, d):
    rows = R.recommend_sr_strategy(inputs(spark, d), vram_gb=8.0)
    return rows.select("run_id", "mode", F.col("reason").contains("limited VRAM").alias("limited"))


@query("adjust_for_preflight", oracle(f"""SELECT run_id, CASE WHEN mode = 'model' AND (run_id % 3 = 0 OR run_id % 2 = 0) THEN 'resize' ELSE mode END AS mode,
    CASE WHEN mode = 'model' AND run_id % 3 = 0 THEN 'failed' WHEN mode = 'model' AND run_id % 2 = 0 THEN 'remote' ELSE 'as is' END AS change FROM (SELECT run_id, {MODE} AS mode FROM str) t""",
    INPUTS, FLAGGED, STRAT.format(vram=""), views="runs"))
def _(spark, d):
    rows = R.recommend_sr_strategy(inputs(spark, d))
    rows = rows.withColumns({"preflight_ok": F.when(F.col("run_id") % 3 == 0, F.lit(False)), "needs_download": F.col("run_id") % 2 == 0})
    done = R.adjust_for_preflight(rows)
    change = F.when(F.col("reason").contains("preflight failed"), "failed").when(F.col("reason").contains("not local"), "remote").otherwise("as is")
    return done.select("run_id", "mode", change.alias("change"))


@query("resolve_sr_mode", oracle("""SELECT run_id, CASE WHEN mode IN ('off', 'copy', 'none') THEN 'off' WHEN mode IN ('resize', 'model') THEN CASE WHEN scale > 1 THEN mode ELSE 'off' END
    WHEN scale <= 1 THEN 'off' WHEN lower(sr_model) = 'copy' THEN 'off' WHEN lower(sr_model) IN ('bicubic', 'lanczos') THEN 'resize' ELSE 'model' END AS resolved FROM
    (SELECT run_id, ['off', 'copy', 'resize', 'model', 'auto', 'auto', 'auto'][1 + run_id % 7] AS mode, 1 + run_id % 3 AS scale, ['Bicubic', 'real-esrgan', 'COPY', 'lanczos'][1 + run_id % 4] AS sr_model FROM runs) t""", views="runs"))
def _(spark, d):
    pick = lambda names, n: F.element_at(F.array(*[F.lit(v) for v in names]), (1 + F.col("run_id") % n).cast("int"))
    rows = X.runs(spark, d).select("run_id", pick(["off", "copy", "resize", "model", "auto", "auto", "auto"], 7).alias("mode"),
                                   (1 + F.col("run_id") % 3).alias("scale"), pick(["Bicubic", "real-esrgan", "COPY", "lanczos"], 4).alias("sr_model"))
    return rows.select("run_id", R.resolve_sr_mode().alias("resolved"))


@query("sr_output_valid", oracle("""SELECT l_orderkey AS run_id, count(DISTINCT CASE WHEN l_linenumber = 5 AND l_orderkey % 4 = 0 THEN l_linenumber END) AS missing_images,
    count_if(l_linenumber = 5 AND l_orderkey % 4 = 0) = 0 AND l_orderkey % 6 <> 0 AND l_orderkey % 5 <> 0 AND (l_orderkey % 3 <> 0 OR l_orderkey % 9 <> 0) AS valid FROM lineitem GROUP BY l_orderkey"""))
def _(spark, d):
    """Order lines play the images of a run; line 5 of every fourth run was never written."""
    lines = X.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.format_string("frame_%05d.png", "l_linenumber").alias("name"), "l_linenumber").distinct()
    mod = lambda n: F.col("run_id") % n == 0
    expected = lines.select("run_id", "name", F.when(mod(3), "model").otherwise("resize").alias("mode"), F.lit(2).alias("scale"), F.lit("dat").alias("model"))
    listing = lines.filter("NOT (l_linenumber = 5 AND run_id % 4 = 0)")
    manifests = (lines.select("run_id").distinct().filter(~mod(6))
                 .select("run_id", F.when(mod(5), "off").when(mod(3), "model").otherwise("resize").alias("effective_mode"), F.lit(2).alias("scale"),
                         F.when(mod(9), "other").otherwise("dat").alias("sr_model")))
    return R.sr_output_valid(expected, listing, manifests)
