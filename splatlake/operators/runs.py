"""Run tables: report joins, coverage and registration ranks, recommendations, sweep plans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.order_stats import ranked
from ..functions.scalars import problem_list, round_half_even
from ..functions.scaling import attach

DEFAULT_SPAN = 0.80
MIN_REGISTERED_RATIO = 0.45


def first_text(*cols) -> Column:
    """First non-empty string, else the empty string."""
    filled = [F.when(F.length(F.col(c) if isinstance(c, str) else c) > 0, F.col(c) if isinstance(c, str) else c) for c in cols]
    return F.coalesce(*filled, F.lit(""))


def number(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def coverage_ratio(selected="selected_count", target="target_frames") -> Column:
    s, t = number(selected), number(target)
    return F.when(t > 0, round_half_even(s / t, 3))


def selected_pass(passes="passes", name="selected_pass") -> Column:
    """The first pass whose name is the selected one, NULL when there is none."""
    return F.get(F.filter(F.col(passes), lambda p: p["name"] == F.col(name)), F.lit(0))


def is_fallback(requested="requested_mode", effective="effective_mode", status="status") -> Column:
    differs = (F.length(requested) > 0) & (F.length(effective) > 0) & (F.col(requested) != F.col(effective))
    text = F.coalesce(F.col(status), F.lit(""))
    return F.coalesce(differs, F.lit(False)) | text.contains("fallback") | text.contains("failed_copied_originals")


# ---- joins -----------------------------------------------------------------

def join_run_reports(outputs: DataFrame, reports: dict[str, DataFrame], key: str = "run_id") -> DataFrame:
    """Left-join the report tables of a run and derive the summary columns.

    `reports` holds any of sr_manifest, sr_strategy, input_quality, colmap, training,
    extraction, delivery_extraction, delivery_colmap; a missing table or row is NULL.
    The two delivery copies stand in for a run without the workspace report.
    """
    rows = outputs
    wanted = {
        "sr_manifest": ("effective_mode", "requested_mode", "sr_model", "scale", "status", "error"),
        "sr_strategy": ("mode", "model", "scale", "reason", "sr_risk_flags"),
        "input_quality": ("score",),
        "colmap": ("ok", "registered_images", "image_count", "registered_ratio", "points3d", "meets_quality_target"),
        "training": ("best_psnr", "last_loss", "elapsed_sec"),
        "extraction": ("selected_count", "raw_count", "min_frames", "min_span", "selected_pass", "relaxed", "passes"),
    }
    wanted["delivery_extraction"], wanted["delivery_colmap"] = wanted["extraction"], wanted["colmap"]
    here = {}
    for name, report in reports.items():
        cols = [c for c in wanted[name] if c in report.columns]
        here |= {f"{name}.{c}": f"_{name}_{c}" for c in cols}
        there = F.greatest(F.lit(False), F.lit(not cols), *[F.col(c).isNotNull() for c in cols])  # an unreadable report has nothing but nulls
        rows = rows.join(report.select(key, there.alias(f"_{name}_"), *[F.col(c).alias(f"_{name}_{c}") for c in cols]), key, "left")

    def get(report: str, c: str, kind: str) -> Column:
        own = here.get(f"{report}.{c}")
        own = F.col(own) if own else F.lit(None).cast(kind)
        copy = here.get(f"delivery_{report}.{c}")
        if not copy:
            return own
        return F.when(F.col(f"_{report}_"), own).otherwise(F.col(copy)) if report in reports else F.col(copy)

    none_if_blank = lambda c: F.when(F.length(c) > 0, c)
    effective = get("sr_manifest", "effective_mode", "string")
    requested = get("sr_manifest", "requested_mode", "string")
    strategy_mode = get("sr_strategy", "mode", "string")
    status = get("sr_manifest", "status", "string")
    rows = rows.withColumns({"_eff": effective, "_req": requested, "_status": status})
    ratio = coverage_ratio(get("extraction", "selected_count", "bigint"), get("extraction", "min_frames", "bigint"))
    passes_type = "array<struct<name:string,selected_raw_index_coverage:double,temporal_thinned_count:bigint>>"
    rows = rows.withColumns({"_passes": get("extraction", "passes", passes_type), "_sel": get("extraction", "selected_pass", "string")})
    chosen = selected_pass("_passes", "_sel")
    out = {
        "sr_mode": F.coalesce(none_if_blank(effective), none_if_blank(strategy_mode), F.lit("")),
        "sr_requested_mode": F.coalesce(none_if_blank(requested), none_if_blank(strategy_mode), F.lit("")),
        "sr_model": F.coalesce(none_if_blank(get("sr_manifest", "sr_model", "string")), none_if_blank(get("sr_strategy", "model", "string")), F.lit("")),
        "sr_scale": F.coalesce(F.nullif(get("sr_manifest", "scale", "int"), F.lit(0)), F.nullif(get("sr_strategy", "scale", "int"), F.lit(0))),
        "sr_status": F.coalesce(status, F.lit("")),
        "sr_fallback": is_fallback("_req", "_eff", "_status"),
        "sr_risk_flags": F.coalesce(get("sr_strategy", "sr_risk_flags", "array<string>"), F.array().cast("array<string>")),
        "extraction_selected_count": get("extraction", "selected_count", "bigint"),
        "extraction_target_frames": get("extraction", "min_frames", "bigint"),
        "extraction_coverage_ratio": ratio,
        "extraction_meets_target": ratio >= 1.0,
        "extraction_relaxed": get("extraction", "relaxed", "boolean"),
        "extraction_temporal_coverage": chosen["selected_raw_index_coverage"],
        "extraction_temporal_target": F.coalesce(get("extraction", "min_span", "double"), F.lit(DEFAULT_SPAN)),
        "colmap_registered_ratio": get("colmap", "registered_ratio", "double"),
        "colmap_meets_quality_target": get("colmap", "meets_quality_target", "boolean"),
        "colmap_points3d": get("colmap", "points3d", "bigint"),
        "input_score": get("input_quality", "score", "bigint"),
        "best_psnr": get("training", "best_psnr", "double"),
        "train_sec": get("training", "elapsed_sec", "double"),
    }
    base = [c for c in outputs.columns]
    return rows.select(*base, *[v.alias(k) for k, v in out.items()])


# ---- ranks -----------------------------------------------------------------

def three_way(flag: Column) -> Column:
    """True 2, unknown 1, False 0."""
    return F.when(flag.isNull(), 1).when(flag, 2).otherwise(0)


def coverage_rank(meets="extraction_meets_target") -> Column:
    return three_way(F.col(meets))


def _span_target() -> Column:
    target = number("extraction_temporal_target")
    return F.coalesce(F.when(target != 0, target), F.lit(DEFAULT_SPAN))


def temporal_rank() -> Column:
    return three_way(number("extraction_temporal_coverage") >= _span_target())


def colmap_rank() -> Column:
    meets = F.col("colmap_meets_quality_target")
    return three_way(F.coalesce(meets, number("colmap_registered_ratio") >= MIN_REGISTERED_RATIO))


def low_temporal() -> Column:
    return F.coalesce(number("extraction_temporal_coverage") < _span_target(), F.lit(False))


def low_colmap() -> Column:
    low = number("colmap_registered_ratio") < MIN_REGISTERED_RATIO
    return F.coalesce(~F.col("colmap_meets_quality_target"), F.lit(False)) | F.coalesce(low, F.lit(False))


def low_coverage() -> Column:
    return F.coalesce(~F.col("extraction_meets_target"), F.lit(False))


def with_ranks(runs: DataFrame) -> DataFrame:
    return runs.withColumns({"coverage_rank": coverage_rank(), "temporal_rank": temporal_rank(), "colmap_rank": colmap_rank()})


RANK_KEYS = ("coverage_rank", "temporal_rank", "colmap_rank", "score", "point_count")


def rank_order(tie: str = "run_id") -> list[Column]:
    return [F.col(c).desc() for c in RANK_KEYS] + [F.col(tie).asc()]


def rank_runs(runs: DataFrame, keys=("sweep_id",), tie: str = "run_id") -> DataFrame:
    """Position of every run in its sweep by the three ranks, score and point count."""
    return ranked(with_ranks(runs), keys, rank_order(tie), "run_rank")


def _better(tie: str) -> Column:
    """Orders runs from the best on: the struct is least for the winner; of equal runs the one of the smallest id, whatever the id's type."""
    down = lambda c, d=0: -F.coalesce(F.col(c), F.lit(d))
    return F.struct((~F.coalesce(F.col("ok"), F.lit(False))).alias("ok"), *[(-F.col(c)).alias(c) for c in RANK_KEYS[:3]], down("score").alias("score"), down("best_psnr", -1.0).alias("psnr"),
                    down("point_count").alias("points"), F.coalesce("train_sec", F.lit(0.0)).alias("sec"), F.col(tie).alias("tie"))


def recommend_run(runs: DataFrame, keys=("sweep_id",), tie: str = "run_id") -> DataFrame:
    """Winner of each sweep (among ok runs when any is) and the reason to name it.

    A `min_by` keeps one candidate per sweep and task, so a huge sweep neither shuffles its runs nor sorts.
    """
    facts = F.struct(F.col(tie), "score", "best_psnr", "point_count", low_coverage().alias("c"), low_temporal().alias("t"), low_colmap().alias("m"))
    won = with_ranks(runs).groupBy(*keys).agg(F.min_by(facts, _better(tie)).alias("w"))
    # Reasons by the winner's first weakness.
    reason = (F.when(F.col("w.c"), "best available score, but extraction coverage target was missed; capture/rerun coverage should be reviewed first")
              .when(F.col("w.t"), "best available score, but selected frames cover only part of the source timeline; review capture coverage first")
              .when(F.col("w.m"), "best available score, but COLMAP registered too few images; review camera reconstruction first")
              .otherwise("highest score among runs that meet extraction coverage, with PSNR/point-count tie-breakers; still requires visual review"))
    return won.select(*keys, F.col(f"w.{tie}").alias("recommended_run"), F.col("w.score").alias("score"), F.col("w.best_psnr").alias("best_psnr"),
                      F.col("w.point_count").alias("point_count"), reason.alias("recommended_reason"))


def sweep_counts(runs: DataFrame, keys=("sweep_id",)) -> DataFrame:
    filled = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    return runs.groupBy(*keys).agg(
        F.count("*").alias("run_count"),
        F.count_if("sr_fallback").alias("fallback_count"), F.count_if(low_coverage()).alias("low_coverage_count"),
        F.count_if(low_temporal()).alias("low_temporal_coverage_count"), F.count_if(low_colmap()).alias("low_colmap_count"),
        F.count_if(F.coalesce("extraction_relaxed", F.lit(False))).alias("relaxed_extraction_count"),
        F.count_if(filled("sr_risk_flags")).alias("sr_risk_count"), F.count_if(filled("problems")).alias("problem_count"),
        F.count_if(F.col("extraction_meets_target").isNull()).alias("missing_coverage_count"))


def resize_vs_off(runs: DataFrame, keys=("sweep_id",)) -> DataFrame:
    """Did the best resized run fall short of the best run at scale 1?"""
    best = runs.groupBy(*keys).agg(
        F.max(F.when(F.col("sr_mode") == "resize", F.coalesce("point_count", F.lit(0)))).alias("best_resize"),
        F.max(F.when(F.col("sr_effective_scale") == "1", F.coalesce("point_count", F.lit(0)))).alias("best_unscaled"))
    return best.withColumn("resize_not_better", F.coalesce(F.col("best_resize") < F.col("best_unscaled"), F.lit(False)))


def problem_contains(needle: str, problems: str = "problems") -> Column:
    low = needle.lower()
    return F.coalesce(F.exists(F.col(problems), lambda p: F.lower(p).contains(low)), F.lit(False))


def truncate_names(names, limit: int = 4) -> Column:
    names = F.col(names) if isinstance(names, str) else names
    more = F.concat(F.lit("+"), (F.size(names) - limit).cast("string"), F.lit(" more"))
    return F.when(F.size(names) <= limit, names).otherwise(F.concat(F.slice(names, 1, limit), F.array(more)))


def unique_rows(rows: DataFrame, key: str = "output", order: str = "position") -> DataFrame:
    """First row of every output by position."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), F.col(order)).alias("r"))
    return first.select(key, "r.*")


# Action areas with their titles and details, in report order.
ACTIONS = (
    ("input_coverage", "Rerun the sweep with stronger frame coverage before judging SR quality.",
     "Use --phone_coverage_sweep or raise extraction min/max frames; if timeline span stays low, recapture a slower full orbit with steadier framing."),
    ("sr_consistency", "Treat learned SR as unsafe for the flagged capture until off/resize baselines are checked.",
     "Auto SR detected multi-view consistency risks: {flags}. Prefer off or deterministic resize, or recapture with smoother motion and exposure."),
    ("colmap", "Fix camera registration before trusting PSNR or point-count differences.",
     "Review colmap_report.json attempts, prefer higher cam_ratio runs, and recapture with more parallax or texture if every camera model is weak."),
    ("sr_runtime", "Resolve SR fallback before comparing learned-SR results.",
     "Check sr_images/sr_manifest.json for model_preflight, missing weights, timeouts, and sr_error; fallback rows should be treated as off/copy baselines."),
    ("frame_quality", "Review frames selected by relaxed extraction before publishing.",
     "Relaxed thresholds can admit blur or exposure outliers; inspect frame contact sheets and rerun with stricter extraction if artifacts appear."),
    ("geometry", "Improve reconstruction density before tuning delivery polish.",
     "Low point count usually means capture coverage, COLMAP registration, or training budget is the bottleneck; compare against the recommended output first."),
    ("delivery_size", "Produce a smaller mobile web asset before release.",
     "Use cleanup/downsampling or publish a separate mobile preset so the browser viewer stays inside the configured size budget."),
    ("delivery_assets", "Rebuild or package the delivery before visual review.",
     "The summary could not find a complete web asset or PLY, so validate_output/package_delivery should run before comparing quality."),
    ("visual_review", "Run visual review on the recommended output.",
     "The automated checks did not find blocking sweep issues; inspect orbit smoothness, floaters, thin details, and phone-browser load time."),
)


def action_items(runs: DataFrame, keys=("sweep_id",), tie: str = "run_id", name: str = "output_name") -> DataFrame:
    """Issues of each sweep with their run counts and the first four affected outputs.

    A sweep without any issue whose winner is ok gets one visual-review item.
    """
    keys = list(keys)
    rows = with_ranks(runs)
    filled = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    tests = {
        "input_coverage": low_coverage() | low_temporal(), "sr_consistency": filled("sr_risk_flags"), "colmap": low_colmap(),
        "sr_runtime": F.coalesce("sr_fallback", F.lit(False)), "frame_quality": F.coalesce("extraction_relaxed", F.lit(False)),
        "geometry": problem_contains("point count is too low"), "delivery_size": problem_contains("larger than mobile budget"),
        "delivery_assets": problem_contains("missing web asset") | problem_contains("missing PLY file") | problem_contains("PLY diagnostics failed"),
    }
    # counts, flags and the winner shrink in partial aggregates; the flag vocabulary is small and fixed
    flags = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("sr_risk_flags")))), ", ")
    sweeps = rows.groupBy(*keys).agg(*[F.count_if(test).alias(f"_{area}") for area, test in tests.items()], flags.alias("_flags"), F.min_by(F.struct("ok", name), _better(tie)).alias("w"))
    issues = F.filter(F.array(*[F.struct(F.lit(area).alias("area"), F.col(f"_{area}").alias("count")) for area in tests]), lambda i: i["count"] > 0)
    calm = F.when(F.col("w.ok"), F.array(F.struct(F.lit("visual_review").alias("area"), F.lit(1).cast("bigint").alias("count"))))
    sweeps = sweeps.select(*keys, "_flags", F.col(f"w.{name}").alias("_best"), F.explode(F.when(F.size(issues) > 0, issues).otherwise(calm)).alias("i")).select(*keys, "_flags", "_best", "i.*")
    # of each sweep and area at most four runs leave a task: the rank limit works before the shuffle too
    areas = problem_list(*[F.when(test, F.lit(area)) for area, test in tests.items()])
    hits = rows.select(*keys, tie, name, *RANK_KEYS, F.explode(areas).alias("area"))
    first = Window.partitionBy(*keys, "area").orderBy(*rank_order(tie))
    heads = (hits.withColumn("_i", F.row_number().over(first)).filter("_i <= 4").groupBy(*keys, "area")
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", name))), lambda s: s[name]).alias("_names")))
    review = F.col("area") == "visual_review"
    items = sweeps.join(heads, [*keys, "area"], "left").withColumns({"names": F.when(review, F.array("_best")).otherwise(F.col("_names")), "flags": F.when(F.col("area") == "sr_consistency", F.col("_flags"))})
    title = F.coalesce(*[F.when(F.col("area") == a, F.lit(t)) for a, t, _ in ACTIONS])
    detail = F.coalesce(*[F.when(F.col("area") == a, F.replace(F.lit(t), F.lit("{flags}"), F.coalesce("flags", F.lit("")))) for a, _, t in ACTIONS])
    more = F.concat(F.lit("+"), (F.col("count") - 4).cast("string"), F.lit(" more"))
    shown = F.when(F.col("count") > 4, F.concat("names", F.array(more))).otherwise(F.col("names"))
    return items.select(*keys, "area", title.alias("title"), detail.alias("detail"), "count", shown.alias("affected_outputs"))


@F.pandas_udf(T.StringType())
def _two_digits(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None or v != v else f"{v:.2g}")


def scale_label(sx="scale_w", sy="scale_h") -> Column:
    """Two significant digits, or AxB when the axes differ by 0.01 or more."""
    x, y = F.col(sx).cast("double"), F.col(sy).cast("double")
    a, b = _two_digits(x), _two_digits(y)
    label = F.when(y.isNull() | (F.abs(x - y) < 0.01), a).otherwise(F.concat(a, F.lit("x"), b))
    return F.coalesce(label, F.lit(""))


# ---- sweep plans -----------------------------------------------------------

# Default strategies (mode, model, scale) and extraction variants
# (name, min_frames, max_frames, min_span, adaptive).
STRATEGIES = (("off", "real-esrgan", 1), ("resize", "real-esrgan", 2), ("auto", "real-esrgan", 2), ("model", "real-esrgan", 2))
VARIANTS = (("cover64", 64, 200, 0.85, True), ("cover96", 96, 300, 0.90, True), ("strict64", 64, 200, 0.85, False))


def safe_label(c) -> Column:
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[^\p{L}\p{N}_-]", "_")


def asset_stem(c) -> Column:
    stem = F.trim(safe_label(c), F.lit("_"))
    return F.when(F.length(stem) > 0, stem).otherwise(F.lit("scene"))


def plan_sweep(captures: DataFrame, strategies=STRATEGIES, variants=VARIANTS, name: str = "video_name") -> DataFrame:
    """One planned run per capture, extraction variant and strategy; both lists are short literals."""
    arms = F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(mo).alias("model"), F.lit(s).alias("scale")) for m, mo, s in strategies])
    rows = captures
    if variants:
        takes = F.array(*[F.struct(F.lit(n).alias("variant"), F.lit(lo).alias("min_frames"), F.lit(hi).alias("max_frames"), F.lit(sp).alias("min_span"),
                                   F.lit(ad).alias("adaptive")) for n, lo, hi, sp, ad in variants])
        rows = rows.withColumn("_v", F.explode(takes)).select("*", "_v.*").drop("_v")
    rows = rows.withColumn("_s", F.explode(arms)).select("*", "_s.*").drop("_s")
    model = F.when(F.col("mode") == "model", F.replace("model", F.lit("+"), F.lit("p")))
    scale = F.concat(F.lit("x"), F.col("scale").cast("string"))
    parts = [safe_label(name)] + ([F.col("variant")] if variants else []) + [F.col("mode"), model, scale]
    return rows.withColumn("output_name", F.concat_ws("_", *parts))


def completed_vs_skipped(planned: DataFrame, existing: DataFrame, final_root: str = "") -> DataFrame:
    """Planned runs with `status` completed or skipped and the reason for a skip."""
    named = F.when((F.lit(final_root) != "") & (F.length("output_name") > 0), F.concat(F.lit(final_root.rstrip("/") + "/"), F.col("output_name")))
    where = F.coalesce(F.when(F.length("output_dir") > 0, F.col("output_dir")), named)
    rows = planned.withColumn("output_dir", where)
    marks = existing.select("output_dir").distinct().withColumn("_there", F.lit(True))
    rows = attach(rows, marks, ["output_dir"], isolate=False)
    reason = F.when(F.col("output_dir").isNull(), "missing output_dir").when(F.col("_there").isNull(), "output directory not found")
    return rows.withColumns({"reason": reason, "status": F.when(reason.isNull(), "completed").otherwise("skipped")}).drop("_there")


# ---- super-resolution strategy ---------------------------------------------

# Input problems that put multi-view consistency at risk.
RISK_PROBLEMS = ("bad_exposure_frames", "clipped_frames", "large_view_jumps_or_exposure_changes", "low_contrast_frames", "near_duplicate_frames")


def sr_risk_flags() -> Column:
    """Risk problems named by the input report or shown by its metrics, sorted and distinct."""
    named = F.array_intersect(F.coalesce("problems", F.array().cast("array<string>")), F.array(*[F.lit(p) for p in RISK_PROBLEMS]))
    measured = problem_list(F.when(number("diff_p50") < 0.015, "near_duplicate_frames"),
                            F.when(number("diff_p90") > 0.22, "large_view_jumps_or_exposure_changes"),
                            F.when(number("contrast_p10") < 5, "low_contrast_frames"),
                            F.when(number("clipped_p90") > 0.55, "clipped_frames"))
    return F.array_sort(F.array_union(named, measured))


def recommend_sr_strategy(reports: DataFrame, preferred_model: str = "real-esrgan", preferred_scale: int = 2, vram_gb: float = 0.0) -> DataFrame:
    """Mode, scale and reason per input report; the first branch that applies decides.

    Reads long_edge, sharpness_p10, score, frame_count, problems, selected_count, min_frames,
    temporal_coverage, temporal_target and the four risk metrics; any may be NULL.
    """
    up = 2 if preferred_scale <= 1 else min(int(preferred_scale), 2)
    long_edge = F.coalesce("long_edge", F.lit(0))
    cover = coverage_ratio("selected_count", "min_frames")
    span, span_target = number("temporal_coverage"), F.coalesce(number("temporal_target"), F.lit(DEFAULT_SPAN))
    yes = lambda c: F.coalesce(c, F.lit(False))
    rows = reports.withColumns({"coverage_ratio": cover, "sr_risk_flags": sr_risk_flags()})
    missed, partial = yes(F.col("coverage_ratio") < 1.0), yes(span < span_target)
    blurry = yes(F.array_contains("problems", "blurry_frames")) | yes(F.col("sharpness_p10") < 45)
    # Reasons by branch.
    branches = [
        (long_edge >= 1800, "off", "input frames are already near HD/2K; keep geometry-first resolution"),
        (blurry, "resize", "input is small but too blurry for learned SR; use deterministic resize"),
        (missed, "off", "extraction missed its frame coverage target; prioritize capture coverage over SR"),
        (partial, "off", "selected frames cover only part of the video; prioritize full-turn coverage over SR"),
        (yes(F.col("frame_count") < 48), "off", "too few views; prioritize capture coverage over SR"),
        (F.size("sr_risk_flags") > 0, "resize", "input has multi-view consistency risks; use deterministic resize instead of learned SR"),
    ]
    if 0 < vram_gb < 10:
        short = "limited VRAM; avoid learned SR training resolution jump"
        branches += [(long_edge < 1400, "resize", short), (F.lit(True), "off", short)]
    branches.append(((long_edge > 0) & (long_edge < 1400) & F.coalesce(F.col("score") >= 68, F.lit(True)), "model",
                     "small, sharp-enough frames with acceptable coverage"))
    mode, reason = F.when(branches[0][0], branches[0][1]), F.when(branches[0][0], branches[0][2])
    for test, m, why in branches[1:]:
        mode, reason = mode.when(test, m), reason.when(test, why)
    rows = rows.withColumns({"mode": mode.otherwise("off"), "reason": reason.otherwise("default conservative path for general phone video")})
    return rows.withColumns({"model": F.lit(preferred_model), "scale": F.when(F.col("mode") == "off", 1).otherwise(up)})


def adjust_for_preflight(strategies: DataFrame, allow_download: bool = False) -> DataFrame:
    """Turn model mode into resize when preflight failed or the weights are not local."""
    model = F.col("mode") == "model"
    failed = model & F.coalesce(~F.col("preflight_ok"), F.lit(False))
    remote = model & F.coalesce(F.col("needs_download"), F.lit(False)) & F.lit(not allow_download)
    return strategies.withColumns({
        "mode": F.when(failed | remote, "resize").otherwise(F.col("mode")),
        "reason": F.when(failed, "learned SR preflight failed; use deterministic resize")
        .when(remote, "learned SR weights are not local; use deterministic resize unless downloads are explicitly allowed").otherwise(F.col("reason"))})


def resolve_sr_mode(mode="mode", scale="scale", model="sr_model") -> Column:
    mode, scale, model = F.col(mode), F.col(scale), F.lower(F.col(model))
    return (F.when(mode.isin("off", "copy", "none"), "off")
            .when(mode.isin("resize", "model"), F.when(scale > 1, mode).otherwise("off"))
            .when(scale <= 1, "off").when(model.isin("off", "none", "copy"), "off")
            .when(model.isin("resize", "bicubic", "lanczos"), "resize").otherwise("model"))


def sr_output_valid(expected: DataFrame, listing: DataFrame, manifests: DataFrame, key: str = "run_id") -> DataFrame:
    """Per run: no expected image is missing and the manifest has the expected mode, scale and model.

    `expected` has (key, name, mode, scale, model), `listing` (key, name), `manifests` one row per run.
    """
    lacking = (expected.join(listing.select(key, "name").distinct().withColumn("_there", F.lit(True)), [key, "name"], "left")
               .groupBy(key).agg(F.count_if(F.col("_there").isNull()).alias("missing_images"), F.first("mode").alias("mode"),
                                 F.first("scale").alias("scale"), F.first("model").alias("model")))
    rows = lacking.join(manifests.select(key, F.lit(True).alias("_m"), F.col("effective_mode").alias("_mode"), F.col("scale").alias("_scale"),
                                         F.col("sr_model").alias("_model")), key, "left")
    same = F.coalesce(F.col("_mode") == F.col("mode"), F.lit(False)) & (F.coalesce("_scale", "scale") == F.col("scale")) & (
        (F.col("mode") != "model") | F.coalesce(F.col("_model") == F.col("model"), F.lit(False)))
    valid = (F.col("missing_images") == 0) & F.coalesce("_m", F.lit(False)) & same
    return rows.select(key, "missing_images", F.coalesce(valid, F.lit(False)).alias("valid"))
