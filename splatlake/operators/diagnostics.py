"""Cloud diagnostics and comparison of cleaned candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.order_stats import group_stats
from ..functions.scalars import all_finite, distance, exp_scale, finite, nan_to_null, round_half_even
from ..functions.scaling import attach, durable
from .encodings import LOG_SCALE_BELOW, SCALES, has_scales
from .splats import CENTER, XYZ


def diagnose(splats: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Bounds, radius, scale and opacity percentiles and an `ok` verdict per scene.

    Two passes: the first finds the median centre and the encodings, the second
    the distances about it.
    """
    keys = list(keys)
    scaled = has_scales(splats)
    opaque = "opacity_raw" in splats.columns
    none = F.lit(None).cast("double")
    raw = tuple(SCALES) if scaled else (none,)
    opacity = F.col("opacity_raw").cast("double") if opaque else none
    specs = {n: (a, 0.5) for n, a in zip(CENTER, XYZ)}
    specs |= {"scale_median": (raw, 0.5), "scale_p50": (raw, 0.5), "scale_p95": (raw, 0.95), "scale_p99": (raw, 0.99), "scale_max": (raw, 1.0)}
    specs |= {"opacity_raw_p50": (opacity, 0.5), "opacity_raw_p95": (opacity, 0.95), "opacity_raw_max": (opacity, 1.0)}
    seen = nan_to_null(opacity)
    passed = durable(group_stats(splats, keys, specs, [
        F.count("*").alias("count"), F.count_if(~all_finite(*XYZ)).alias("non_finite"),
        F.min(seen).alias("_o_min"), F.max(seen).alias("_o_max"),
        *[F.min(nan_to_null(a)).alias(f"{a}_min") for a in XYZ], *[F.max(nan_to_null(a)).alias(f"{a}_max") for a in XYZ]]))
    rows = attach(splats, passed.select(*keys, *CENTER, (F.col("scale_median") < LOG_SCALE_BELOW).alias("_log")), keys)
    dist = distance(XYZ, CENTER)
    radius = F.when(finite(dist), dist)
    linear = tuple(F.when(F.col("_log"), exp_scale(s)).otherwise(s) for s in (F.col(c).cast("double") if isinstance(c, str) else c for c in raw))
    about = group_stats(rows, keys, {
        "radius_p50": (radius, 0.5), "radius_p95": (radius, 0.95), "radius_p99": (radius, 0.99), "radius_max": (radius, 1.0),
        "scale_actual_p50": (linear, 0.5), "scale_actual_p95": (linear, 0.95), "scale_actual_p99": (linear, 0.99),
        "scale_actual_max": (linear, 1.0)}, size_of=splats)
    joined = passed.join(about, keys, "left")
    ok = (F.col("non_finite") == 0) & (F.col("radius_p99") <= 100) & (
        F.col("radius_max") <= F.greatest(F.lit(100.0), F.col("radius_p99") * 20))
    logit = (F.col("_o_min") < 0) | (F.col("_o_max") > 1)
    kind = F.when(F.col("scale_median").isNotNull(), F.when(F.col("scale_median") < LOG_SCALE_BELOW, "log").otherwise("actual"))
    return joined.withColumns({"ok": F.coalesce(ok, F.lit(False)), "scale_kind": kind, "opacity_is_logit": logit}).drop("_o_min", "_o_max")


def diagnose_all(diagnosed: DataFrame, *groups: str) -> DataFrame:
    """Overall verdict: every scene ok."""
    return diagnosed.groupBy(*groups).agg(F.bool_and("ok").alias("ok"), F.count("*").alias("scenes"))


def summary5(rows: DataFrame, value: str, keys=("scene_id",)) -> DataFrame:
    """min, p10, p50, p90, max of the finite values; a group without any has NULLs."""
    clean = F.when(finite(value), F.col(value).cast("double"))
    return group_stats(rows, keys, {"min": (clean, 0.0), "p10": (clean, 0.1), "p50": (clean, 0.5),
                                    "p90": (clean, 0.9), "max": (clean, 1.0)})


# The ten report percentiles.
TEN_POINTS = (1, 5, 10, 25, 50, 75, 90, 95, 99, 100)


def summary10(rows: DataFrame, value: str, keys=("scene_id",)) -> DataFrame:
    c = F.col(value)
    return group_stats(rows, keys, {f"p{p}": (c, p / 100.0) for p in TEN_POINTS})


def vertex_count(splats: DataFrame, keys=("scene_id",)) -> DataFrame:
    return splats.groupBy(*keys).agg(F.count("*").alias("vertex_count"))


def candidate_metrics(diagnosed: DataFrame, listing: DataFrame, keys=("scene_id", "candidate")) -> DataFrame:
    """Diagnostics of one cloud next to its file size in MB."""
    keep = ["ok", F.col("count").alias("point_count"), "radius_p95", "radius_p99", "radius_max", "scale_kind",
            "scale_p95", "scale_p99", "scale_max", "scale_actual_p95", "scale_actual_p99", "scale_actual_max",
            "opacity_raw_p50", "opacity_raw_p95"]
    size = listing.select(*keys, round_half_even(F.col("bytes") / 1048576.0, 2).alias("size_mb"))
    return diagnosed.select(*keys, *keep).join(size, list(keys), "left")


def candidate_delta(candidates: DataFrame, base: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Differences of every candidate to its scene's base cloud; NULL where either side is."""
    cols = ["point_count", "size_mb", "radius_p99", "scale_actual_p99", "ok"]
    rows = attach(candidates, base.select(*keys, *[F.col(c).alias(f"base_{c}") for c in cols]), keys, "inner")
    diff = lambda c: F.col(c) - F.col(f"base_{c}")
    return rows.withColumns({
        "points_delta": diff("point_count"),
        "points_delta_percent": round_half_even(100.0 * diff("point_count") / F.greatest(F.lit(1), "base_point_count"), 2),
        "size_mb_delta": round_half_even(diff("size_mb"), 2),
        "radius_p99_delta": diff("radius_p99"), "scale_actual_p99_delta": diff("scale_actual_p99")})


def candidate_scores(deltas: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    grow = lambda c: F.greatest(F.lit(0.0), zero(c) - zero(f"base_{c}"))
    retention = F.col("point_count") / F.greatest(F.lit(1), "base_point_count")
    score = (100.0 - F.abs(1.0 - retention) * 60.0 - grow("radius_p99") * 10.0 - grow("scale_actual_p99") * 20.0
             - F.when(F.col("ok"), 0.0).otherwise(40.0))
    return deltas.withColumn("candidate_score", score)


def recommend_candidate(deltas: DataFrame, keys=("scene_id",), tie: str = "candidate") -> DataFrame:
    """Best-scored candidate per scene, ties to the first by name."""
    scored = candidate_scores(deltas)
    best = Window.partitionBy(*keys).orderBy(F.col("candidate_score").desc(), F.col(tie).asc())
    return scored.withColumn("_i", F.row_number().over(best)).filter("_i = 1").drop("_i")
