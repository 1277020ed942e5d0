"""Per-scene value encodings: logit or probability opacity, log or linear scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.order_stats import group_stats
from ..functions.scalars import exp_scale, nan_to_null, sigmoid
from ..functions.scaling import attach, durable

SCALES = ("scale_raw_0", "scale_raw_1", "scale_raw_2")
# Fixed value: a median scale below this can only be a logarithm.
LOG_SCALE_BELOW = -0.25


def has_scales(df: DataFrame) -> bool:
    return all(c in df.columns for c in SCALES)


def splat_encoding(splats: DataFrame, keys=("scene_id",)) -> DataFrame:
    """One row per scene: is opacity a logit, is scale a logarithm, and the median that decided it."""
    keys = list(keys)
    opacity = (F.col("opacity_raw") if "opacity_raw" in splats.columns else F.lit(None)).cast("double")
    scales = SCALES if has_scales(splats) else (F.lit(None).cast("double"),)
    seen = nan_to_null(opacity)
    stats = group_stats(splats, keys, {"scale_median": (tuple(scales), 0.5)},
                        [F.min(seen).alias("o_min"), F.max(seen).alias("o_max")])
    return stats.select(
        *keys,
        F.coalesce((F.col("o_min") < 0.0) | (F.col("o_max") > 1.0), F.lit(False)).alias("opacity_is_logit"),
        F.coalesce(F.col("scale_median") < LOG_SCALE_BELOW, F.lit(False)).alias("scale_is_log"),
        "scale_median")


def scale_kind(splats: DataFrame, keys=("scene_id",)) -> DataFrame:
    enc = splat_encoding(splats, keys)
    label = F.when(F.col("scale_median").isNotNull(), F.when(F.col("scale_is_log"), "log").otherwise("actual"))
    return enc.select(*keys, label.alias("scale_kind"))


def decode(splats: DataFrame, keys=("scene_id",), encoding: DataFrame | None = None) -> DataFrame:
    """Add `opacity` and linear `sx, sy, sz` (plus `scale_is_log`) to a raw splat table."""
    keys = list(keys)
    # written once, so that later passes over the decoded rows do not repeat the aggregate
    enc = encoding if encoding is not None else durable(splat_encoding(splats, keys))
    rows = attach(splats, enc.select(*keys, "opacity_is_logit", "scale_is_log"), keys)
    if "opacity_raw" in splats.columns:
        raw = F.col("opacity_raw").cast("double")
        opacity = F.when(F.col("opacity_is_logit"), sigmoid(raw)).otherwise(raw)
    else:
        opacity = F.lit(1.0)
    rows = rows.withColumn("opacity", opacity)
    for name, raw in zip(("sx", "sy", "sz"), SCALES):
        if has_scales(splats):
            s = F.col(raw).cast("double")
            value = F.when(F.isnan(s), s).when(F.col("scale_is_log"), exp_scale(s)).otherwise(s)
        else:
            value = F.lit(None).cast("double")
        rows = rows.withColumn(name, value)
    return rows.drop("opacity_is_logit")


