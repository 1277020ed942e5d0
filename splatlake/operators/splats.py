"""Splat-cloud operators: derived columns, filters, crops, ladders, export order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.order_stats import evenly_spaced, group_stats, kth_rank, lower_median, lower_median_rank, rank_stats, ranked
from ..functions.scalars import (SH_C0, all_finite, clip, col, distance, finite, max_ignoring_nan, norm, to_byte)
from ..functions.scaling import attach, durable
from .encodings import decode, has_scales

XYZ = ("x", "y", "z")
CENTER = ("cx", "cy", "cz")
QUAT = ("rot_0", "rot_1", "rot_2", "rot_3")
DC = ("f_dc_0", "f_dc_1", "f_dc_2")


# ---- derived columns -------------------------------------------------------

def with_max_scale(splats: DataFrame) -> DataFrame:
    return splats.withColumn("max_scale", max_ignoring_nan("sx", "sy", "sz"))


def medians(splats: DataFrame, keys=("scene_id",), where: Column | None = None, size_of=None) -> DataFrame:
    """Per-scene median of x, y, z as cx, cy, cz; rows outside `where` are left out."""
    pick = lambda c: F.when(where, F.col(c)) if where is not None else c
    return group_stats(splats, keys, {n: (pick(c), 0.5) for n, c in zip(CENTER, XYZ)}, size_of=size_of)


def dist_to_center(splats: DataFrame, keys=("scene_id",), centers: DataFrame | None = None) -> DataFrame:
    """Add `dist`, the distance to the per-scene centre (the median unless given)."""
    centers = durable(medians(splats, keys)) if centers is None else centers
    return attach(splats, centers.select(*keys, *CENTER), keys).withColumn("dist", distance(XYZ, CENTER))


def dist_to_seed(splats: DataFrame, seed=(0.0, 0.0, 0.0)) -> DataFrame:
    return splats.withColumn("dist", distance(XYZ, [F.lit(float(s)) for s in seed]))


def normalize_quat(splats: DataFrame) -> DataFrame:
    length = norm(*QUAT)
    return splats.withColumns({c: F.try_divide(F.col(c), length) for c in QUAT})


def sh_to_rgb(splats: DataFrame) -> DataFrame:
    return splats.withColumns({n: clip(0.5 + SH_C0 * F.col(c), 0.0, 1.0) for n, c in zip("rgb", DC)})


def quat_to_u8(splats: DataFrame) -> DataFrame:
    return splats.withColumns({f"rot_u8_{i}": F.floor((clip(c, -1.0, 1.0) + 1.0) / 2.0 * 255.0).cast("smallint")
                               for i, c in enumerate(QUAT)})


def rgba_to_u8(splats: DataFrame) -> DataFrame:
    return splats.withColumns({"red_u8": to_byte("r"), "green_u8": to_byte("g"), "blue_u8": to_byte("b"),
                               "alpha_u8": to_byte("opacity")})


def default_splat_fields(splats: DataFrame) -> DataFrame:
    """Fill the columns an export needs when the source cloud does not carry them."""
    have = set(splats.columns)
    add: dict[str, Column] = {}
    if not has_scales(splats):
        add |= {c: F.lit(0.01) for c in ("sx", "sy", "sz") if c not in have}
    if "rot_0" not in have:
        add |= {c: F.lit(v) for c, v in zip(QUAT, (1.0, 0.0, 0.0, 0.0))}
    if "opacity_raw" not in have and "opacity" not in have:
        add["opacity"] = F.lit(0.5)
    if DC[0] not in have:
        colors = ("red", "green", "blue")
        add |= {n: (F.col(c) / 255.0 if "red" in have else F.lit(0.5)) for n, c in zip("rgb", colors)}
    return splats.withColumns(add) if add else splats


def preview_color(splats: DataFrame) -> DataFrame:
    """Contact-sheet colour bytes; a different formula from `sh_to_rgb`."""
    have = set(splats.columns)
    names = ("preview_r", "preview_g", "preview_b")
    if set(DC) <= have:
        values = [F.floor(clip((F.col(c) + 0.5) * 255.0, 0.0, 255.0)) for c in DC]
    elif {"red", "green", "blue"} <= have:
        values = [F.col(c) for c in ("red", "green", "blue")]
    else:
        values = [F.lit(210)] * 3
    return splats.withColumns({n: v.cast("smallint") for n, v in zip(names, values)})


def points_to_splats(points: DataFrame, init_opacity: float = 0.5) -> DataFrame:
    """Initial splats of a point cloud: colour to DC coefficient, identity rotation, one opacity logit."""
    dc = {n: (F.col(c) / 255.0 - 0.5) / SH_C0 for n, c in zip(DC, ("red", "green", "blue"))}
    quat = {c: F.lit(v) for c, v in zip(QUAT, (1.0, 0.0, 0.0, 0.0))}
    return points.withColumns({**dc, **quat, "opacity_raw": F.lit(math.log(init_opacity / (1.0 - init_opacity)))})


def clamp_scene_bounds(splats: DataFrame, extents: DataFrame, keys=("scene_id",), max_fraction: float = 0.10) -> DataFrame:
    """Cap linear scales at a share of the scene extent and pull far points onto twice the extent."""
    rows = attach(splats, extents.select(*keys, "extent"), keys)
    limit = F.col("extent") * 2.0
    length = norm(*XYZ)
    shrink = F.when(length > limit, limit / length).otherwise(F.lit(1.0))
    rows = rows.withColumns({c: F.least(F.col(c), F.col("extent") * max_fraction) for c in ("sx", "sy", "sz")})
    rows = rows.withColumn("_shrink", shrink)
    return rows.withColumns({c: F.col(c) * F.col("_shrink") for c in XYZ}).drop("_shrink", "extent")


def scene_extent(centers: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Radius of the camera centres about their mean (at least 0.01) and twice that as extent."""
    means = centers.groupBy(*keys).agg(*[F.avg(c).alias(n) for n, c in zip(CENTER, XYZ)])
    spread = attach(centers, means, keys).groupBy(*keys).agg(F.max(distance(XYZ, CENTER)).alias("far"))
    return (spread.withColumn("radius", F.greatest("far", F.lit(0.01)))
            .select(*keys, "radius", (F.col("radius") * 2.0).alias("extent")))


def recenter_scene(points: DataFrame, cameras: DataFrame, keys=("scene_id",)) -> tuple[DataFrame, DataFrame]:
    """Subtract each scene's mean point from its points and its camera centres."""
    means = points.groupBy(*keys).agg(*[F.avg(c).alias(n) for n, c in zip(CENTER, XYZ)])
    def moved(rows):
        shifted = attach(rows, means, keys)
        return shifted.withColumns({c: F.col(c) - F.col(m) for c, m in zip(XYZ, CENTER)}).drop(*CENTER)
    return moved(points), moved(cameras)


# ---- filters ---------------------------------------------------------------

def finite_only(splats: DataFrame) -> DataFrame:
    return splats.filter(all_finite(*XYZ, "opacity"))


def min_opacity(splats: DataFrame, threshold: float) -> DataFrame:
    return splats.filter(F.col("opacity") >= threshold)


def opacity_ladder(splats: DataFrame, thresholds, keys=("scene_id",)) -> DataFrame:
    """Kept (strictly above) and pruned counts per scene and threshold, in one pass."""
    steps = list(thresholds)
    counted = splats.groupBy(*keys).agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("opacity") > float(t)).alias(f"_k{i}") for i, t in enumerate(steps)])
    rows = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_k{i}").alias("kept"))
                               for i, t in enumerate(steps)]))
    return (counted.select(*keys, "total", rows.alias("s"))
            .select(*keys, "s.threshold", "s.kept", (F.col("total") - F.col("s.kept")).alias("pruned"),
                    (100.0 * F.col("s.kept") / F.greatest(F.lit(1), "total")).alias("kept_percent")))


def opacity_subset(splats: DataFrame, threshold: float) -> DataFrame:
    return splats.filter(F.col("opacity") > threshold)


def max_radius(splats: DataFrame, limit: float, seed=(0.0, 0.0, 0.0)) -> DataFrame:
    if limit <= 0:
        return splats
    return splats.filter(distance(XYZ, [F.lit(float(s)) for s in seed]) <= limit)


def max_scale(splats: DataFrame, limit: float) -> DataFrame:
    if limit <= 0 or "sx" not in splats.columns:
        return splats
    widest = max_ignoring_nan("sx", "sy", "sz")
    return splats.filter(widest.isNull() | (widest <= limit))


def retention_guard(kept: DataFrame, total: DataFrame, min_retention: float, keys=("scene_id",), strict: bool = False) -> DataFrame:
    """Counts, removed and retention percent per scene, with a pass or fail status."""
    before = total.groupBy(*keys).agg(F.count("*").alias("input_count"))
    after = kept.groupBy(*keys).agg(F.count("*").alias("output_count"))
    rows = before.join(after, list(keys), "left").withColumn("output_count", F.coalesce("output_count", F.lit(0)))
    return _retention(rows, min_retention, strict)


def _retention(rows: DataFrame, min_retention: float, strict: bool) -> DataFrame:
    n = F.greatest(F.lit(1), F.col("input_count"))
    rows = rows.withColumns({
        "removed_count": F.col("input_count") - F.col("output_count"),
        "removed_percent": (F.col("input_count") - F.col("output_count")) / n * 100.0,
        "retention_percent": F.col("output_count") / n * 100.0})
    low = F.col("output_count") / n < min_retention
    status = F.when(low, F.raise_error(F.concat(F.lit("retention too low: "), F.col("retention_percent").cast("string")))
                    if strict else F.lit("below_min_retention")).otherwise(F.lit("ok"))
    return rows.withColumn("status", status)


def confidence_filter(splats: DataFrame, opacity_min: float = 0.0, max_scale: float = 0.0, radius_percentile: float = 0.0,
                      radius_margin: float = 0.0, keys=("scene_id",)) -> DataFrame:
    """Add `keep`: finite, opaque enough, small enough, and inside a percentile radius of the median centre."""
    keys = list(keys)
    rows = decode(splats, keys).withColumn("_finite", all_finite(*XYZ, "opacity"))
    rows = with_max_scale(rows)
    keep = F.col("_finite")
    if opacity_min > 0:
        keep = keep & (F.col("opacity") >= opacity_min)
    if max_scale > 0 and has_scales(splats):
        keep = keep & finite("max_scale") & (F.col("max_scale") <= max_scale)
    if radius_percentile > 0:
        centers = durable(medians(rows, keys, F.col("_finite"), size_of=splats))
        rows = dist_to_center(rows, keys, centers).drop(*CENTER)
        limits = group_stats(rows, keys, {"_p": (F.when(F.col("_finite"), F.col("dist")), radius_percentile / 100.0)}, size_of=splats)
        rows = attach(rows, limits.select(*keys, (F.col("_p") + radius_margin).alias("radius_limit")), keys)
        keep = keep & (F.col("dist") <= F.col("radius_limit"))
    return rows.withColumn("keep", F.coalesce(keep, F.lit(False))).drop("_finite")


def flagged_report(flagged: DataFrame, min_retention: float, keys=("scene_id",), strict: bool = False) -> DataFrame:
    """Retention report of a frame that carries a boolean `keep` column; one aggregation."""
    rows = flagged.groupBy(*keys).agg(F.count("*").alias("input_count"), F.count_if("keep").alias("output_count"))
    return _retention(rows, min_retention, strict)


def core_crop(splats: DataFrame, core_opacity_percentile: float = 80.0, lower: float = 0.5, upper: float = 99.5,
              margin: float = 0.12, max_scale: float = 0.0, min_core: int = 1000, keys=("scene_id",)) -> DataFrame:
    """Add the box of the high-opacity core, its point count, `core_ok` and `keep`."""
    keys = list(keys)
    rows = decode(splats, keys).withColumn("_finite", all_finite(*XYZ, "opacity"))
    floor = group_stats(rows, keys, {"_floor": (F.when(F.col("_finite"), F.col("opacity")), core_opacity_percentile / 100.0)}, size_of=splats)
    rows = attach(rows, durable(floor), keys)
    core = F.col("_finite") & (F.col("opacity") >= F.col("_floor"))
    if max_scale > 0 and has_scales(splats):
        core = core & (max_ignoring_nan("sx", "sy", "sz") <= max_scale)
    rows = rows.withColumn("_core", core)
    specs = {}
    for a in XYZ:
        inside = F.when(F.col("_core"), F.col(a))
        specs |= {f"{a}_lo": (inside, lower / 100.0), f"{a}_hi": (inside, upper / 100.0)}
    box = group_stats(rows, keys, specs, [F.count_if("_core").alias("core_count")], size_of=splats)
    box = box.select(*keys, "core_count", (F.col("core_count") >= min_core).alias("core_ok"),
                     *[(F.col(f"{a}_lo") - margin).alias(f"{a}_lo") for a in XYZ],
                     *[(F.col(f"{a}_hi") + margin).alias(f"{a}_hi") for a in XYZ])
    rows = attach(rows, box, keys)
    keep = F.col("_finite")
    for a in XYZ:
        keep = keep & F.col(a).between(F.col(f"{a}_lo"), F.col(f"{a}_hi"))
    return rows.withColumn("keep", F.coalesce(keep, F.lit(False))).drop("_finite", "_floor", "_core")


def scene_radius_robust(splats: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Lower-median centre and max(3 x lower-median distance, 1.2 x k95 distance, 0.01) per scene."""
    keys = list(keys)
    axes = F.explode(F.array(*[F.struct(F.lit(n).alias("axis"), F.col(c).cast("double").alias("v")) for n, c in zip(CENTER, XYZ)]))
    per_axis = lower_median(splats.select(*keys, axes.alias("a")).select(*keys, "a.axis", "a.v"), [*keys, "axis"], "v", size_of=splats)
    centers = durable(per_axis.groupBy(*keys).agg(*[F.max(F.when(F.col("axis") == n, F.col("value"))).alias(n) for n in CENTER]))
    dist = dist_to_center(splats, keys, centers).select(*keys, "dist")
    spread = rank_stats(dist, keys, "dist", {"median_dist": lower_median_rank(), "p95_dist": kth_rank(0.95), "p99_dist": kth_rank(0.99)}, size_of=splats)
    radius = F.greatest(F.col("median_dist") * 3.0, F.col("p95_dist") * 1.2, F.lit(0.01))
    return centers.join(spread, keys, "left").withColumn("scene_radius", radius)


def geometry_prune(splats: DataFrame, max_scale_relative: float = 0.15, keys=("scene_id",)) -> DataFrame:
    """Add `keep`: largest axis and distance strictly below limits taken from the robust scene radius."""
    keys = list(keys)
    stats = durable(scene_radius_robust(splats, keys))
    rows = with_max_scale(attach(decode(splats, keys), stats, keys)).withColumn("dist", distance(XYZ, CENTER))
    reach = F.least(F.col("p99_dist"), F.col("scene_radius") * 2.0)
    keep = (F.col("max_scale") < F.col("scene_radius") * max_scale_relative) & (F.col("dist") < reach)
    return rows.withColumn("keep", F.coalesce(keep, F.lit(False)))


# ---- order and sampling ----------------------------------------------------

def top_opacity(splats: DataFrame, n: int, keys=("scene_id",), tie: str = "point_id") -> DataFrame:
    """The n most opaque splats of each scene, ties by id.

    For an n up to Spark's window group limit every task keeps its own n best of a scene and only those are moved.
    """
    order = [F.col("opacity").desc(), F.col(tie).asc()]
    if n <= int(splats.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        rows = splats.withColumn("opacity_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return rows.filter(F.col("opacity_rank") <= n).withColumn("opacity_rank", F.col("opacity_rank").cast("bigint"))
    return ranked(splats, keys, order, "opacity_rank").filter(F.col("opacity_rank") <= n)


def depth_keys(splats: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Add `depth`: squared distance to the mean centre pushed 3 units along z."""
    means = splats.groupBy(*keys).agg(*[F.avg(c).alias(n) for n, c in zip(CENTER, XYZ)])
    eye = [F.col("cx"), F.col("cy"), F.col("cz") + 3.0]
    squared = sum((F.col(a) - e) * (F.col(a) - e) for a, e in zip(XYZ, eye))
    return attach(splats, means, keys).withColumn("depth", squared).drop(*CENTER)


def depth_sort(splats: DataFrame, keys=("scene_id",), tie: str = "point_id") -> DataFrame:
    """Back-to-front order of each scene as `depth_rank`."""
    return ranked(depth_keys(splats, keys), keys, [F.col("depth").desc(), F.col(tie).asc()], "depth_rank", size_of=splats)


def stride_sample(rows: DataFrame, n: int, order, keys=("scene_id",)) -> DataFrame:
    """Rows at trunc(linspace(0, N-1, n)); every row when a scene has at most n."""
    keys = list(keys)
    numbered = ranked(rows, keys, order)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = attach(numbered, sizes, keys)
    return rows.filter(evenly_spaced(F.col("ordinal") - 1, "_n", n, F.floor)).drop("_n")


# ---- projections for previews ----------------------------------------------

# Panel name and the horizontal and vertical axis it shows.
VIEWS = (("front", "x", "z"), ("side", "y", "z"), ("top", "x", "y"))


def ortho_project(splats: DataFrame, size: int = 520, margin: int = 28, keys=("scene_id",)) -> DataFrame:
    """Pixel position of every splat in three axis-aligned panels, out-of-panel rows dropped."""
    keys = list(keys)
    rows = dist_to_center(splats, keys)
    reach = group_stats(rows, keys, {"radius": ("dist", 0.99)}, size_of=splats)
    rows = attach(rows, reach, keys)
    zoom = (size - margin * 2) / F.greatest(F.col("radius") * 2.0, F.lit(1e-6))
    off = dict(zip(XYZ, [F.col(a) - F.col(c) for a, c in zip(XYZ, CENTER)]))
    trunc = lambda c: F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("int")
    panels = F.array(*[F.struct(F.lit(v).alias("view"), trunc(off[a] * zoom + size / 2).alias("px"),
                                trunc(size / 2 - off[b] * zoom).alias("py")) for v, a, b in VIEWS])
    return (rows.withColumn("p", F.explode(panels)).select("*", "p.view", "p.px", "p.py")
            .drop("p", *CENTER, "radius", "dist")
            .filter(F.col("px").between(0, size - 1) & F.col("py").between(0, size - 1)))


def ortho_tiles(projected: DataFrame, color_cols, order: str = "point_id", keys=("scene_id",)) -> DataFrame:
    """Per panel pixel: splat count and the colour of the last splat written."""
    last = F.max_by(F.struct(*color_cols), F.col(order))
    return (projected.groupBy(*keys, "view", "px", "py").agg(F.count("*").alias("n"), last.alias("c"))
            .select(*keys, "view", "px", "py", "n", *[F.col(f"c.{c}").alias(c) for c in color_cols]))


def turntable_project(splats: DataFrame, angles, width: int = 640, height: int = 360, keys=("scene_id",)) -> DataFrame:
    """Pinhole position, depth and disc size of every splat seen from each orbit angle."""
    keys = list(keys)
    rows = dist_to_center(splats, keys)
    reach = group_stats(rows, keys, {"_r": ("dist", 0.995)}, size_of=splats)
    rows = attach(rows, reach, keys).withColumn("cam_dist", F.greatest("_r", F.lit(1e-3)) * 3.2)
    focal = min(width, height) * 0.95
    seen = []
    for i, angle in enumerate(angles):
        ca, sa, lift = math.cos(angle), math.sin(angle), 0.35
        # The eye lies at cam_dist * (ca, sa, lift) from the centre, so the axes are the same for every scene.
        length = math.sqrt(1.0 + lift * lift)
        zax = (ca / length, sa / length, lift / length)
        xax = (-sa, ca, 0.0)
        yax = (zax[1] * xax[2] - zax[2] * xax[1], zax[2] * xax[0] - zax[0] * xax[2], zax[0] * xax[1] - zax[1] * xax[0])
        rel = [F.col(a) - (F.col(c) + F.col("cam_dist") * e) for a, c, e in zip(XYZ, CENTER, (ca, sa, lift))]
        dot = lambda ax: rel[0] * ax[0] + rel[1] * ax[1] + rel[2] * ax[2]
        seen.append(F.struct(F.lit(i).alias("angle_no"), dot(xax).alias("cam_x"), dot(yax).alias("cam_y"), (-dot(zax)).alias("cam_z")))
    rows = (rows.withColumn("v", F.explode(F.array(*seen))).select("*", "v.*").drop("v", "_r", "cam_dist", "dist", *CENTER)
            .filter(F.col("cam_z") > 1e-4))
    mean_scale = (F.col("sx") + F.col("sy") + F.col("sz")) / 3.0
    rows = rows.withColumns({"px": width * 0.5 + focal * F.col("cam_x") / F.col("cam_z"),
                             "py": height * 0.5 - focal * F.col("cam_y") / F.col("cam_z"),
                             "disc": clip((mean_scale * focal / F.col("cam_z")) * 3.0, 1.0, 6.0)})
    inside = (F.col("px") >= -20) & (F.col("px") < width + 20) & (F.col("py") >= -20) & (F.col("py") < height + 20)
    return rows.filter(inside).drop("cam_x", "cam_y").withColumnRenamed("cam_z", "depth")
