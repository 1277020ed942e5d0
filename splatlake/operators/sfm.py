"""Structure-from-motion tables: intrinsics, poses, view building, registration reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import problem_list, round_half_even
from ..functions.scaling import attach
from .frames import stem

# Camera model ids, names and parameter counts; the first four share one focal length where noted.
MODEL_NAMES = {0: "SIMPLE_PINHOLE", 1: "PINHOLE", 2: "SIMPLE_RADIAL", 3: "RADIAL", 4: "OPENCV", 5: "OPENCV_FISHEYE", 6: "FULL_OPENCV"}
PARAM_COUNTS = {0: 3, 1: 4, 2: 4, 3: 5, 4: 8, 5: 8, 6: 12}
SHARED_FOCAL = (0, 2, 3)


def _shared() -> Column:
    return F.col("model_id").isin(*SHARED_FOCAL)


def intrinsics(cameras: DataFrame, params: str = "params") -> DataFrame:
    """Add fx, fy, cx, cy taken from the model's parameter list."""
    p = lambda i: F.get(F.col(params), F.lit(i))
    return cameras.withColumns({"fx": p(0), "fy": F.when(_shared(), p(0)).otherwise(p(1)),
                                "cx": F.when(_shared(), p(1)).otherwise(p(2)), "cy": F.when(_shared(), p(2)).otherwise(p(3))})


def rotation_exprs(qw="qw", qx="qx", qy="qy", qz="qz") -> list[list[Column]]:
    """3x3 rotation of a unit quaternion, row by row."""
    w, x, y, z = (F.col(c) for c in (qw, qx, qy, qz))
    return [[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
            [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
            [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]]


def quat_to_rotmat(images: DataFrame) -> DataFrame:
    r = rotation_exprs()
    return images.withColumns({f"r{i}{j}": r[i][j] for i in range(3) for j in range(3)})


def camera_to_world(images: DataFrame) -> DataFrame:
    """Add `camtoworld` (4x4) and the camera centre: the closed-form inverse of the world-to-camera pose."""
    r, t = rotation_exprs(), [F.col(c) for c in ("tx", "ty", "tz")]
    center = [-(r[0][i] * t[0] + r[1][i] * t[1] + r[2][i] * t[2]) for i in range(3)]
    rows = [F.array(r[0][i], r[1][i], r[2][i], center[i]) for i in range(3)]
    last = F.array(*[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])
    return images.withColumns({"camtoworld": F.array(*rows, last), **{f"center_{a}": c for a, c in zip("xyz", center)}})


def effective_scale(cameras: DataFrame, dims: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Per-axis scale from the reconstruction's frame size to the current one, with warnings.

    The first camera of a scene gives the original size; `dims` has new_width and new_height.
    """
    first = cameras.groupBy(*keys).agg(F.min_by(F.struct("width", "height"), "camera_id").alias("o"))
    rows = first.join(dims, list(keys)).select(*keys, F.col("o.width").alias("width"), F.col("o.height").alias("height"), "new_width", "new_height")
    one = F.lit(1)
    rows = rows.withColumns({"scale_w": F.col("new_width") / F.greatest("width", one), "scale_h": F.col("new_height") / F.greatest("height", one)})
    gap = F.abs(F.col("width") / F.greatest("height", one) - F.col("new_width") / F.greatest("new_height", one))
    same = (F.abs(F.col("scale_w") - 1.0) < 0.01) & (F.abs(F.col("scale_h") - 1.0) < 0.01)
    return rows.withColumns({"aspect_mismatch": gap > 0.05, "is_identity": same})


def scale_intrinsics(cameras: DataFrame, scales: DataFrame | None = None, keys=("scene_id",), params: str = "params") -> DataFrame:
    """Scale focal lengths and principal points per axis; distortion stays, sizes are rounded half to even."""
    rows = attach(cameras, scales.select(*keys, "scale_w", "scale_h"), keys) if scales is not None else cameras
    sw, sh = F.col("scale_w"), F.col("scale_h")
    shared = F.array(F.sqrt(sw * sh), sw, sh)
    split = F.array(sw, sh, sw, sh)
    factors = F.when(_shared(), shared).otherwise(split)
    scaled = F.transform(params, lambda p, i: F.when(i < F.size("_f"), p * F.get(F.col("_f"), i)).otherwise(p))
    return (rows.withColumn("_f", factors).withColumn(params, scaled).drop("_f")
            .withColumns({"width": F.rint(F.col("width") * sw).cast("bigint"), "height": F.rint(F.col("height") * sh).cast("bigint")}))


def field_of_view(size: str, focal: str) -> Column:
    return F.degrees(2.0 * F.atan(F.col(size) / (2.0 * F.col(focal))))


def validate_intrinsics(views: DataFrame, strict: bool = False, expected=("image_width", "image_height")) -> DataFrame:
    """Add `violations` of plausibility rules; strict mode fails the job on the first one."""
    ratio = F.greatest("fx", "fy") / F.greatest(F.least("fx", "fy"), F.lit(1e-6))
    off = lambda c, size: ~F.col(c).between(0.3 * F.col(size), 0.7 * F.col(size))
    odd = lambda fov: ~fov.between(8.0, 160.0)
    rules = {"cx_off_center": off("cx", "width"), "cy_off_center": off("cy", "height"),
             "fov_x_out_of_range": odd(field_of_view("width", "fx")), "fov_y_out_of_range": odd(field_of_view("height", "fy")),
             "focal_ratio": ratio >= 2.0}
    for size, want in zip(("width", "height"), expected):
        if want in views.columns:
            rules[f"{size}_mismatch"] = F.col(size) != F.col(want)
    found = problem_list(*[F.when(test, name) for name, test in rules.items()])
    rows = views.withColumn("violations", found)
    if strict:
        fail = F.raise_error(F.concat(F.lit("intrinsics violate: "), F.array_join("violations", ", "))).cast("array<string>")
        rows = rows.withColumn("violations", F.when(F.size("violations") > 0, fail).otherwise(F.col("violations")))
    return rows


def resolve_image_names(images: DataFrame, files: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Add `resolved_name`: the exact file, else the same stem as png, jpg or jpeg; NULL when unmatched."""
    keys = list(keys)
    have = files.select(*keys, "name").distinct()
    exact = have.select(*keys, "name", F.col("name").alias("_exact"))
    ending = F.regexp_extract("name", r"\.([^./]+)$", 1)
    rank = F.when(ending == "png", 1).when(ending == "jpg", 2).when(ending == "jpeg", 3)
    by_stem = have.withColumns({"_rank": rank, "_stem": stem("name")}).filter("_rank IS NOT NULL").groupBy(*keys, "_stem").agg(F.min_by("name", "_rank").alias("_alt"))
    rows = images.join(exact, [*keys, "name"], "left").withColumn("_stem", stem("name")).join(by_stem, [*keys, "_stem"], "left")
    return rows.withColumn("resolved_name", F.coalesce("_exact", "_alt")).drop("_exact", "_alt", "_stem")


def build_views(images: DataFrame, cameras: DataFrame, files: DataFrame, keys=("scene_id",)) -> DataFrame:
    """One row per image with a file: pose, 3x3 intrinsics and size."""
    keys = list(keys)
    named = resolve_image_names(images, files, keys).filter("resolved_name IS NOT NULL")
    cams = intrinsics(cameras).select(*keys, "camera_id", "fx", "fy", "cx", "cy", "width", "height")
    rows = camera_to_world(attach(named, cams, [*keys, "camera_id"], "inner"))
    z = F.lit(0.0)
    matrix = F.array(F.array("fx", z, "cx"), F.array(z, F.col("fy"), F.col("cy")), F.array(z, z, F.lit(1.0)))
    return rows.select(*keys, "image_id", F.col("resolved_name").alias("image_name"), "camtoworld", matrix.alias("k"), "width", "height")


def crop_views(views: DataFrame, windows: DataFrame, keys=("scene_id",)) -> DataFrame:
    """Shift the principal point by the crop's corner and take its size."""
    rows = attach(views, windows.select(*keys, "left", "top", "right", "bottom"), keys)
    return rows.withColumns({"cx": F.col("cx") - F.col("left"), "cy": F.col("cy") - F.col("top"),
                             "width": F.col("right") - F.col("left"), "height": F.col("bottom") - F.col("top")}).drop("left", "top", "right", "bottom")


def staleness(recorded: DataFrame, current: DataFrame, keys=("scene_id",), name: str = "path", facts=("size", "mtime_ns", "width", "height")) -> DataFrame:
    """Changed, added and removed files per scene between two listings; stale when there is any."""
    sig = lambda rows, mark: rows.select(*keys, name, F.struct(*facts).alias(mark))
    both = sig(recorded, "old").join(sig(current, "new"), [*keys, name], "full_outer")
    differs = ~F.col("old").eqNullSafe(F.col("new"))
    out = both.groupBy(*keys).agg(
        F.count_if(F.col("old").isNull()).alias("added"), F.count_if(F.col("new").isNull()).alias("removed"),
        F.count_if(differs & F.col("old").isNotNull() & F.col("new").isNotNull()).alias("changed"))
    return out.withColumn("stale", F.col("added") + F.col("removed") + F.col("changed") > 0)


def registration_stats(frame_counts: DataFrame, images: DataFrame, points: DataFrame, keys=("scene_id",), min_registered: int = 24,
                       min_ratio: float = 0.45) -> DataFrame:
    """Registered images and points of each scene against its frame count, with quality flags."""
    count = lambda rows, alias: rows.groupBy(*keys).agg(F.count("*").alias(alias))
    rows = frame_counts.join(count(images, "registered_images"), list(keys), "left").join(count(points, "points3d"), list(keys), "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("registered_images", "points3d")})
    return _registration(rows, min_registered, min_ratio)


def _registration(rows: DataFrame, min_registered: int, min_ratio: float) -> DataFrame:
    n = F.greatest(F.lit(1), "image_count")
    ratio = F.col("registered_images") / n
    need = F.least(F.lit(max(1, min_registered)), n)
    enough, dense = F.col("registered_images") >= need, ratio >= min_ratio
    return rows.withColumns({"registered_ratio": round_half_even(ratio, 4), "min_registered_images": need.cast("int"),
                             "meets_min_registered_images": enough, "meets_min_registered_ratio": dense, "meets_quality_target": enough & dense})


def attempt_sequence(requests: DataFrame, first: str = "camera_model", more: str = "candidates") -> DataFrame:
    """Add `sequence`: the wanted models upper-cased, each once, in order; SIMPLE_PINHOLE when none is named."""
    named = F.transform(F.concat(F.array(F.col(first)), F.col(more)), lambda m: F.upper(F.trim(m)))
    kept = F.array_distinct(F.filter(named, lambda m: F.length(m) > 0))
    return requests.withColumn("sequence", F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit("SIMPLE_PINHOLE"))))


def attempt_ladder(attempts: DataFrame, keys=("scene_id",), order: str = "attempt_no", min_registered: int = 24, min_ratio: float = 0.45) -> DataFrame:
    """Chosen attempt per scene: the first one on target, else the best successful one.

    `attempts` has image_count, camera_model, ok, registered_images, points3d.
    """
    rows = _registration(attempts, min_registered, min_ratio).withColumn("meets_quality_target", F.col("ok") & F.col("meets_quality_target"))
    facts = F.struct(order, "camera_model", "registered_images", "registered_ratio", "points3d", "meets_quality_target")
    first = F.min_by(facts, F.when(F.col("meets_quality_target"), F.col(order)))
    score = F.when(F.col("ok"), F.struct("registered_ratio", "registered_images", "points3d", (-F.col(order)).alias("early")))
    picked = rows.groupBy(*keys).agg(F.coalesce(first, F.max_by(facts, score)).alias("c"))
    lost = F.col("c").isNull()
    zero = lambda c, v: F.when(lost, F.lit(v)).otherwise(F.col(f"c.{c}")).alias(c)
    tried = F.col(f"c.{order}")
    return picked.select(*keys, (~lost).alias("ok"), F.when(lost, "").otherwise(F.col("c.camera_model")).alias("selected_camera_model"),
                         zero("registered_images", 0), zero("registered_ratio", 0.0), zero("points3d", 0), zero("meets_quality_target", False), tried.alias(order))


def largest_reconstruction(models: DataFrame, keys=("scene_id",), model: str = "model_no") -> DataFrame:
    """Model with the most registered images per scene, the lowest number on ties."""
    best = F.max_by(F.struct(model, "registered_images", "points3d"), F.struct("registered_images", (-F.col(model)).alias("early")))
    return models.groupBy(*keys).agg(best.alias("m")).select(*keys, "m.*")
