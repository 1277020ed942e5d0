"""Per-image measurements as vectorised pandas UDFs over pixel columns.

Pixels arrive either as an array of gray levels or as the bytes of Spark's image
source (blue, green, red per pixel); a task turns each row into one NumPy array.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T


def _array(data, width: int, height: int, channels: int) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8) if isinstance(data, (bytes, bytearray, memoryview)) else np.asarray(data)
    return flat.reshape(height, width, channels) if channels > 1 else flat.reshape(height, width)


def _gray(image: np.ndarray) -> np.ndarray:
    """Rounded luma of a BGR image; gray passes through."""
    if image.ndim == 2:
        return image.astype(np.uint8)
    b, g, r = (image[..., i].astype(np.float64) for i in range(3))
    return np.floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5).astype(np.uint8)


def _resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Triangle-filter resampling; widens its support when shrinking, so it does not alias."""
    def weights(n_in, n_out):
        scale = n_in / n_out
        reach = max(scale, 1.0)
        at = (np.arange(n_out) + 0.5) * scale - 0.5
        w = np.maximum(0.0, 1.0 - np.abs(np.arange(n_in)[None, :] - at[:, None]) / reach)
        return w / w.sum(axis=1, keepdims=True)
    out = weights(image.shape[0], height) @ image.astype(np.float64) @ weights(image.shape[1], width).T
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def _shrink(gray: np.ndarray, max_side: int) -> np.ndarray:
    h, w = gray.shape
    scale = min(1.0, max_side / max(w, h))
    return gray if scale >= 1.0 else _resize(gray, max(1, int(w * scale)), max(1, int(h * scale)))


def _laplacian_variance(gray: np.ndarray) -> float:
    p = np.pad(gray.astype(np.float64), 1, mode="reflect") if min(gray.shape) > 1 else np.pad(gray.astype(np.float64), 1, mode="edge")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4.0 * p[1:-1, 1:-1]
    return float(lap.var())


HEALTH = T.StructType([T.StructField(n, T.DoubleType()) for n in ("brightness", "contrast", "dark_ratio", "bright_ratio", "clipped_ratio", "sharpness")])


def channels_of(frames: DataFrame) -> Column:
    """The frames' channel count, 1 where they carry none."""
    return F.col("channels") if "channels" in frames.columns else F.lit(1)


def health_of(max_side: int | None = None):
    @F.pandas_udf(HEALTH)
    def health(data: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series) -> pd.DataFrame:
        rows = []
        for d, w, h, c in zip(data, width, height, channels):
            gray = _gray(_array(d, w, h, c))
            if max_side:
                gray = _shrink(gray, max_side)
            dark, bright = float(np.mean(gray <= 5)), float(np.mean(gray >= 250))
            rows.append((float(gray.mean()), float(gray.std()), dark, bright, max(dark, bright), _laplacian_variance(gray)))
        return pd.DataFrame(rows, columns=[f.name for f in HEALTH])
    return health


def frame_health(frames: DataFrame, data: str = "pixels", max_side: int | None = None) -> DataFrame:
    """Add brightness, contrast, dark, bright and clipped ratios and Laplacian-variance sharpness."""
    rows = frames.withColumn("_h", health_of(max_side)(F.col(data), F.col("width"), F.col("height"), channels_of(frames)))
    return rows.select("*", "_h.*").drop("_h")


def downscale_gray(frames: DataFrame, data: str = "pixels", max_side: int = 512) -> DataFrame:
    """Replace the pixels by gray ones whose longer side is at most `max_side`; never enlarges."""
    @F.pandas_udf(T.StructType([T.StructField("pixels", T.BinaryType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
    def shrink(d: pd.Series, w: pd.Series, h: pd.Series, c: pd.Series) -> pd.DataFrame:
        small = [_shrink(_gray(_array(*args)), max_side) for args in zip(d, w, h, c)]
        return pd.DataFrame({"pixels": [s.tobytes() for s in small], "width": [s.shape[1] for s in small], "height": [s.shape[0] for s in small]})

    rows = frames.withColumn("_g", shrink(F.col(data), F.col("width"), F.col("height"), channels_of(frames))).drop(data, "width", "height", "channels")
    return rows.select("*", "_g.*").drop("_g")


def mean_abs_diff(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.abs(a.astype(np.float64) - b.astype(np.float64)).mean() / 255.0)


def frame_distance(before: np.ndarray, now: np.ndarray) -> float:
    """Mean absolute difference over 255 of two images, over all channels.

    Images of different channel counts are compared in gray; one of another size is resized to the earlier one's.
    """
    if before.shape[2:] != now.shape[2:]:
        before, now = _gray(before), _gray(now)
    h, w = before.shape[:2]
    if now.shape[:2] != (h, w):
        now = _resize(now, w, h) if now.ndim == 2 else np.stack([_resize(now[..., i], w, h) for i in range(now.shape[2])], axis=-1)
    return mean_abs_diff(before, now)


@F.pandas_udf(T.DoubleType())
def _pair_diff(prev: pd.Series, pw: pd.Series, ph: pd.Series, pc: pd.Series, cur: pd.Series, w: pd.Series, h: pd.Series, c: pd.Series) -> pd.Series:
    out = []
    for p, a, b, n, *now in zip(prev, pw, ph, pc, cur, w, h, c):
        if p is None or a is None or a != a:
            out.append(None)
            continue
        out.append(frame_distance(_gray(_array(p, int(a), int(b), int(n))), _gray(_array(now[0], *map(int, now[1:])))))
    return pd.Series(out, dtype="float64")


def consecutive_diff(frames: DataFrame, keys=("scene_id",), order: str = "raw_index", data: str = "pixels") -> DataFrame:
    """Add `frame_diff`, the mean absolute gray difference to the previous frame over 255; NULL for the first."""
    from ..functions.order_stats import lagged
    frames = frames.withColumn("_c", channels_of(frames))
    rows = lagged(frames, keys, [order], {"_p": data, "_pw": "width", "_ph": "height", "_pc": "_c"})
    diff = _pair_diff("_p", "_pw", "_ph", "_pc", F.col(data), F.col("width"), F.col("height"), F.col("_c"))
    return rows.withColumn("frame_diff", F.when(F.col("_p").isNotNull(), diff)).drop("_p", "_pw", "_ph", "_pc", "_c")


MASK = T.StructType([T.StructField("fg_ratio", T.DoubleType()), T.StructField("bbox_fill", T.DoubleType()), T.StructField("touches_edge", T.BooleanType())])


@F.pandas_udf(MASK)
def _mask_stats(data: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series) -> pd.DataFrame:
    rows = []
    for args in zip(data, width, height, channels):
        fg = _gray(_array(*args)) > 127
        if not fg.any():
            rows.append((float(fg.mean()), 0.0, False))
            continue
        ys, xs = np.nonzero(fg)
        x0, x1, y0, y1 = xs.min(), xs.max(), ys.min(), ys.max()
        near = x0 <= 2 or y0 <= 2 or x1 >= fg.shape[1] - 3 or y1 >= fg.shape[0] - 3
        rows.append((float(fg.mean()), float(fg.sum() / ((x1 - x0 + 1) * (y1 - y0 + 1))), bool(near)))
    return pd.DataFrame(rows, columns=[f.name for f in MASK])


def mask_stats(masks: DataFrame, data: str = "pixels") -> DataFrame:
    """Add foreground ratio, fill of its bounding box, and whether it comes within two pixels of an edge."""
    channels = F.col("channels") if "channels" in masks.columns else F.lit(1)
    return masks.withColumn("_m", _mask_stats(F.col(data), F.col("width"), F.col("height"), channels)).select("*", "_m.*").drop("_m")


PAIR = T.StructType([T.StructField("psnr", T.DoubleType()), T.StructField("l1", T.DoubleType())])


@F.pandas_udf(PAIR)
def _pair_metrics(render: pd.Series, truth: pd.Series, mask: pd.Series) -> pd.DataFrame:
    rows = []
    for r, t, m in zip(render, truth, mask):
        r, t = (np.frombuffer(v, np.uint8) if isinstance(v, (bytes, bytearray)) else np.asarray(v) for v in (r, t))
        gap = (r.astype(np.float64) - t.astype(np.float64)) / 255.0
        psnr = -10.0 * math.log10(max(1e-10, float((gap ** 2).mean())))
        if m is None:
            l1 = float(np.abs(gap).mean())
        else:
            fg = (np.frombuffer(m, np.uint8) if isinstance(m, (bytes, bytearray)) else np.asarray(m)).astype(np.float64)
            fg = np.repeat(fg, len(gap) // len(fg))
            weight = fg * 1.0 + (1.0 - fg) * 0.05
            l1 = float((np.abs(gap) * weight).sum() / max(float(weight.sum()), 1e-6))
        rows.append((psnr, l1))
    return pd.DataFrame(rows, columns=["psnr", "l1"])


def image_pair_metrics(pairs: DataFrame, render="render", truth="truth", mask: str | None = None) -> DataFrame:
    """Add PSNR and (mask-weighted, background 0.05) L1 of two equally sized images."""
    m = F.col(mask) if mask else F.lit(None).cast(pairs.schema[render].dataType)
    return pairs.withColumn("_m", _pair_metrics(F.col(render), F.col(truth), m)).select("*", "_m.*").drop("_m")


BLANK = T.StructType([T.StructField("mean", T.ArrayType(T.DoubleType())), T.StructField("stddev", T.ArrayType(T.DoubleType())),
                      T.StructField("non_white_ratio", T.DoubleType()), T.StructField("non_black_ratio", T.DoubleType()), T.StructField("varied", T.BooleanType())])


@F.pandas_udf(BLANK)
def _blank(data: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series) -> pd.DataFrame:
    rows = []
    for d, w, h, c in zip(data, width, height, channels):
        px = _array(d, w, h, c).reshape(-1, c).astype(np.float64)
        std = px.std(axis=0)
        rows.append(([round(float(v), 3) for v in px.mean(axis=0)], [round(float(v), 3) for v in std],
                     round(float((px.min(axis=1) < 245).mean()), 4), round(float((px.max(axis=1) > 10).mean()), 4), bool(std.max() > 3.0)))
    return pd.DataFrame(rows, columns=[f.name for f in BLANK])


def blank_image_check(frames: DataFrame, data: str = "pixels") -> DataFrame:
    """Add channel means and deviations, non-white and non-black shares, and the blank-image problems."""
    from ..functions.scalars import problem_list
    channels = F.col("channels") if "channels" in frames.columns else F.lit(1)
    rows = frames.withColumn("_b", _blank(F.col(data), F.col("width"), F.col("height"), channels)).select("*", "_b.*").drop("_b")
    # Problem texts, in report order.
    problems = problem_list(F.when(~F.col("varied"), "screenshot has too little pixel variation"),
                            F.when(F.col("non_white_ratio") < 0.05, "screenshot appears mostly white/blank"),
                            F.when(F.col("non_black_ratio") < 0.05, "screenshot appears mostly black/blank"))
    return rows.withColumn("problems", problems)


# ---- cube faces ------------------------------------------------------------

# Yaw and pitch in degrees of each cube face.
FACES = {"front": (0.0, 0.0), "right": (90.0, 0.0), "back": (180.0, 0.0), "left": (-90.0, 0.0), "up": (0.0, 90.0), "down": (0.0, -90.0)}


def cube_face_map(rows: DataFrame, faces=tuple(FACES), size: str = "face_size", fov: float = 90.0) -> DataFrame:
    """For every row's face size: (face, row, col) to the normalised equirectangular position (map_x, map_y)."""
    for f in faces:
        if f not in FACES:
            raise ValueError(f"Unsupported cube face: {f}")
    turn = F.array(*[F.struct(F.lit(f).alias("face"), F.lit(math.radians(FACES[f][0])).alias("yaw"), F.lit(math.radians(FACES[f][1])).alias("pitch")) for f in faces])
    cells = F.explode(F.sequence(F.lit(0), F.col(size) * F.col(size) - 1))
    grid = rows.withColumn("_t", F.explode(turn)).withColumn("_c", cells)
    grid = grid.withColumns({"face": F.col("_t.face"), "row": F.floor(F.col("_c") / F.col(size)).cast("int"), "col": (F.col("_c") % F.col(size)).cast("int")})
    wide = math.tan(math.radians(fov) * 0.5)
    u = ((F.col("col") + 0.5) / F.col(size) * 2.0 - 1.0) * wide
    v = -((F.col("row") + 0.5) / F.col(size) * 2.0 - 1.0) * wide
    n = F.sqrt(u * u + v * v + 1.0)
    cy, sy, cp, sp = F.cos("_t.yaw"), F.sin("_t.yaw"), F.cos("_t.pitch"), F.sin("_t.pitch")
    # pitch about x first, then yaw about y
    grid = grid.withColumns({"_dx": u / n, "_dy": v / n, "_dz": 1.0 / n})
    grid = grid.withColumns({"_py": F.col("_dy") * cp - F.col("_dz") * sp, "_pz": F.col("_dy") * sp + F.col("_dz") * cp})
    lon = F.atan2(F.col("_dx") * cy + F.col("_pz") * sy, F.col("_pz") * cy - F.col("_dx") * sy)
    lat = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_py"))))
    return grid.withColumns({"map_x": lon / (2.0 * math.pi) + 0.5, "map_y": 0.5 - lat / math.pi}).drop("_t", "_c", "_dx", "_dy", "_dz", "_py", "_pz")


def _face_grid(face: str, size: int, fov: float) -> tuple[np.ndarray, np.ndarray]:
    yaw, pitch = (math.radians(a) for a in FACES[face])
    step = ((np.arange(size) + 0.5) / size * 2.0 - 1.0) * math.tan(math.radians(fov) * 0.5)
    u, v = np.meshgrid(step, -step)
    n = np.sqrt(u * u + v * v + 1.0)
    x, y, z = u / n, v / n, 1.0 / n
    y, z = y * math.cos(pitch) - z * math.sin(pitch), y * math.sin(pitch) + z * math.cos(pitch)
    lon = np.arctan2(x * math.cos(yaw) + z * math.sin(yaw), z * math.cos(yaw) - x * math.sin(yaw))
    return lon / (2.0 * math.pi) + 0.5, 0.5 - np.arcsin(np.clip(y, -1.0, 1.0)) / math.pi


def expand_cube_faces(frames: DataFrame, face_size: int, faces=tuple(FACES), fov: float = 90.0, data: str = "pixels") -> DataFrame:
    """One perspective frame per cube face of every equirectangular frame (bilinear, wrapping)."""
    carried = [f for f in frames.schema.fields if f.name not in (data, "width", "height", "channels")]
    schema = T.StructType([*carried, T.StructField("face", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
                           T.StructField("channels", T.IntegerType()), T.StructField("pixels", T.BinaryType())])
    names = [f.name for f in carried]

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grids = {f: _face_grid(f, face_size, fov) for f in faces}  # once per task
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                c = int(row.get("channels") or 1)
                image = _array(row[data], row["width"], row["height"], c).reshape(row["height"], row["width"], c).astype(np.float64)
                h, w = image.shape[:2]
                for face, (mx, my) in grids.items():
                    x, y = mx * (w - 1), my * (h - 1)
                    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
                    fx, fy = (x - x0)[..., None], (y - y0)[..., None]
                    at = lambda yy, xx: image[yy % h, xx % w]
                    mix = (at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx) * (1 - fy) + (at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx) * fy
                    pixels = np.clip(np.floor(mix + 0.5), 0, 255).astype(np.uint8)
                    out.append([row[n] for n in names] + [face, face_size, face_size, c, pixels.tobytes()])
            yield pd.DataFrame(out, columns=[*names, "face", "width", "height", "channels", "pixels"])

    return frames.mapInPandas(expand, schema)


def face_budget(max_frames: int, min_frames: int, face_count: int) -> tuple[int, int]:
    """Source-frame maximum and minimum that keep the per-face total within the frame budget."""
    n = max(1, face_count)
    return max(1, max_frames // n), max(2, min_frames // n)


# ---- user image functions --------------------------------------------------

def apply_image_model(frames: DataFrame, load, data: str = "pixels", order: str = "raw_index", chunk: int = 0, keys=("scene_id",)) -> DataFrame:
    """Run a user's image function over a frame table; a failing row falls back to its input.

    `load()` runs once per task and returns a callable: image to image, or with
    `chunk` > 0 a list of consecutive images to a list (short chunks are padded by
    repeating the last one). Adds `status`.
    """
    from ..functions.order_stats import ranked
    schema = T.StructType([*[f for f in frames.schema.fields if f.name not in (data, "width", "height")],
                           T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
                           T.StructField(data, T.BinaryType()), T.StructField("status", T.StringType())])
    fixed = [f.name for f in schema.fields if f.name not in (data, "width", "height", "status")]

    def image(row):
        return _array(row[data], row["width"], row["height"], int(row.get("channels") or 1)).astype(np.uint8)

    def emit(row, result, status):
        return [row[n] for n in fixed] + [result.shape[1], result.shape[0], np.ascontiguousarray(result).astype(np.uint8).tobytes(), status]

    if chunk <= 0:
        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = load()
            for pdf in batches:
                out = []
                for row in pdf.to_dict("records"):
                    source = image(row)
                    try:
                        out.append(emit(row, np.asarray(model(source)), "processed"))
                    except Exception as error:  # any user failure keeps the original frame
                        out.append(emit(row, source, f"failed_copied_original: {error}"))
                yield pd.DataFrame(out, columns=schema.names)
        return frames.mapInPandas(each, schema)

    numbered = ranked(frames, keys, [order], "_at").withColumn("_chunk", F.floor((F.col("_at") - 1) / chunk)).drop("_at")

    loaded = []  # filled once per task: the function is unpickled once per task

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(order).to_dict("records")
        sources = [image(r) for r in rows]
        if not loaded:
            loaded.append(load())
        try:
            results = list(loaded[0](sources + [sources[-1]] * (chunk - len(sources))))
            done = [emit(r, np.asarray(x), "processed") for r, x in zip(rows, results)]
        except Exception as error:
            done = [emit(r, s, f"failed_copied_original: {error}") for r, s in zip(rows, sources)]
        return pd.DataFrame(done, columns=schema.names)

    return numbered.groupBy(*keys, "_chunk").applyInPandas(together, schema)
