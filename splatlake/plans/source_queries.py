"""File round trips: a fixture cloud is written in a capture format and read back."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import functions as F

from ..functions.order_stats import ranked
from ..functions.scalars import r6
from ..functions.scaling import shared_path
from ..operators import encodings as E, frames as G
from ..operators.sfm import PARAM_COUNTS
from ..sources import colmap, images, records as R, reports
from . import fixtures as X
from .fixtures import oracle
from .registry import query
from .splat_queries import steps

F32 = lambda c: f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) + 0.0"


@query("read_ply", oracle("SELECT CAST(scene_id AS VARCHAR) AS scene_id, point_id, " + ", ".join(f"{F32(c)} AS {c}" for c in ("x", "y", "z", "opacity_raw", "scale_raw_0")) + " FROM splats_emb", views="splats_emb"))
def _(spark, d):
    rows = X.splats_emb(spark, d)
    path = shared_path(spark)
    flat = rows.select("scene_id", F.col("point_id").cast("double").alias("id"), *[F.col(c).cast("float").alias(c) for c in "xyz"], F.col("opacity_raw").cast("float").alias("opacity"),
                       *[F.col(f"scale_raw_{i}").cast("float").alias(f"scale_{i}") for i in range(3)])
    R.write_ply(flat, path)
    back = R.as_splats(R.read_ply(spark, path))
    return back.select("scene_id", F.col("id").cast("bigint").alias("point_id"), *[r6(c).alias(c) for c in ("x", "y", "z", "opacity_raw", "scale_raw_0")])


@query("write_ply_standard", oracle("SELECT CAST(scene_id AS VARCHAR) AS scene_id, 62 AS columns, " + ", ".join(f"{F32(c)} AS {n}" for n, c in
    (("x", "x"), ("opacity", "opacity_raw"), ("scale_2", "scale_raw_2"), ("rot_3", "rot_3"), ("f_dc_1", "f_dc_1"))) + ", 0e0 AS nx, 0e0 AS f_rest_44 FROM splats_emb", views="splats_emb"))
def _(spark, d):
    path = shared_path(spark)
    R.write_ply(R.standard_columns(X.splats_emb(spark, d)), path)
    back = R.read_ply(spark, path)
    return back.select("scene_id", F.lit(len(back.columns) - 3).alias("columns"), *[r6(F.col(c).cast("double")).alias(c) for c in ("x", "opacity", "scale_2", "rot_3", "f_dc_1", "nx", "f_rest_44")])


@query("write_ply_web", oracle("SELECT CAST(scene_id AS VARCHAR) AS scene_id, " + ", ".join(f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 4) + 0.0 AS {n}" for n, c in (("x", "x"), ("opacity", "opacity"), ("scale_2", "sz"))) + ", 1e0 AS nx FROM dec", *steps("splats_emb", "enc", "dec"), views="splats_emb"))
def _(spark, d):
    path = shared_path(spark)
    R.write_ply(R.web_columns(E.decode(X.splats_emb(spark, d))), path)
    back = R.read_ply(spark, path)
    return back.select("scene_id", *[(F.round(F.col(c).cast("double"), 4) + 0.0).alias(c) for c in ("x", "opacity", "scale_2", "nx")])


@query("ply_counts", oracle("SELECT CAST(scene_id AS VARCHAR) AS scene_id, count(*) AS point_count FROM splats_emb GROUP BY scene_id", views="splats_emb"))
def _(spark, d):
    """Vertices per scene from the headers of its part files alone."""
    path = shared_path(spark)
    R.write_ply(X.splats_emb(spark, d).select("scene_id", *[F.col(c).cast("float").alias(c) for c in "xyz"]), path)
    return R.ply_counts(spark, path).select("scene_id", "point_count")


@query("read_ply_columns", oracle(f"SELECT CAST(scene_id AS VARCHAR) AS scene_id, {F32('y')} AS y FROM splats_emb WHERE scene_id IN (1, 4)", views="splats_emb"))
def _(spark, d):
    """One column of two scenes."""
    path = shared_path(spark)
    R.write_ply(X.splats_emb(spark, d).select("scene_id", *[F.col(c).cast("float").alias(c) for c in "xyz"]), path)
    return R.read_ply(spark, path, columns=["y"], scenes=["1", "4"]).select("scene_id", r6(F.col("y").cast("double")).alias("y"))


SPLAT = """nrm AS (SELECT dec.*, sqrt(rot_0*rot_0+rot_1*rot_1+rot_2*rot_2+rot_3*rot_3) AS n FROM dec),
mea AS (SELECT scene_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM dec GROUP BY scene_id)"""


@query("write_splat", oracle("""SELECT CAST(scene_id AS VARCHAR) AS scene_id, row_number() OVER (PARTITION BY scene_id ORDER BY (x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz-3)*(z-mz-3) DESC, point_id) - 1 AS position, """
    + f"{F32('x')} AS x, " + ", ".join(f"CAST(floor(greatest(0e0, least(1e0, 0.5e0+0.28209479177387814e0*f_dc_{i})) * 255) AS SMALLINT) AS {n}" for i, n in enumerate(("red", "green", "blue")))
    + ", CAST(floor(greatest(0e0, least(1e0, opacity)) * 255) AS SMALLINT) AS alpha, CAST(floor((greatest(-1e0, least(1e0, rot_0/n)) + 1) / 2 * 255) AS SMALLINT) AS rot_u8_0 FROM nrm JOIN mea USING (scene_id)",
    *steps("splats_emb", "enc", "dec"), SPLAT, views="splats_emb"))
def _(spark, d):
    path = shared_path(spark)
    R.write_splat(X.splats_emb(spark, d), path)
    rows = R.read_splat(spark, path)
    return ranked(rows, ["scene_id"], ["part", "ordinal"], "p").select(
        "scene_id", (F.col("p") - 1).alias("position"), r6(F.col("x").cast("double")).alias("x"), "red", "green", "blue", "alpha", "rot_u8_0")


@query("write_reports", oracle("SELECT CAST(scene_id AS VARCHAR) AS scene_id, count(*) AS n, CASE WHEN scene_id % 3 = 0 THEN NULL ELSE min(point_id) END AS first FROM splats_emb GROUP BY scene_id", views="splats_emb"))
def _(spark, d):
    path = shared_path(spark)
    rows = X.splats_emb(spark, d).groupBy("scene_id").agg(F.count("*").alias("n"), F.min("point_id").alias("first"))
    reports.write_reports(rows.withColumn("first", F.when(F.col("scene_id") % 3 != 0, F.col("first"))), path)
    back = reports.read_reports(spark, path, "*.txt", "n bigint, first bigint")
    return back.select(F.regexp_replace("run_id", "^scene_id=", "").alias("scene_id"), "n", "first")


@query("write_scene_data", oracle("SELECT scene_id, count(*) AS points, round(sum(x), 5) + 0.0 AS x, 2e0 AS scale_w FROM splats_emb GROUP BY scene_id", views="splats_emb"))
def _(spark, d):
    path = shared_path(spark)
    rows = X.splats_emb(spark, d)
    scales = rows.select("scene_id").distinct().withColumn("scale_w", F.lit(2.0))
    reports.write_scene_data(rows.select("scene_id", F.col("point_id").alias("image_id"), F.array("rot_0", "rot_1").alias("camtoworld")), rows.select("scene_id", "x", "y", "z"), scales, path)
    views, points, factor = reports.read_scene_data(spark, path)
    return (points.groupBy("scene_id").agg(F.count("*").alias("points"), (F.round(F.sum("x"), 5) + 0.0).alias("x"))
            .join(views.select("scene_id").distinct(), "scene_id", "left_semi").join(factor, "scene_id"))


def model_files(rows, path: str, file_name: str, record) -> None:
    """One sparse-model file per scene of at most 1000 records, written by the task that holds them."""
    def write(key, pdf):
        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(f"{inner}/{key[0]}/sparse/0", recursive=True)
        with system.open_output_stream(f"{inner}/{key[0]}/sparse/0/{file_name}") as out:
            out.write(struct.pack("<Q", len(pdf)) + b"".join(map(record, pdf.itertuples())))
        return pd.DataFrame({"n": [len(pdf)]})

    rows.groupBy("scene_id").applyInPandas(write, "n long").agg(F.sum("n")).collect()


def thousands(prefix, key: str):
    return F.concat(prefix.cast("string"), F.lit("_"), F.floor(F.col(key) / 1000).cast("string")).alias("scene_id")


SCENE = "concat(scene_id, '_', point_id // 1000) AS scene_id"
COUNTS = "CASE model_id " + " ".join(f"WHEN {m} THEN {n}" for m, n in PARAM_COUNTS.items() if m < 7) + " END"


@query("read_colmap_cameras", oracle(f"SELECT concat('c_', camera_id // 1000) AS scene_id, camera_id, model_id, CAST(width AS BIGINT) AS width, CAST(height AS BIGINT) AS height, n AS params, round(n * f0 + n * (n - 1) / 2.0e0, 4) AS total FROM (SELECT *, {COUNTS} AS n FROM cameras_fx) t", views="cameras_fx"))
def _(spark, d):
    path = shared_path(spark)

    def record(r):
        n = PARAM_COUNTS[r.model_id]
        return struct.pack(f"<Iiqq{n}d", r.camera_id, r.model_id, r.width, r.height, *(r.f0 + i for i in range(n)))

    model_files(X.cameras_fx(spark, d).select(thousands(F.lit("c"), "camera_id"), "camera_id", "model_id", "width", "height", F.col("f0").cast("double").alias("f0")), path, "cameras.bin", record)
    back = colmap.read_cameras(spark, path)
    total = F.aggregate("params", F.lit(0.0), lambda a, v: a + v)
    return back.select("scene_id", "camera_id", "model_id", "width", "height", F.size("params").alias("params"), F.round(total, 4).alias("total"))


@query("read_colmap_images", oracle(f"SELECT {SCENE}, point_id AS image_id, round(rot_0, 6) + 0.0 AS qw, round(z, 6) + 0.0 AS tz, point_id % 7 AS camera_id, concat('shot ', point_id, '.png') AS name, point_id % 3 AS observed, (point_id % 3) * point_id AS seen FROM splats_emb", views="splats_emb"))
def _(spark, d):
    path = shared_path(spark)

    def record(r):
        head = struct.pack("<I7dI", r.point_id, r.rot_0, r.rot_1, r.rot_2, r.rot_3, r.x, r.y, r.z, r.point_id % 7) + f"shot {r.point_id}.png".encode() + b"\0"
        n = r.point_id % 3
        return head + struct.pack("<Q", n) + b"".join(struct.pack("<ddq", i, 0.5, r.point_id) for i in range(n))

    rows = X.splats_emb(spark, d).withColumn("scene_id", thousands(F.col("scene_id"), "point_id"))
    model_files(rows.select("scene_id", "point_id", *[f"rot_{i}" for i in range(4)], "x", "y", "z"), path, "images.bin", record)
    back = colmap.read_images(spark, path)
    seen = F.aggregate("points2d", F.lit(0).cast("bigint"), lambda a, v: a + v["point3d_id"])
    return back.select("scene_id", "image_id", r6("qw").alias("qw"), r6("tz").alias("tz"), "camera_id", "name", F.size("points2d").alias("observed"), seen.alias("seen"))


@query("read_colmap_points", oracle(f"SELECT {SCENE}, point_id, round(x, 6) + 0.0 AS x, CAST(point_id % 256 AS SMALLINT) AS red, round(opacity_raw, 6) + 0.0 AS error, point_id % 4 AS track, (point_id % 4) * (point_id % 4 - 1) // 2 AS spots FROM splats_emb", views="splats_emb"))
def _(spark, d):
    path = shared_path(spark)

    def record(r):
        n = r.point_id % 4
        return struct.pack("<QdddBBBdQ", r.point_id, r.x, r.y, r.z, r.point_id % 256, 0, 255, r.opacity_raw, n) + b"".join(struct.pack("<ii", 7, i) for i in range(n))

    rows = X.splats_emb(spark, d).withColumn("scene_id", thousands(F.col("scene_id"), "point_id"))
    model_files(rows.select("scene_id", "point_id", "x", "y", "z", "opacity_raw"), path, "points3D.bin", record)
    back = colmap.read_points(spark, path)
    spots = F.aggregate("track", F.lit(0), lambda a, v: a + v["point2d_idx"])
    return back.select("scene_id", "point_id", r6("x").alias("x"), "red", r6("error").alias("error"), F.size("track").alias("track"), spots.alias("spots"))


def text_files(rows, path: str, *keys: str) -> None:
    """One text file per key, written by Spark: column `value` is its text, the keys name its folder."""
    rows.repartition(*keys).write.partitionBy(*keys).text(path)


def text_per_row(rows, path: str, key: str) -> None:
    """A text file per row, in the folder that its key names; tasks write the files straight into place, with no move by the driver."""
    def write(batches):
        system, inner = fs.FileSystem.from_uri(path)
        for pdf in batches:
            for name, value in zip(pdf[key], pdf["value"]):
                system.create_dir(f"{inner}/{key}={name}", recursive=True)
                with system.open_output_stream(f"{inner}/{key}={name}/part.txt") as out:
                    out.write(value.encode() + b"\n")
            yield pd.DataFrame({"n": [len(pdf)]})

    rows.select(F.col(key).cast("string").alias(key), "value").mapInPandas(write, "n long").agg(F.sum("n")).collect()


@query("read_reports", oracle("""SELECT user_id AS run_id, CASE WHEN user_id % 5 <> 0 THEN count(*) END AS loss_count, CASE WHEN user_id % 5 <> 0 THEN max(value) END AS best_psnr
    FROM events GROUP BY user_id"""))
def _(spark, d):
    """A report file per user; every fifth is cut before its last brace and reads as an empty report."""
    path = shared_path(spark)
    rows = X.table(spark, d, "events").groupBy(F.col("user_id").alias("run")).agg(F.count("*").alias("loss_count"), F.max("value").alias("best_psnr"))
    text = F.to_json(F.struct("best_psnr", "loss_count"), {"pretty": "true"})
    cut = F.when(F.col("run") % 5 == 0, F.expr("substr(v, 1, length(v) - 1)")).otherwise(F.col("v"))
    text_per_row(rows.withColumn("v", text).select("run", cut.alias("value")), path, "run")
    back = reports.read_reports(spark, path, "*.txt", "best_psnr double, loss_count bigint")
    return back.select(F.regexp_replace("run_id", "^run=", "").cast("bigint").alias("run_id"), "loss_count", "best_psnr")


@query("list_files", oracle("""SELECT CAST(l_suppkey % 40 AS VARCHAR) AS delivery, 'flag=' || l_returnflag AS folder, 1 AS files, sum(length(l_linestatus) + 1)::BIGINT AS bytes
    FROM lineitem GROUP BY l_suppkey % 40, l_returnflag"""))
def _(spark, d):
    """Line items as one text file per supplier group and return flag, a line each."""
    path = shared_path(spark)
    rows = X.table(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("supplier"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("value"))
    text_files(rows, path, "supplier", "flag")
    files = reports.list_files(spark, path).filter(F.col("path").endswith(".txt"))
    return files.groupBy(F.regexp_replace("delivery", "^supplier=", "").alias("delivery"), F.substring_index("path", "/", 1).alias("folder")).agg(F.count("*").cast("int").alias("files"), F.sum("bytes").alias("bytes"))


@query("read_scene_list", oracle("""SELECT coalesce(CASE WHEN event_id % 3 <> 0 THEN 'event ' || event_id END, 'e' || event_id) AS name, 'out/u' || user_id || '/e' || event_id || '/' AS output,
    CASE WHEN event_id % 2 = 0 THEN event_type ELSE '' END AS notes, CASE WHEN user_id % 4 = 0 THEN 12 ELSE user_id / 2.0e0 END AS mobile_sog_mb, CASE WHEN user_id % 4 = 0 OR user_id % 7 = 0 THEN 120000 ELSE user_id END AS min_points,
    CASE WHEN user_id % 4 = 0 THEN 85 ELSE user_id % 100 END AS min_score FROM events"""))
def _(spark, d):
    """A benchmark list per user; names, notes and gates are missing here and there."""
    path, k, u = shared_path(spark), F.col("event_id"), F.col("user_id")
    scene = F.struct(F.when(k % 3 != 0, F.concat(F.lit("event "), k)).alias("name"), F.concat(F.lit("out/u"), u, F.lit("/e"), k, F.lit("/")).alias("output"), F.when(k % 2 == 0, F.col("event_type")).alias("notes"))
    lists = X.table(spark, d, "events").groupBy("user_id").agg(F.collect_list(scene).alias("scenes"))
    gates = F.when(u % 4 != 0, F.struct((u / 2.0).alias("mobile_sog_mb"), F.when(u % 7 != 0, u).alias("min_points"), (u % 100).alias("min_score")))
    text_per_row(lists.select("user_id", F.to_json(F.struct("scenes", gates.alias("gates")), {"pretty": "true"}).alias("value")), path, "user_id")
    return reports.read_scene_list(spark, path).select("name", "output", "notes", "mobile_sog_mb", "min_points", "min_score")


def picture_files(rows, path: str) -> None:
    """Frames (scene_id, raw_index, width, height, channels, pixels as blue-green-red levels) as picture files, written by Spark tasks."""
    def block(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    def write(batches):
        system, inner = fs.FileSystem.from_uri(path)
        for pdf in batches:
            for r in pdf.itertuples():
                image = np.asarray(r.pixels, np.uint8).reshape(r.height, r.width, r.channels)[..., ::-1]
                lines = b"".join(b"\0" + line.tobytes() for line in image)
                system.create_dir(f"{inner}/{r.scene_id}/images", recursive=True)
                with system.open_output_stream(f"{inner}/{r.scene_id}/images/{r.raw_index:09d}.png") as out:
                    out.write(b"\x89PNG\r\n\x1a\n" + block(b"IHDR", struct.pack(">IIBBBBB", r.width, r.height, 8, 0 if r.channels == 1 else 2, 0, 0, 0)) + block(b"IDAT", zlib.compress(lines)) + block(b"IEND", b""))
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = rows.select("scene_id", "raw_index", "width", "height", "channels", "pixels")
    spread = rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, "scene_id", "raw_index")  # few bytes, but a file each: not few tasks
    spread.mapInPandas(write, "n long").agg(F.sum("n")).collect()


def mixed_frames(spark, d):
    """Even frames gray, odd ones in colour."""
    levels = F.flatten(F.transform("pixels", lambda v: F.array(255 - v, F.floor(v / 2).cast("int"), v)))
    rows, odd = X.frames8(spark, d), F.col("raw_index") % 2 == 1
    return rows.withColumns({"channels": F.when(odd, 3).otherwise(1), "pixels": F.when(odd, levels).otherwise(F.col("pixels"))})


MIXED = """mix AS (SELECT scene_id, raw_index, width, height, CASE WHEN raw_index % 2 = 1 THEN 3 ELSE 1 END AS channels,
  array_to_string(list_transform(pixels, lambda v: CASE WHEN raw_index % 2 = 1 THEN printf('%02x%02x%02x', 255 - v, v // 2, v) ELSE printf('%02x', v) END), '') AS pixels, count(*) OVER (PARTITION BY scene_id) AS n FROM frames8)"""


@query("read_frames", oracle("SELECT CAST(scene_id AS VARCHAR) AS scene_id, raw_index, width, height, channels, pixels FROM mix", MIXED, views="frames8"))
def _(spark, d):
    """Every frame becomes a picture file, gray or in colour, and is decoded again."""
    path = shared_path(spark)
    picture_files(mixed_frames(spark, d), path)
    return images.read_frames(spark, path).select("scene_id", "raw_index", "width", "height", "channels", F.lower(F.hex("pixels")).alias("pixels"))


@query("read_frames_sampled", oracle("SELECT CAST(scene_id AS VARCHAR) AS scene_id, raw_index, n AS frame_count, channels, pixels FROM mix WHERE raw_index % CAST(greatest(1, ceil(n / 7.0e0)) AS BIGINT) = 0", MIXED, views="frames8"))
def _(spark, d):
    """At most seven frames of a scene, picked before any picture is opened."""
    path = shared_path(spark)
    picture_files(mixed_frames(spark, d), path)
    return images.read_frames(spark, path, max_frames=7).select("scene_id", "raw_index", "frame_count", "channels", F.lower(F.hex("pixels")).alias("pixels"))


@query("assess_folder", oracle("""SELECT CAST(scene_id AS VARCHAR) AS scene_id, max(n) AS frame_count, count(*) AS sampled_count, 8 AS width, 8 AS height, 0 AS mask_count
    FROM mix WHERE raw_index % CAST(greatest(1, ceil(n / 9.0e0)) AS BIGINT) = 0 GROUP BY scene_id""", MIXED, views="frames8"))
def _(spark, d):
    """The input report straight from folders of picture files; what it measures is compared in `assess_scene`."""
    path = shared_path(spark)
    picture_files(mixed_frames(spark, d), path)
    return G.assess_folder(spark, path, max_frames=9).select("scene_id", "frame_count", "sampled_count", "width", "height", F.col("mask_count").cast("int").alias("mask_count"))
