"""Files in the capture formats, written by hand and read back."""

import json
import os
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splatlake.sources import colmap, images, records, reports


def ply(path, rows, names=("x", "y", "opacity"), kinds=("float", "double", "uchar"), tail="", body=None):
    lines = ["ply", "format binary_little_endian 1.0", "comment made by a test", f"element vertex {len(rows)}"]
    lines += [f"property {k} {n}" for k, n in zip(kinds, names)] + ([tail] if tail else []) + ["end_header"]
    data = b"".join(struct.pack("<fdB", *r) for r in rows) if body is None else body
    with open(path, "wb") as f:
        f.write(("\n".join(lines) + "\n").encode() + data)


def test_ply_splits_and_types(spark, folder):
    rows = [(float(i), i * 0.5, i % 256) for i in range(1000)]
    ply(f"{folder}/one.ply", rows, tail="element face 2", body=b"".join(struct.pack("<fdB", *r) for r in rows) + b"\x01\x02\x03")
    ply(f"{folder}/two.ply", [(float("nan"), 1.0, 200)])
    ply(f"{folder}/zero.ply", [])
    records.register(spark)
    df = spark.read.format("ply").option("splitBytes", 777).load(folder)
    assert dict(df.dtypes) == {"scene_id": "string", "part": "string", "ordinal": "bigint", "x": "float", "y": "double", "opacity": "smallint"}
    got = df.filter("scene_id = 'one'").orderBy("ordinal").collect()
    assert [(r["x"], r["y"], r["opacity"]) for r in got] == rows and [r["ordinal"] for r in got] == list(range(1000))
    assert df.filter("isnan(x)").count() == 1 and df.count() == 1001


@pytest.mark.parametrize("text,message", [("ply\nelement vertex 1\n", "no end_header"), ("ply\nend_header\n", "no element vertex"),
                                          ("ply\nelement vertex 1\nproperty list uchar int f\nend_header\n", "cannot have the property")])
def test_bad_headers(spark, folder, text, message):
    with open(f"{folder}/bad.ply", "wb") as f:
        f.write(text.encode())
    with pytest.raises(Exception, match=message):
        records.read_ply(spark, folder).collect()


def test_ply_round_trip_and_types(spark, folder):
    df = spark.createDataFrame(pd.DataFrame({"scene_id": ["a", "a", "b"], "x": [1.5, -2.5, np.inf], "n": [1, 2, 3]}))
    df = df.select("scene_id", F.col("x").cast("float").alias("x"), F.col("n").cast("int").alias("n"))
    records.write_ply(df, f"{folder}/out")
    back = records.read_ply(spark, f"{folder}/out").select("scene_id", "x", "n")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert not [f for _, _, files in os.walk(f"{folder}/out") for f in files if f.startswith("_") and f != "_parts.json"]
    with pytest.raises(Exception, match="PLY has no type"):
        records.write_ply(df.withColumn("s", F.lit("text")), f"{folder}/no")


def test_splat_file_ignores_stray_bytes(spark, folder):
    raw = b"".join(struct.pack("<6f8B", i, 0, 0, 1, 1, 1, i % 256, 2, 3, 255, 0, 128, 128, 128) for i in range(100))
    with open(f"{folder}/cloud.splat", "wb") as f:
        f.write(raw + b"extra")
    rows = records.read_splat(spark, folder).orderBy("ordinal").collect()
    assert len(rows) == 100 and rows[7]["x"] == 7.0 and rows[99]["red"] == 99 and rows[0]["alpha"] == 255


def test_colmap_tables(spark, folder):
    sparse = f"{folder}/toy/sparse/0"
    os.makedirs(sparse)
    with open(f"{sparse}/cameras.bin", "wb") as f:
        f.write(struct.pack("<Q", 7))
        for model, n in {0: 3, 1: 4, 2: 4, 3: 5, 4: 8, 5: 8, 6: 12}.items():
            f.write(struct.pack("<Iiqq", model + 1, model, 640, 480) + struct.pack(f"<{n}d", *range(n)))
    with open(f"{sparse}/images.bin", "wb") as f:
        f.write(struct.pack("<Q", 2))
        for i in (1, 2):
            f.write(struct.pack("<I7dI", i, 1, 0, 0, 0, 5, 6, 7, 3) + f"im{i}.png".encode() + b"\0" + struct.pack("<Q", i) + struct.pack("<ddq", 1.5, 2.5, -1) * i)
    with open(f"{sparse}/points3D.bin", "wb") as f:
        f.write(struct.pack("<Q", 10))
        for i in range(10):
            f.write(struct.pack("<QdddBBBd", i, i, 0, 0, 255, 1, 2, 0.5) + struct.pack("<Q", i % 3) + struct.pack("<ii", 4, 9) * (i % 3))
    cameras = {r["model_id"]: r for r in colmap.read_cameras(spark, folder).collect()}
    assert [len(cameras[m]["params"]) for m in range(7)] == [3, 4, 4, 5, 8, 8, 12] and cameras[0]["scene_id"] == "toy"
    shots = {r["image_id"]: r for r in colmap.read_images(spark, folder).collect()}
    assert shots[2]["name"] == "im2.png" and shots[2]["tz"] == 7.0 and shots[2]["camera_id"] == 3 and len(shots[2]["points2d"]) == 2
    points = colmap.read_points(spark, folder)
    assert points.count() == 10 and points.agg(F.sum(F.size("track"))).first()[0] == sum(i % 3 for i in range(10))


def png(path, image):
    h, w, _ = image.shape
    raw = b"".join(b"\0" + image[y].tobytes() for y in range(h))
    chunk = lambda tag, data: struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_image_folder(spark, folder):
    os.makedirs(f"{folder}/shoot/images")
    rng = np.random.default_rng(0)
    pictures = rng.integers(0, 256, (3, 6, 8, 3), dtype=np.uint8)
    for i, p in enumerate(pictures):
        png(f"{folder}/shoot/images/f{i}.png", p)
    with open(f"{folder}/shoot/images/broken.png", "wb") as f:
        f.write(b"no picture")
    with open(f"{folder}/shoot/images/notes.txt", "wb") as f:
        f.write(b"text")
    rows = images.read_frames(spark, folder).orderBy("raw_index").collect()
    assert [(r["scene_id"], r["name"], r["width"], r["height"], r["channels"]) for r in rows] == [("shoot", f"f{i}.png", 8, 6, 3) for i in range(3)]
    assert np.array_equal(np.frombuffer(rows[1]["pixels"], np.uint8).reshape(6, 8, 3)[..., ::-1], pictures[1])
    listed = images.list_images(spark, folder).select(F.lit("shoot").alias("scene_id"), F.col("name").alias("path"))
    seen = images.read_frames(spark, folder).select("scene_id", F.col("name").alias("path"))
    count = images.unreadable_count(listed, seen).first()
    assert (count["listed"], count["unreadable"]) == (4, 1)


def test_reports_and_listing(spark, folder):
    for name, text in (("r1", json.dumps({"best_psnr": 31.5, "elapsed_sec": 9.0})), ("r2", "{ broken")):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/training_summary.json", "w") as f:
            f.write(text)
    rows = {r["run_id"]: r for r in reports.read_reports(spark, folder, "training_summary.json", reports.TRAINING).collect()}
    assert rows["r1"]["best_psnr"] == 31.5 and rows["r1"]["last_loss"] is None and rows["r2"]["best_psnr"] is None
    listing = {(r["delivery"], r["path"]): r["bytes"] for r in reports.list_files(spark, folder).collect()}
    assert listing[("r2", "training_summary.json")] == 8
    with open(f"{folder}/list.json", "w") as f:
        json.dump({"scenes": [{"output": "out/toy"}, {"name": "n", "output": "o", "notes": "x"}], "gates": {"min_score": 70}}, f)
    gates = {r["name"]: r for r in reports.read_scene_list(spark, f"{folder}/list.json").collect()}
    assert gates["toy"]["mobile_sog_mb"] == 12.0 and gates["toy"]["min_score"] == 70 and gates["n"]["min_points"] == 120_000


def ply_bytes(fields, rows, count=None, form="binary_little_endian 1.0"):
    types = {"f4": "float", "f8": "double", "u1": "uchar"}
    head = ["ply", f"format {form}", f"element vertex {len(rows) if count is None else count}", *[f"property {types[t]} {n}" for n, t in fields], "end_header"]
    return ("\n".join(head) + "\n").encode() + np.array([tuple(r) for r in rows], [(n, "<" + t) for n, t in fields]).tobytes()


def test_folder_of_different_headers_loses_nothing(spark, tmp_path):
    (tmp_path / "a.ply").write_bytes(ply_bytes([("x", "f4"), ("y", "u1")], [(1.5, 2)]))
    (tmp_path / "b.ply").write_bytes(ply_bytes([("x", "f8"), ("opacity", "f4")], [(0.1, 0.25)]))
    got = {r.scene_id: (r.x, r.y, r.opacity) for r in records.read_ply(spark, str(tmp_path)).collect()}
    assert got == {"a": (1.5, 2, None), "b": (0.1, None, 0.25)}


def test_cut_and_foreign_files_are_errors(spark, tmp_path):
    (tmp_path / "cut.ply").write_bytes(ply_bytes([("x", "f4")], [(1,), (2,)], count=5))
    with pytest.raises(Exception, match="truncated=true"):
        records.read_ply(spark, str(tmp_path / "cut.ply")).collect()
    assert spark.read.format("ply").option("truncated", "true").load(str(tmp_path / "cut.ply")).count() == 2
    (tmp_path / "big.ply").write_bytes(ply_bytes([("x", "f4")], [(1,)], form="binary_big_endian 1.0"))
    with pytest.raises(Exception, match="little-endian"):
        records.read_ply(spark, str(tmp_path / "big.ply")).collect()


def test_frames_are_numbered_before_they_are_opened(spark, tmp_path):
    pixel = bytes.fromhex("89504e470d0a1a0a0000000d4948445200000001000000010802000000907753de0000000c49444154789c63f8cfc000000301010018dd8db00000000049454e44ae426082")
    for scene in ("p/a", "q/a"):
        for kind in ("images", "masks"):
            (tmp_path / scene / kind).mkdir(parents=True)
            for n in range(3):
                (tmp_path / scene / kind / f"f{n}.png").write_bytes(b"broken" if kind == "images" and n == 1 else pixel)
    got = sorted((r.scene_id, r.raw_index, r.name) for r in images.read_frames(spark, str(tmp_path)).collect())
    assert got == [(s, n, f"f{n}.png") for s in ("p/a", "q/a") for n in (0, 2)]


def test_elements_before_the_vertices(spark, tmp_path):
    """Elements of fixed width are stepped over; lists before the vertices are refused, after them ignored."""
    head = "ply\nformat binary_little_endian 1.0\nelement camera 3\nproperty float fx\nproperty uchar kind\nelement vertex 2\nproperty float x\nelement face 1\nproperty list uchar int v\nend_header\n"
    body = struct.pack("<fB", 9.0, 7) * 3 + struct.pack("<ff", 1.5, 2.5) + b"\x01\x00\x00\x00\x00"
    (tmp_path / "a.ply").write_bytes(head.encode() + body)
    assert [r.x for r in records.read_ply(spark, str(tmp_path)).orderBy("ordinal").collect()] == [1.5, 2.5]
    (tmp_path / "a.ply").write_bytes(head.replace("property uchar kind", "property list uchar int kind").encode() + body)
    with pytest.raises(Exception, match="lists of element camera"):
        records.read_ply(spark, str(tmp_path)).collect()


def test_counts_columns_and_scenes(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"s{i}.ply").write_bytes(ply_bytes([("x", "f4"), ("y", "f4"), ("z", "f8")], [(i, j, 2 * j) for j in range(i)]))
    counts = {r.scene_id: r.point_count for r in records.ply_counts(spark, str(tmp_path)).collect()}
    assert counts == {f"s{i}": i for i in range(40)}
    some = records.read_ply(spark, str(tmp_path), columns=["z"])
    assert some.columns == ["scene_id", "part", "ordinal", "z"] and sorted(r.z for r in some.filter("scene_id = 's3'").collect()) == [0, 2, 4]
    with pytest.raises(ValueError, match="nope"):
        records.read_ply(spark, str(tmp_path), columns=["nope"])


def test_scenes_leave_other_files_unopened(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"s{i}.ply").write_bytes(ply_bytes([("x", "f4")], [(i,)] * 3))
    frame, some = records.read_ply(spark, str(tmp_path)), records.read_ply(spark, str(tmp_path), scenes=["s0", "s2"])
    (tmp_path / "s4.ply").write_bytes(b"broken")  # after the survey: only a task that opens it can notice
    assert some.count() == 6 and some.filter("x > 1").count() == 3
    with pytest.raises(Exception):
        frame.count()


def test_a_big_partition_becomes_bounded_parts(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 1).select((F.col("id") % 3).cast("string").alias("scene_id"), F.col("id").cast("int").alias("n"), F.col("id").cast("double").alias("x"))
    records.register(spark)
    with_conf = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        rows.write.format("ply").option("partBytes", 12_000).mode("append").save(str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_conf)
    files = list((tmp_path / "out").rglob("*.ply"))
    assert len(files) > 15 and max(f.stat().st_size for f in files) < 12_000 + 6_000 + 200
    back = records.read_ply(spark, str(tmp_path / "out"))
    order = back.orderBy("scene_id", "part", "ordinal").select("scene_id", "n").collect()
    assert [(r.scene_id, r.n) for r in order] == [(str(s), n) for s in range(3) for n in range(s, 20_000, 3)]
    listing = json.loads((tmp_path / "out" / "_parts.json").read_text())
    assert sum(p["count"] for p in listing) == 20_000 and len(listing) == len(files)


@pytest.mark.parametrize("limit", [1, 200, 5000, None])
def test_sparse_models_are_read_in_ranges(spark, tmp_path, limit, monkeypatch):
    monkeypatch.setattr(colmap, "BLOCK_BYTES", 64)
    folder = tmp_path / "toy" / "sparse" / "0"
    folder.mkdir(parents=True)
    points = [(i, [(i, j) for j in range(i * 37 % 23)]) for i in range(120)]
    (folder / "points3D.bin").write_bytes(struct.pack("<Q", 120) + b"".join(struct.pack("<QdddBBBdQ", i, i, -i, 0.5, i % 256, 2, 3, i / 7, len(t)) + b"".join(struct.pack("<ii", *p) for p in t) for i, t in points))
    shots = [(i, "n" * (i * 53 % 90) + f"é{i}.png", [(i + 0.5, j, -1 if j % 2 else j) for j in range(i * 7 % 11)]) for i in range(60)]
    (folder / "images.bin").write_bytes(struct.pack("<Q", 60) + b"".join(
        struct.pack("<I7dI", i, 1, 0, 0, 0, 5, 6, i, 3) + n.encode() + b"\0" + struct.pack("<Q", len(p)) + b"".join(struct.pack("<ddq", *x) for x in p) for i, n, p in shots))
    found = colmap.read_points(spark, str(tmp_path), limit)
    assert [(r.point_id, r.x, r.y, r.red, r.error, [(t.image_id, t.point2d_idx) for t in r.track]) for r in found.orderBy("point_id").collect()] == [(i, i, -i, i % 256, i / 7, t) for i, t in points]
    seen = colmap.read_images(spark, str(tmp_path), limit).orderBy("image_id").collect()
    assert [(r.image_id, r.tz, r.camera_id, r.name, [tuple(x) for x in r.points2d]) for r in seen] == [(i, float(i), 3, n, [tuple(x) for x in p]) for i, n, p in shots]
    if limit == 200:
        assert found.select(F.spark_partition_id()).distinct().count() > 3


def test_a_cut_sparse_model_is_an_error(spark, tmp_path):
    folder = tmp_path / "toy" / "sparse"
    folder.mkdir(parents=True)
    whole = struct.pack("<Q", 2) + (struct.pack("<QdddBBBdQ", 1, 0, 0, 0, 1, 2, 3, 0.5, 1) + struct.pack("<ii", 1, 2)) * 2
    (folder / "points3D.bin").write_bytes(whole[:-3])
    for limit in (1, None):
        with pytest.raises(Exception, match="inside a record"):
            colmap.read_points(spark, str(tmp_path), limit).collect()


def test_sampled_frames_are_the_only_ones_opened(spark, tmp_path):
    """One of a hundred files is sampled; the others are no pictures, which only opening them would tell."""
    for scene in ("a b", "c%d"):
        (tmp_path / scene / "images").mkdir(parents=True)
        for n in range(100):
            png(tmp_path / scene / "images" / f"f {n:03d}.png", np.full((2, 3, 3), n, np.uint8))
    listed = images.list_frames(spark, str(tmp_path))
    assert listed.count() == 200 and "pixels" not in listed.columns
    for at_once in (1, 50_000):
        few = images.decode_frames(listed.filter("raw_index = 40"), str(tmp_path), at_once)
        assert sorted((r.scene_id, r["name"], r.raw_index, r.width, bytes(r.pixels)[0]) for r in few.collect()) == [("a b", "f 040.png", 40, 3, 40), ("c%d", "f 040.png", 40, 3, 40)]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert opened_files(few) == 2
    sample = images.read_frames(spark, str(tmp_path), max_frames=3)
    assert sorted((r.raw_index, r.frame_count) for r in sample.filter("scene_id = 'a b'").collect()) == [(n, 100) for n in (0, 34, 68)]


def test_files_next_to_each_other_are_picked_by_two_paths(spark, tmp_path):
    """The plan, which every task carries, names no file inside a run; other files between the runs stay closed."""
    for kind in ("images", "masks"):
        for scene in ("a", "it's"):
            (tmp_path / scene / kind).mkdir(parents=True)
            for n in range(60):
                png(tmp_path / scene / kind / f"f {n:03d}.png", np.full((2, 3, 3), n, np.uint8))
    (tmp_path / "a" / "images" / "f 030.txt").write_text("no picture")
    listed = images.list_frames(spark, str(tmp_path)).drop("bytes")
    want = [(s, n) for s in ("a", "it's") for n in range(60)]
    for at_once, branches in ((50_000, 1), (25, 5)):
        frames = images.decode_frames(listed, str(tmp_path), at_once)
        plan = frames._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("f%20") < 60 and "f%20010.png" not in plan
        assert plan.count("Join Inner") == branches
        assert sorted((r.scene_id, r.raw_index) for r in frames.collect()) == want
        assert all(bytes(r.pixels) == bytes([r.raw_index]) * 18 for r in frames.collect())
        frames = images.decode_frames(listed, str(tmp_path), at_once)
        frames.collect()
        assert opened_files(frames) == 120
    odd = images.decode_frames(listed.filter("raw_index % 2 = 1 OR raw_index > 40"), str(tmp_path))
    assert odd.count() == 2 * (20 + 19) and images.decode_frames(listed.filter("false"), str(tmp_path)).count() == 0


def opened_files(frame) -> int:
    """Files that the image scan of a frame, collected once, selected."""
    found, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind, children = node.getClass().getSimpleName(), node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan image"):
            found += node.metrics().apply("numFiles").value()
    return found


def test_assessing_a_folder(spark, tmp_path):
    from splatlake.operators import frames

    rng = np.random.default_rng(2)
    for kind in ("images", "masks"):
        (tmp_path / "s" / kind).mkdir(parents=True)
        for n in range(12):
            png(tmp_path / "s" / kind / f"f{n:02d}.png", rng.integers(0, 256, (16, 16, 3), dtype=np.uint8))
    png(tmp_path / "s" / "masks" / "lonely.png", np.zeros((4, 4, 3), np.uint8))
    got = frames.assess_folder(spark, str(tmp_path), max_frames=5).first()
    listed = images.read_frames(spark, str(tmp_path))
    masks = images.read_frames(spark, str(tmp_path), child="masks").filter("scene_id = 's'")
    want = frames.assess_scene(listed, masks, max_frames=5).first()
    assert (got.frame_count, got.sampled_count, got.mask_count) == (12, 4, 12)
    assert {c: got[c] for c in want.__fields__} == {c: want[c] for c in want.__fields__}
    dims = frames.frame_dims(images.read_frames(spark, str(tmp_path), max_frames=4)).first()
    assert (dims.width, dims.height, dims.frames) == (16, 16, 12)


def test_text_per_row_needs_no_move_by_the_driver(spark, folder):
    from splatlake.plans import source_queries

    rows = spark.range(20).select(F.col("id").alias("run"), F.concat(F.lit('{"best_psnr": '), "id", F.lit("}")).alias("value"))
    source_queries.text_per_row(rows, f"{folder}/lists", "run")
    files = sorted(f"{os.path.basename(d)}/{n}" for d, _, names in os.walk(f"{folder}/lists") for n in names)
    assert files == sorted(f"run={i}/part.txt" for i in range(20))
    back = reports.read_reports(spark, f"{folder}/lists", "*.txt", "best_psnr double")
    assert {(r.run_id, r.best_psnr) for r in back.collect()} == {(f"run={i}", float(i)) for i in range(20)}
