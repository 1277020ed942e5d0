"""Frame gates, adaptive selection, input scoring and image functions on generated frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splatlake.operators import frames as G, pixels as P


def frames(images, scene="s"):
    return pd.DataFrame({"scene_id": scene, "raw_index": range(len(images)), "width": [i.shape[1] for i in images], "height": [i.shape[0] for i in images],
                         "pixels": [i.ravel().astype(int).tolist() for i in images]})


def walk(images, sharp, min_sharp, min_diff):
    last, out = None, {}
    for i, (image, s) in enumerate(zip(images, sharp)):
        if s < min_sharp:
            continue
        diff = None if last is None else P.mean_abs_diff(last, image)
        out[i] = diff is None or diff >= min_diff
        if out[i]:
            last = image
    return out


@pytest.mark.parametrize("chunk", [4, 7, 1000])
def test_near_dup_gate_equals_one_walk(spark, chunk):
    rng = np.random.default_rng(chunk)
    base = rng.integers(0, 256, (6, 8)).astype(float)
    images = []
    for _ in range(60):
        base = np.clip(base + rng.normal(0, 9, base.shape), 0, 255)
        images.append(base.astype(int))
    sharp = rng.uniform(0, 100, 60)
    pdf = frames(images).assign(sharpness=sharp)
    ladder = [(0, "strict", 40.0, 0.06), (1, "coverage_1", 20.0, 0.03)]
    rows = G.near_dup_gate(spark.createDataFrame(pdf), ladder, chunk=chunk).collect()
    for no, _, s, d in ladder:
        assert {r["raw_index"]: r["kept"] for r in rows if r["pass_no"] == no} == walk(images, sharp, s, d)


def test_near_dup_gate_settles_still_stretches_together(spark, monkeypatch):
    still = [np.full((2, 3), 40)] * 64 + [np.full((2, 3), 200)] * 64
    rounds, plain = [], G.durable
    monkeypatch.setattr(G, "durable", lambda df: rounds.append(1) or plain(df))
    rows = G.near_dup_gate(spark.createDataFrame(frames(still).assign(sharpness=9.0)), [(0, "strict", 1.0, 0.1)], chunk=2).collect()
    assert sorted(r["raw_index"] for r in rows if r["kept"]) == [0, 64] and len(rows) == 128
    assert len(rounds) <= 2 + 2 * 3  # frames, guesses, and two tables a round


def color(images):
    return frames([i[..., 0] for i in images]).assign(channels=[i.shape[2] for i in images], pixels=[i.astype(np.uint8).tobytes() for i in images])


def test_near_dup_gate_compares_all_channels_and_mixed_sizes(spark):
    red, blue = np.zeros((4, 6, 3)), np.zeros((4, 6, 3))
    red[..., 2], blue[..., 0] = 100, 100 * 0.299 / 0.114
    large = np.repeat(np.repeat(blue, 2, 0), 2, 1)
    df = spark.createDataFrame(color([red, red, blue, large, large + 90]).assign(sharpness=9.0))
    kept = sorted(r["raw_index"] for r in G.near_dup_gate(df, [(0, "strict", 1.0, 0.05)]).collect() if r["kept"])
    assert kept == [0, 2, 4]  # equal in gray, far apart in colour; a larger copy is none


def test_color_folder_to_report(spark):
    rng = np.random.default_rng(3)
    shots = [rng.integers(0, 256, (8, 10, 3)) for _ in range(7)]
    df = spark.createDataFrame(color(shots))
    picked, manifest = G.select_frames_adaptive(P.frame_health(df), 1.0, 0.0, 50, 2)
    assert picked.count() == 7 and manifest.first()["kept_count"] == 7
    row = G.assess_scene(df).first()
    grays = [P._gray(s.astype(np.uint8)) for s in shots]
    assert (row["width"], row["height"], row["frame_count"]) == (10, 8, 7)
    assert row["diff_max"] == pytest.approx(max(P.mean_abs_diff(a, b) for a, b in zip(grays, grays[1:])))


def noise(n, rng, spread=90, shape=(24, 18)):
    return [np.clip(rng.normal(128, spread, shape), 0, 255).astype(int) for _ in range(n)]


def test_thinning_keeps_both_ends(spark):
    rng = np.random.default_rng(1)
    df = P.frame_health(spark.createDataFrame(frames(noise(30, rng))))
    picked, manifest = G.select_frames_adaptive(df, 10.0, 0.0, max_frames=6, min_frames=6)
    index = sorted(r["raw_index"] for r in picked.collect())
    assert len(index) == 6 and index[0] == 0 and index[-1] == 29
    row = manifest.first()
    assert row["pass"] == "strict" and row["temporal_thinned_count"] == 24 and row["meets_target"]


def test_exposure_drops_and_relaxing(spark):
    rng = np.random.default_rng(2)
    images = noise(9, rng) + [np.zeros((24, 18), int), np.full((24, 18), 255), np.full((24, 18), 128)]
    df = P.frame_health(spark.createDataFrame(frames(images)))
    fates = G.filter_frames(df, G.threshold_ladder(1.0, 0.0, False), 100)
    reasons = [r["reason"] for r in fates.collect()]
    assert reasons.count("bad_exposure") == 3 and reasons.count("kept") == 9
    strict = df.agg(F.percentile("sharpness", F.lit(0.5))).first()[0] * 2
    manifest = G.select_frames_adaptive(df, strict, 0.0, 50, 6, 0.5)[1].first()
    assert manifest["relaxed"] and manifest["kept_count"] >= 6


def test_ladder_is_distinct_and_falling():
    assert [n for n, *_ in G.threshold_ladder(0.0, 0.0)] == [0]
    steps = G.threshold_ladder(100.0, 0.02)
    assert [s for _, _, s, _ in steps] == sorted((s for _, _, s, _ in steps), reverse=True) and len(steps) == 4


def test_bad_scene_scores_low(spark):
    images = [np.full((12, 12), v) for v in (0, 255, 128)] * 3
    row = G.assess_scene(spark.createDataFrame(frames(images))).first()
    assert {"bad_exposure_frames", "low_contrast_frames", "low_frame_count", "missing_masks"} <= set(row["problems"])
    assert 0 <= row["score"] < 50 and row["frame_count"] == 9


def test_masks_without_a_frame_do_not_count(spark):
    shots = frames([np.full((12, 12), v) for v in (0, 255, 128)]).assign(name=["a.png", "b.png", "c.png"])
    masks = frames([np.full((12, 12), 255)] * 3).assign(name=["a.jpg", "c.png", "stray.png"])
    row = G.assess_scene(spark.createDataFrame(shots), spark.createDataFrame(masks)).first()
    assert row["mask_count"] == 2 and row["frame_count"] == 3


def test_color_frames_and_downscale(spark):
    rng = np.random.default_rng(4)
    image = rng.integers(0, 256, (30, 40, 3), dtype=np.uint8)
    df = spark.createDataFrame(pd.DataFrame({"scene_id": ["a"], "raw_index": [0], "width": [40], "height": [30], "channels": [3], "pixels": [image.tobytes()]}))
    gray = P._gray(image)
    assert P.frame_health(df).first()["brightness"] == pytest.approx(gray.mean())
    small = P.downscale_gray(df, max_side=20).first()
    assert (small["width"], small["height"], len(small["pixels"])) == (20, 15, 300)
    assert abs(np.frombuffer(small["pixels"], np.uint8).mean() - gray.mean()) < 2
    flat = P._resize(np.full((9, 7), 77, np.uint8), 3, 4)
    assert (flat == 77).all()


def test_cube_faces(spark):
    constant = pd.DataFrame({"scene_id": ["a"], "raw_index": [0], "width": [16], "height": [8], "channels": [1], "pixels": [np.full(128, 90, np.uint8).tobytes()]})
    rows = P.expand_cube_faces(spark.createDataFrame(constant), 6).collect()
    assert len(rows) == 6 and all(set(r["pixels"]) == {90} for r in rows)
    with pytest.raises(ValueError):
        P.cube_face_map(spark.range(1).withColumn("face_size", F.lit(2)), faces=("inside",))
    assert P.face_budget(120, 48, 6) == (20, 8)


def test_image_function_falls_back(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(frames(noise(7, rng, shape=(2, 2))))

    def load():
        def double(image):
            if image[0, 0] % 2:
                raise ValueError("odd")
            return np.repeat(np.repeat(image, 2, 0), 2, 1)
        return double

    for r in P.apply_image_model(df, load).collect():
        assert (r["width"], r["status"] == "processed") in ((4, True), (2, False))
    seen = P.apply_image_model(df, lambda: (lambda images: [i * 0 + len(images) for i in images]), chunk=3).collect()
    assert len(seen) == 7 and all(set(r["pixels"]) == {3} for r in seen)


def test_running_psnr_across_chunks(spark):
    rng = np.random.default_rng(6)
    values = rng.normal(20, 3, 3000)
    df = spark.createDataFrame(pd.DataFrame({"scene_id": 0, "step": range(3000), "psnr": values}))
    rows = sorted(G.running_psnr(df, chunk=1000).collect(), key=lambda r: r["step"])
    mean, best = values[0], values[0]
    for i, r in enumerate(rows):
        if i:
            mean, best = 0.9 * mean + 0.1 * values[i], max(best, values[i])
        assert r["running_psnr"] == pytest.approx(mean, rel=1e-12) and r["best_psnr"] == best


def test_chains_that_never_meet_take_as_many_jobs_as_any(spark, monkeypatch):
    """Steady drift: every third (or seventh) frame is kept, so a chain from a wrong start stays wrong through all 64 chunks."""
    written, walked = [], []
    monkeypatch.setattr(G, "durable", lambda df, real=G.durable: written.append(1) or real(df))
    monkeypatch.setattr(G, "_walk_on", lambda *args, real=G._walk_on: walked.append(1) or real(*args))
    jobs = []
    for n in (24, 128):
        pdf = pd.DataFrame({"scene_id": 1, "raw_index": range(n), "width": 200, "height": 1, "pixels": [[255] * i + [0] * (200 - i) for i in range(n)], "sharpness": 50.0})
        ladder = [(0, "strict", 10.0, 6.5 / 200), (1, "loose", 10.0, 2.5 / 200)]
        written.clear()
        got = {(r.pass_no, r.raw_index): (r.kept, r.frame_diff) for r in G.near_dup_gate(spark.createDataFrame(pdf), ladder, chunk=2).collect()}
        jobs.append(len(written))
        for pass_no, step in ((0, 7), (1, 3)):
            assert [i for i in range(n) if got[pass_no, i][0]] == list(range(0, n, step))
            assert all(abs(got[pass_no, i][1] - ((i - 1) % step + 1) / 200) < 1e-12 for i in range(1, n)) and got[pass_no, 0][1] is None
    assert jobs[0] == jobs[1] and len(walked) == 2
