"""Voxel components against a breadth-first search, and the cleanup scenario."""

import uuid
from collections import deque

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splatlake.functions import scaling
from splatlake.operators import neighbors, voxels as V
from splatlake.operators.neighbors import knn_distances


def search(cells, connectivity):
    """Smallest member of each cell's component."""
    offsets, left, label = V.neighbor_offsets(connectivity), set(cells), {}
    while left:
        start = left.pop()
        members, todo = [start], deque([start])
        while todo:
            c = todo.popleft()
            for o in offsets:
                n = tuple(a + b for a, b in zip(c, o))
                if n in left:
                    left.remove(n)
                    members.append(n)
                    todo.append(n)
        label |= {m: min(members) for m in members}
    return label


def labels_of(df, **kw):
    rows = V.voxel_components(df, **kw).collect()
    return {(r["scene_id"], r["i"], r["j"], r["k"]): (r["ci"], r["cj"], r["ck"]) for r in rows}


def snake(n):
    """A long thin object that crosses many blocks."""
    return [(i if (j // 2) % 2 == 0 else n - 1 - i, j, 0) for j in range(0, n, 2) for i in range(n)] + [(n - 1 if (j // 2) % 2 == 0 else 0, j + 1, 0) for j in range(0, n - 2, 2)]


@pytest.mark.parametrize("connectivity,edge_limit", [(6, 0), (18, 10_000), (26, 0)])
def test_components_match_search(spark, connectivity, edge_limit):
    rng = np.random.default_rng(connectivity)
    scenes = {0: [tuple(c) for c in np.unique(rng.integers(-9, 9, (900, 3)), axis=0).tolist()], 1: snake(14), 2: [(0, 0, 0), (500, -700, 3)]}
    pdf = pd.DataFrame([(s, *c, 1) for s, cells in scenes.items() for c in cells], columns=["scene_id", "i", "j", "k", "n"])
    got = labels_of(spark.createDataFrame(pdf), connectivity=connectivity, block=4, edge_limit=edge_limit)
    want = {(s, *c): root for s, cells in scenes.items() for c, root in search(cells, connectivity).items()}
    assert got == want


def test_components_without_broadcast(spark, spread):
    pdf = pd.DataFrame([(0, *c, 1) for c in snake(8)], columns=["scene_id", "i", "j", "k", "n"])
    got = labels_of(spark.createDataFrame(pdf), connectivity=6, block=4, edge_limit=0)
    assert set(got.values()) == {min(snake(8))}


def test_offsets():
    assert [len(V.neighbor_offsets(c)) for c in (6, 18, 26)] == [6, 18, 26]
    assert [len(V.neighbor_offsets(c, half=True)) for c in (6, 18, 26)] == [3, 9, 13]
    with pytest.raises(ValueError):
        V.neighbor_offsets(8)


def body_floaters_haze():
    rng = np.random.default_rng(7)
    body = rng.normal((0.1, 0.2, -0.1), 0.22, (2400, 3))
    floaters = rng.normal((4.0, 3.5, -3.0), 0.2, (160, 3))
    haze = rng.normal((0, 0, 0), 1.5, (80, 3))
    xyz = np.concatenate([body, floaters, haze])
    scale = np.concatenate([rng.uniform(0.01, 0.03, (2560, 3)), rng.uniform(0.20, 0.35, (80, 3))])
    opacity = np.concatenate([rng.uniform(0.5, 0.95, 2400), rng.uniform(0.4, 0.9, 160), rng.uniform(0.1, 0.3, 80)])
    return pd.DataFrame({"scene_id": 0, "point_id": range(2640), "x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2], "opacity_raw": opacity,
                         **{f"scale_raw_{i}": scale[:, i] for i in range(3)}})


def test_auto_parameters_count_groups_once(spark, spread, monkeypatch):
    from splatlake.functions import order_stats, scaling
    from splatlake.operators.encodings import decode

    counted = []
    for module in (order_stats, V):
        if hasattr(module, "groups_of"):
            monkeypatch.setattr(module, "groups_of", lambda *a, real=scaling.groups_of: counted.append(1) or real(*a))
    monkeypatch.setattr(order_stats, "hot_groups", lambda *a, real=scaling.hot_groups: counted.append(1) or real(*a))
    decoded = decode(spark.createDataFrame(body_floaters_haze()))
    counted.clear()
    V.auto_cleanup_params(decoded, 0.1).collect()
    assert len(counted) == 1


def test_cleanup_keeps_the_body(spark):
    df = spark.createDataFrame(body_floaters_haze())
    plain = V.cluster_clean(df, V.CleanParams(auto=True))
    report = plain.report.first()
    assert 2100 <= report["output_count"] <= 2450 and report["removed_count"] >= 180 and report["status"] == "ok"
    assert plain.kept.count() == report["output_count"]
    loose = V.cluster_clean(df, V.CleanParams(preset="balanced")).report.first()
    tight = V.cluster_clean(df, V.CleanParams(preset="aggressive")).report.first()
    assert tight["output_count"] <= loose["output_count"]


def test_cleanup_of_nothing(spark):
    df = spark.createDataFrame(body_floaters_haze().assign(opacity_raw=0.01))
    report = V.cluster_clean(df, V.CleanParams(opacity_min=0.5)).report.first()
    assert report["status"] == "empty_base" and report["output_count"] == 0
    with pytest.raises(Exception, match="All points were removed"):
        V.cluster_clean(df, V.CleanParams(opacity_min=0.5), strict=True).report.collect()
    with pytest.raises(ValueError):
        V.CleanParams(preset="unknown").resolved()


def test_dilation_grows(spark):
    core = spark.createDataFrame(pd.DataFrame({"scene_id": [0, 0], "i": [0, 5], "j": [0, 0], "k": [0, 0]}))
    sizes = [V.dilate(core, r).count() for r in (0, 1, 2)]
    assert sizes == [2, 54, 2 * 125]


def brute(points, k):
    gap = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    np.fill_diagonal(gap, np.inf)
    best = np.sort(gap, axis=1)[:, :k]
    return [[v for v in r if np.isfinite(v)] for r in best]


def test_neighbors_match_brute_force(spark):
    rng = np.random.default_rng(2)
    dense = np.concatenate([rng.normal(0, 0.01, (300, 3)), np.zeros((60, 3)), rng.normal(5, 3, (60, 3)), [[1e6, 0, 0], [-1e6, 3, 0]]])
    scenes = {0: dense, 1: rng.normal(0, 1, (3, 3)), 2: np.zeros((1, 3))}
    pdf = pd.DataFrame([(s, i, *p) for s, pts in scenes.items() for i, p in enumerate(pts)], columns=["scene_id", "point_id", "x", "y", "z"])
    rows = knn_distances(spark.createDataFrame(pdf), 3, leaf=8, fanout=4).collect()
    got = {(r["scene_id"], r["point_id"]): r["distances"] for r in rows}
    assert len(got) == len(pdf)
    for s, pts in scenes.items():
        for i, want in enumerate(brute(pts, 3)):
            assert got[(s, i)] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_dilated_set_is_not_broadcast_by_estimate(spark):
    spark.conf.set("spark.splatlake.broadcastBytes", "100000")
    try:
        cells = spark.range(2000).select(F.lit(0).alias("scene_id"), (F.col("id") * 9).alias("vx"), F.lit(0).cast("long").alias("vy"), F.lit(0).cast("long").alias("vz"))
        cells = cells.toDF("scene_id", *V.IJK)
        kept = V.keep_points_in_voxels(cells, V.dilate(cells, 1))
        assert "Broadcast" not in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 2000
        few = V.keep_points_in_voxels(cells, cells.limit(10))
        assert few.count() == 10 and "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.splatlake.broadcastBytes")


@pytest.mark.parametrize("scenes", [1, 40])
def test_neighbors_write_every_point_once(spark, tmp_path, monkeypatch, scenes):
    """Also where scenes are hot, and where runs are cut by the edges of partitions; only the runs' own table holds all points."""
    monkeypatch.setattr(scaling, "shared_path", lambda spark: f"{tmp_path}/{uuid.uuid4().hex}")
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame(rng.normal(size=(3000, 3)), columns=list("xyz")).assign(point_id=[f"p{i}" for i in range(3000)], scene_id=np.arange(3000) % scenes)
    for name, value in (("oneTaskBytes", "0"), ("oneTaskRows", "60")):
        spark.conf.set(f"spark.splatlake.{name}", value)
    try:
        got = {r.point_id: r.distances for r in knn_distances(spark.createDataFrame(pdf), 3, leaf=16, fanout=4).collect()}
    finally:
        for name in ("oneTaskBytes", "oneTaskRows"):
            spark.conf.unset(f"spark.splatlake.{name}")
    for _, one in pdf.groupby("scene_id"):
        for name, want in zip(one["point_id"], brute(one[list("xyz")].to_numpy(), 3)):
            assert got[name] == pytest.approx(want)
    held = [t for t in (spark.read.parquet(str(f)) for f in tmp_path.iterdir()) if "point_id" in t.columns]
    assert sum(t.count() for t in held) == 3000


def test_neighbors_ask_beyond_their_block_only_near_its_edge(spark, tmp_path, monkeypatch):
    """Points inside a block are done with it; what is asked of other blocks stays far below one row a point, and shuffles go with their step."""
    monkeypatch.setattr(scaling, "shared_path", lambda spark: f"{tmp_path}/{uuid.uuid4().hex}")
    monkeypatch.setattr(neighbors, "BLOCK", 128, raising=False)
    name, kept = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    monkeypatch.setattr(neighbors, "durable", lambda df, **options: kept.append(spark.conf.get(name)) or scaling.durable(df, **options))
    before = spark.conf.get(name)
    points = np.random.default_rng(5).random((6000, 3))
    pdf = pd.DataFrame(points, columns=list("xyz")).assign(point_id=range(6000), scene_id=0)
    got = {r.point_id: r.distances for r in knn_distances(spark.createDataFrame(pdf), 3, leaf=16, fanout=4).collect()}
    assert [got[i] for i in range(6000)] == brute(points, 3)
    assert set(kept) == {"true"} and spark.conf.get(name) == before
    asked = [t for t in (spark.read.parquet(str(f)) for f in tmp_path.iterdir()) if {"_row", "_other", "x"} <= set(t.columns)]
    assert len(asked) == 1 and 0 < asked[0].count() < 6000


@pytest.mark.parametrize("block", [1, 4, 1024])
def test_neighbors_across_blocks_with_odd_points(spark, monkeypatch, block):
    """Copies, lattices, flat scenes, outliers on both sides, coordinates that are no numbers, tiny scenes."""
    monkeypatch.setattr(neighbors, "BLOCK", block, raising=False)
    rng = np.random.default_rng(6)
    lattice = np.stack(np.meshgrid(*[np.arange(7.0)] * 3), -1).reshape(-1, 3)
    odd = np.array([[np.nan, 0, 0], [0, np.inf, 0], [-1e12, 0, 0], [1e12, 3, 0], [-1e-12, 1e9, -1e9]])
    scenes = [np.concatenate([lattice, lattice[:100], np.zeros((90, 3))]), np.concatenate([rng.normal(0, 0.01, (400, 3)), rng.normal(5, 3, (60, 3)), odd]),
              np.concatenate([rng.random((300, 2)), np.ones((300, 1))], axis=1), np.full((50, 3), 2.0), np.zeros((2, 3)), np.ones((1, 3))]
    pdf = pd.DataFrame([(s, i, *p) for s, pts in enumerate(scenes) for i, p in enumerate(pts)], columns=["scene_id", "point_id", "x", "y", "z"])
    got = {(r.scene_id, r.point_id): r.distances for r in knn_distances(spark.createDataFrame(pdf).repartition(5), 3, leaf=8, fanout=4).collect()}
    assert len(got) == len(pdf)
    for s, pts in enumerate(scenes):
        with np.errstate(all="ignore"):
            for i, want in enumerate(brute(pts, 3)):
                assert got[s, i] == pytest.approx(want, rel=1e-12), (s, i)
