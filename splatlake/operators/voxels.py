"""Voxel clustering of splat clouds: occupancy, connected components, selection, cleanup.

Connected components run in two steps that never hold a scene in one task.  The
voxel grid is cut into cubes of 32 voxels a side, at most 32768 voxels each, which
are labelled one by one; what remains is a far smaller graph of pieces that touch
across cube faces.  That graph is contracted round by round (hook every piece to
its smallest neighbour, follow the pointers to their ends, relabel the edges)
until its edges are few enough, by count, to finish in one step per scene.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.order_stats import group_stats
from ..functions.scalars import all_finite, distance, max_ignoring_nan
from ..functions.scaling import attach, durable, groups_of, rows_fit
from .encodings import decode, has_scales
from .splats import CENTER, XYZ, medians

IJK = ("i", "j", "k")
ROOT = ("ci", "cj", "ck")
SEED = ("seed_x", "seed_y", "seed_z")
BLOCK = 32
EDGE_LIMIT = 500_000

# Cleanup parameters by preset name; "" is the unnamed default.
PRESETS = {
    "": dict(opacity_min=0.08, voxel_size=0.10, max_radius=0.0, max_scale=0.0, dilate=1),
    "conservative": dict(opacity_min=0.10, voxel_size=0.12, max_radius=0.0, max_scale=0.0, dilate=1),
    "balanced": dict(opacity_min=0.12, voxel_size=0.10, max_radius=0.0, max_scale=0.0, dilate=1),
    "aggressive": dict(opacity_min=0.12, voxel_size=0.10, max_radius=0.0, max_scale=0.06, dilate=1),
}


# ---- grid ------------------------------------------------------------------

def with_seed(rows: DataFrame, seed=(0.0, 0.0, 0.0)) -> DataFrame:
    return rows.withColumns({n: F.lit(float(v)) for n, v in zip(SEED, seed)})


def voxel_key(rows: DataFrame, size: float) -> DataFrame:
    """Add integer voxel coordinates i, j, k about the row's seed columns."""
    if size <= 0:
        raise ValueError("voxel_size must be positive")
    return rows.withColumns({v: F.floor((F.col(p) - F.col(s)) / size) for v, p, s in zip(IJK, XYZ, SEED)})


def voxel_occupancy(voxeled: DataFrame, keys=("scene_id",)) -> DataFrame:
    return voxeled.groupBy(*keys, *IJK).agg(F.count("*").alias("n"))


def neighbor_offsets(connectivity: int = 26, half: bool = False) -> list[tuple[int, int, int]]:
    """Offsets to face (6), edge (18) or corner (26) neighbours; `half` keeps one of each opposite pair."""
    reach = {6: 1, 18: 2, 26: 3}
    if connectivity not in reach:
        raise ValueError("connectivity must be 6, 18 or 26")
    cube = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]
    return [o for o in cube if 0 < sum(map(abs, o)) <= reach[connectivity] and (not half or o > (0, 0, 0))]


def _offset_column(offsets) -> Column:
    return F.array(*[F.struct(*[F.lit(int(v)).alias(n) for n, v in zip(("di", "dj", "dk"), o)]) for o in offsets])


def voxel_edges(voxels: DataFrame, connectivity: int = 26, keys=("scene_id",)) -> DataFrame:
    """Undirected edges between occupied voxels, each once, as i, j, k and i2, j2, k2."""
    far = ("i2", "j2", "k2")
    moved = (voxels.select(*keys, *IJK, F.explode(_offset_column(neighbor_offsets(connectivity, half=True))).alias("o"))
             .select(*keys, *IJK, *[(F.col(v) + F.col(f"o.d{v}")).alias(f) for v, f in zip(IJK, far)]))
    there = voxels.select(*keys, *[F.col(v).alias(f) for v, f in zip(IJK, far)])
    return moved.join(there, [*keys, *far])


# ---- connected components --------------------------------------------------

def _smallest_labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Label 0..n-1 by the smallest index each is connected to."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        nxt = label.copy()
        np.minimum.at(nxt, label[u], low)
        np.minimum.at(nxt, label[v], low)
        while True:
            hop = nxt[nxt]
            if np.array_equal(hop, nxt):
                break
            nxt = hop
        if np.array_equal(nxt, label):
            break
        label = nxt
    return label


def _block_labeller(connectivity: int):
    steps = np.array(neighbor_offsets(connectivity, half=True))

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(IJK), ignore_index=True)
        at = pdf[list(IJK)].to_numpy()
        at = at - at.min(axis=0) + 1
        grid = np.full(at.max(axis=0) + 2, -1)
        grid[tuple(at.T)] = np.arange(len(at))
        us, vs = [], []
        for step in steps:
            near = grid[tuple((at + step).T)]
            hit = near >= 0
            us.append(np.flatnonzero(hit))
            vs.append(near[hit])
        label = _smallest_labels(len(at), np.concatenate(us), np.concatenate(vs))
        for root, v in zip(ROOT, IJK):
            pdf[root] = pdf[v].to_numpy()[label]
        return pdf.drop(columns=["bi", "bj", "bk"])

    return label


def _solve_scene(pdf: pd.DataFrame) -> pd.DataFrame:
    """Smallest reachable piece for every piece named in one scene's edges."""
    a = pdf[["ai", "aj", "ak"]].to_numpy()
    b = pdf[["bi", "bj", "bk"]].to_numpy()
    nodes, place = np.unique(np.concatenate([a, b]), axis=0, return_inverse=True)
    place = place.ravel()
    label = _smallest_labels(len(nodes), place[:len(a)], place[len(a):])
    out = pd.DataFrame({k: pdf[k].iloc[0] for k in pdf.columns if k not in ("ai", "aj", "ak", "bi", "bj", "bk")}, index=range(len(nodes)))
    for n, values in zip((*ROOT, "ri", "rj", "rk"), np.concatenate([nodes, nodes[label]], axis=1).T):
        out[n] = values
    return out


def _contract(edges: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """One contraction: piece -> root pointers, and the distinct edges left between roots."""
    both = edges.unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
    pointers = durable(both.groupBy(*keys, "a").agg(F.min("b").alias("low"))
                       .select(*keys, "a", F.least("a", "low").alias("p")))
    while True:
        next_hop = pointers.select(*keys, F.col("a").alias("p"), F.col("p").alias("pp"))
        hopped = durable(attach(pointers, next_hop, [*keys, "p"]))
        pointers = hopped.select(*keys, "a", F.coalesce("pp", "p").alias("p"))
        if hopped.filter("pp <> p").isEmpty():
            break
    left = attach(edges, pointers, [*keys, "a"]).withColumn("a", F.coalesce("p", "a")).drop("p")
    as_b = pointers.select(*keys, F.col("a").alias("b"), "p")
    right = attach(left, as_b, [*keys, "b"]).withColumn("b", F.coalesce("p", "b")).drop("p")
    return pointers, durable(right.filter("a <> b").select(*keys, "a", "b").distinct())


def voxel_components(voxels: DataFrame, connectivity: int = 26, keys=("scene_id",), block: int = BLOCK,
                     edge_limit: int = EDGE_LIMIT) -> DataFrame:
    """Add the component of every occupied voxel, named by its smallest voxel (ci, cj, ck)."""
    keys = list(keys)
    cut = voxels.select(*keys, *IJK, "n", *[F.floor(F.col(v) / block).alias(f"b{v}") for v in IJK])
    drop = {"bi", "bj", "bk"}
    schema = T.StructType([f for f in cut.schema.fields if f.name not in drop]
                          + [T.StructField(r, T.LongType()) for r in ROOT])
    labels = durable(cut.groupBy(*keys, "bi", "bj", "bk").applyInPandas(_block_labeller(connectivity), schema))

    edge_of_block = F.lit(False)
    for v in IJK:
        edge_of_block = edge_of_block | F.pmod(F.col(v), F.lit(block)).isin(0, block - 1)
    rim = labels.filter(edge_of_block).select(*keys, *IJK, F.struct(*ROOT).alias("root"))
    far = ("i2", "j2", "k2")
    moved = (rim.select(*keys, *IJK, F.col("root").alias("a"), F.explode(_offset_column(neighbor_offsets(connectivity, half=True))).alias("o"))
             .select(*keys, "a", *IJK, *[(F.col(v) + F.col(f"o.d{v}")).alias(f) for v, f in zip(IJK, far)]))
    crosses = F.lit(False)
    for v, f in zip(IJK, far):
        crosses = crosses | (F.floor(F.col(v) / block) != F.floor(F.col(f) / block))
    there = rim.select(*keys, *[F.col(v).alias(f) for v, f in zip(IJK, far)], F.col("root").alias("b"))
    edges = durable(moved.filter(crosses).join(there, [*keys, *far]).filter("a <> b").select(*keys, "a", "b").distinct())

    rounds = []
    left = edges.count()
    while left > edge_limit:
        pointers, edges = _contract(edges, keys)
        rounds.append(pointers.select(*keys, F.col("a").alias("root"), F.col("p").alias("new_root")))
        left = edges.count()
    if left:
        flat = edges.select(*keys, *[F.col(f"{e}.{r}").alias(f"{e}{v}") for e in "ab" for r, v in zip(ROOT, IJK)])
        out = T.StructType([f for f in flat.schema.fields if f.name in keys]
                           + [T.StructField(n, T.LongType()) for n in (*ROOT, "ri", "rj", "rk")])
        solved = flat.groupBy(*keys).applyInPandas(_solve_scene, out)
        rounds.append(solved.select(*keys, F.struct(*ROOT).alias("root"),
                                    F.struct(*[F.col(f"r{v}").alias(r) for v, r in zip(IJK, ROOT)]).alias("new_root")))
    labels = labels.select(*keys, *IJK, "n", F.struct(*ROOT).alias("root"))
    for mapping in rounds:
        labels = attach(labels, mapping, [*keys, "root"]).withColumn("root", F.coalesce("new_root", "root")).drop("new_root")
    labels = labels.select(*keys, *IJK, "n", *[F.col(f"root.{r}").alias(r) for r in ROOT])
    return durable(labels) if rounds else labels


# ---- component tables ------------------------------------------------------

def component_stats(labelled: DataFrame, size: float, seeds: DataFrame | None = None, seed=(0.0, 0.0, 0.0), keys=("scene_id",)) -> DataFrame:
    """Points, voxels, mean voxel centre and its distance to the seed, per component."""
    keys = list(keys)
    stats = labelled.groupBy(*keys, *ROOT).agg(
        F.sum("n").alias("point_count"), F.count("*").alias("voxel_count"),
        *[F.avg((F.col(v) + 0.5) * size).alias(c) for v, c in zip(IJK, CENTER)])
    stats = attach(stats, seeds.select(*keys, *SEED), keys) if seeds is not None else with_seed(stats, seed)
    # the mean centre relative to the seed is already its offset from the seed
    away = distance(CENTER, [F.lit(0.0)] * 3)
    stats = stats.withColumn("distance_to_seed", away)
    return stats.withColumns({c: F.col(c) + F.col(s) for c, s in zip(CENTER, SEED)}).drop(*SEED)


def select_component(stats: DataFrame, select: str = "nearest", min_points: int = 1000, keys=("scene_id",)) -> DataFrame:
    """The component to keep per scene; without any big enough one, the largest."""
    if select not in ("largest", "nearest"):
        raise ValueError("select must be largest or nearest")
    big = F.col("point_count") >= min_points
    by_distance = [F.when(big, F.col("distance_to_seed")).asc_nulls_last()] if select == "nearest" else []
    order = Window.partitionBy(*keys).orderBy(big.desc(), *by_distance, F.col("point_count").desc(), *ROOT)
    return stats.withColumn("_i", F.row_number().over(order)).filter("_i = 1").drop("_i")


def largest_components(stats: DataFrame, n: int = 12, keys=("scene_id",)) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("point_count").desc(), *ROOT)
    return stats.withColumn("component_rank", F.row_number().over(order)).filter(F.col("component_rank") <= n)


def dilate(voxels: DataFrame, rounds: int = 1, keys=("scene_id",)) -> DataFrame:
    """Grow a voxel set by `rounds` steps over all 26 neighbours (one cube of offsets)."""
    if rounds <= 0:
        return voxels.select(*keys, *IJK)
    span = range(-rounds, rounds + 1)
    cube = [(a, b, c) for a in span for b in span for c in span]
    return (voxels.select(*keys, *IJK, F.explode(_offset_column(cube)).alias("o"))
            .select(*keys, *[(F.col(v) + F.col(f"o.d{v}")).alias(v) for v in IJK]).distinct())


def keep_points_in_voxels(voxeled: DataFrame, kept: DataFrame, keys=("scene_id",), rows: int | None = None) -> DataFrame:
    """Points whose voxel is kept.  A dilated set is far larger than its estimate, so its rows are counted, unless the caller did (`rows`)."""
    kept = kept.select(*keys, *IJK)
    if rows is None:
        return attach(voxeled, kept, [*keys, *IJK], "left_semi", grown=True, isolate=False)
    return voxeled.join(F.broadcast(kept) if rows_fit(kept, rows) else kept.hint("merge"), [*keys, *IJK], "left_semi")


# ---- cleanup ---------------------------------------------------------------

@dataclass(frozen=True)
class CleanParams:
    """Cleanup settings; `None` takes the preset's value."""

    opacity_min: float | None = None
    voxel_size: float | None = None
    max_radius: float | None = None
    max_scale: float | None = None
    dilate: int | None = None
    connectivity: int = 26
    select: str = "nearest"
    seed: tuple = (0.0, 0.0, 0.0)
    min_component_points: int = 1000
    auto: bool = False
    apply_auto_radius: bool = False
    min_high: int = 1000
    preset: str = ""

    def resolved(self) -> "CleanParams":
        if self.preset not in PRESETS:
            raise ValueError(f"Unknown cleanup preset: {self.preset}")
        missing = {k: v for k, v in PRESETS[self.preset].items() if getattr(self, k) is None}
        return replace(self, **missing)


@dataclass(frozen=True)
class CleanResult:
    kept: DataFrame
    report: DataFrame
    components: DataFrame


def auto_cleanup_params(decoded: DataFrame, opacity_min: float, seed=(0.0, 0.0, 0.0), max_radius: float = 0.0,
                        max_scale: float = 0.0, min_high: int = 1000, keys=("scene_id",), size_of=None) -> DataFrame:
    """Seed, radius and scale limit estimated per scene from its confident core.

    The core is the points above the larger of `opacity_min` and the 35th opacity
    percentile; with too few of those, above `opacity_min`; else every finite point.
    """
    keys = list(keys)
    size_of = groups_of(size_of if size_of is not None and set(keys) <= set(size_of.columns) else decoded, keys)  # counted once for all steps
    ok = all_finite(*XYZ, "opacity")
    rows = decoded.withColumn("_ok", ok)
    p35 = durable(group_stats(rows, keys, {"p35": (F.when(F.col("_ok"), F.col("opacity")), 0.35)}, [F.count_if("_ok").alias("finite_count")], size_of=size_of)
                  .withColumn("opacity_floor", F.greatest(F.lit(float(opacity_min)), "p35")))
    rows = attach(rows, p35.select(*keys, "opacity_floor"), keys)
    counts = rows.groupBy(*keys).agg(F.count_if(F.col("_ok") & (F.col("opacity") >= F.col("opacity_floor"))).alias("n1"),
                                     F.count_if(F.col("_ok") & (F.col("opacity") >= opacity_min)).alias("n2"))
    cut = (F.when(F.col("n1") >= min_high, F.col("opacity_floor")).when(F.col("n2") >= min_high, F.lit(float(opacity_min)))
           .otherwise(F.lit(float("-inf"))))
    levels = durable(p35.join(counts, keys).select(*keys, "opacity_floor", "finite_count", cut.alias("cut")))
    rows = attach(rows.drop("opacity_floor"), levels.select(*keys, "cut"), keys)
    high = F.col("_ok") & (F.col("opacity") >= F.col("cut"))
    rows = rows.withColumn("_high", high)
    centers = durable(medians(rows, keys, F.col("_high"), size_of=size_of))
    rows = attach(rows, centers, keys)
    dist = F.when(F.col("_high"), distance(XYZ, CENTER))
    wide = F.when(F.col("_high"), max_ignoring_nan("sx", "sy", "sz"))
    stats = group_stats(rows, keys, {"d85": (dist, 0.85), "d90": (dist, 0.90), "s90": (wide, 0.90), "s95": (wide, 0.95)},
                        [F.count_if("_high").alias("high_confidence_count")], size_of=size_of)
    out = levels.join(centers, keys).join(stats, keys)
    radius = F.greatest(F.col("d85") * 2.20, F.col("d90") * 1.75, F.lit(0.5))
    scale = F.greatest(F.col("s90") * 1.80, F.col("s95") * 1.20)
    at_origin = all(abs(s) <= 1e-8 for s in seed)
    used_seed = [F.coalesce(F.col(c), F.lit(float(s))) if at_origin else F.lit(float(s)) for c, s in zip(CENTER, seed)]
    return out.select(
        *keys, "high_confidence_count", "opacity_floor", *[F.col(c).alias(f"estimated_{s}") for c, s in zip(CENTER, SEED)],
        radius.alias("estimated_max_radius"), scale.alias("estimated_max_scale"),
        *[v.alias(s) for v, s in zip(used_seed, SEED)],
        (radius if max_radius <= 0 else F.lit(float(max_radius))).alias("used_max_radius"),
        (F.coalesce(scale, F.lit(0.0)) if max_scale <= 0 else F.lit(float(max_scale))).alias("used_max_scale"))


def cluster_clean(splats: DataFrame, params: CleanParams = CleanParams(), keys=("scene_id",), id_col: str = "point_id",
                  strict: bool = False) -> CleanResult:
    """Keep one voxel component of every scene in a single job.

    Only ids, positions, opacity and scales travel through the clustering; join the
    result back by id for wide per-splat payload such as higher harmonics.
    """
    keys, p = list(keys), params.resolved()
    slim = [c for c in (id_col, *XYZ, "opacity_raw", "scale_raw_0", "scale_raw_1", "scale_raw_2") if c in splats.columns]
    decoded = decode(splats.select(*keys, *slim), keys)
    base = all_finite(*XYZ, "opacity") & (F.col("opacity") >= p.opacity_min)
    if p.max_radius > 0:
        base = base & (distance(XYZ, [F.lit(float(s)) for s in p.seed]) <= p.max_radius)
    seeds = None
    if p.auto:
        seeds = durable(auto_cleanup_params(decoded, p.opacity_min, p.seed, p.max_radius, p.max_scale, p.min_high, keys, size_of=splats))
        decoded = attach(decoded, seeds.select(*keys, *SEED, "used_max_radius", "used_max_scale"), keys)
        limit = F.col("used_max_scale")
        if p.apply_auto_radius:
            base = base & (distance(XYZ, SEED) <= F.col("used_max_radius"))
    else:
        decoded = with_seed(decoded, p.seed)
        limit = F.lit(float(p.max_scale))
    if has_scales(splats) and (p.auto or p.max_scale > 0):
        base = base & ((limit <= 0) | (max_ignoring_nan("sx", "sy", "sz") <= limit))

    voxeled = voxel_key(decoded.filter(base), p.voxel_size)
    labelled = voxel_components(voxel_occupancy(voxeled, keys), p.connectivity, keys)
    stats = component_stats(labelled, p.voxel_size, seeds, p.seed, keys)
    chosen = durable(select_component(stats, p.select, p.min_component_points, keys))
    core = attach(labelled, chosen.select(*keys, *ROOT), [*keys, *ROOT], "left_semi")
    # growing can only ever catch occupied voxels, so meet it with those before touching points
    kept_voxels = dilate(core, p.dilate, keys).join(labelled.select(*keys, *IJK, "n"), [*keys, *IJK])
    kept_voxels = durable(kept_voxels)
    kept = keep_points_in_voxels(voxeled, kept_voxels, keys, rows=kept_voxels.count())  # a count of a written table reads no column

    total = splats.groupBy(*keys).agg(F.count("*").alias("input_count"))
    by_scene = labelled.groupBy(*keys).agg(F.sum("n").alias("base_count"), F.countDistinct(*ROOT).alias("component_count"))
    out = kept_voxels.groupBy(*keys).agg(F.sum("n").alias("output_count"))
    picked = chosen.select(*keys, F.col("point_count").alias("selected_point_count"), F.col("voxel_count").alias("selected_voxel_count"),
                           *[F.col(c).alias(f"selected_{c}") for c in CENTER], F.col("distance_to_seed").alias("selected_distance_to_seed"))
    report = total.join(by_scene, keys, "left").join(out, keys, "left").join(picked, keys, "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("base_count", "component_count", "output_count")}
    report = report.withColumns(zero)
    removed = F.col("input_count") - F.col("output_count")
    empty = F.col("base_count") == 0
    bad = F.raise_error("All points were removed before component cleanup") if strict else F.lit("empty_base")
    report = report.withColumns({"removed_count": removed, "removed_percent": removed / F.greatest(F.lit(1), "input_count") * 100.0,
                                 "status": F.when(empty, bad).otherwise(F.lit("ok")), "preset": F.lit(p.preset)})
    return CleanResult(kept, report, stats)
