"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table projects unit vectors on a few Gaussian directions and cuts the projections into
slots; a bucket is a tuple of slots.  Given where a query projects, a neighbour
of cosine c projects at N(c p, 1 - c^2) on each direction, which gives every bucket near the query a
probability to hold it.  Buckets are visited in that order until the wanted success
probability is reached.  Candidates of all tables are merged and ranked by exact cosine.

c is each query's own: the k-th best cosine it has met so far, first against a bounded sample, then
in its likeliest buckets.  The true k-th neighbour is no farther, so the buckets are those for every cosine
from c to 1.  A query that has met fewer than k rows by then is compared with all rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from . import vectors as V
from .common import durable

TABLES, DIRECTIONS, WIDTH = 3, 5, 1.5  # width in standard deviations of a projection
SUCCESS = 0.995  # wanted for the tables together
SAMPLE = 1024  # vectors of each length that every query is compared with first
FIRST = 16  # likeliest buckets of a table that give the better estimate
REACH = 3  # slots on each side of the middle
SEED = 20240101


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def _directions(dim: int, table: int):
    rng = np.random.default_rng([SEED, dim, table])
    a = rng.normal(size=(dim, DIRECTIONS))
    return a / np.linalg.norm(a, axis=0) * np.sqrt(dim), rng.uniform(0, WIDTH, DIRECTIONS), rng.integers(1 << 20, 1 << 60, DIRECTIONS) | 1


_STEPS = np.arange(-REACH, REACH + 1)


def probes(p: np.ndarray, shift: np.ndarray, cos: float, success: float) -> np.ndarray:
    """Slots (moves x directions) of the buckets to visit, likeliest first, for neighbours of cosine `cos` to 1.

    p: the query's projections on the directions; shift: of the slots.  A neighbour of cosine c projects at N(c p, 1 - c^2).
    The moves hold it with probability `success` for each of a few c, so far as REACH goes.
    """
    low = np.floor(((1 + cos) / 2 * p + shift) / WIDTH) - REACH
    edge = (np.arange(2 * REACH + 2)[:, None] + low[None]) * WIDTH - shift[None]
    totals = []
    for c in (cos, (1 + cos) / 2, (15 + cos) / 16):
        mass = np.diff(_normal((edge - c * p[None]) / max(1 - c * c, 1e-6) ** 0.5), axis=0)
        total = mass[:, 0]
        for d in range(1, mass.shape[1]):
            total = (total[:, None] * mass[None, :, d]).ravel()
        totals.append(total)
    order = np.argsort(-sum(totals), kind="stable")
    n = max(int(np.searchsorted(np.cumsum(t[order]), success)) + 1 for t in totals)
    return np.stack(np.unravel_index(order[:n], (2 * REACH + 1,) * len(p)), axis=1) + low[None].astype(np.int64)


def _normal(x):
    """Normal distribution function, to about 1e-7."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = np.exp(-x * x / 2) / 2.5066282746310002 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(x >= 0, 1 - tail, tail)


def _sample(index: DataFrame) -> dict[int, tuple[np.ndarray, list]]:
    """Per vector length (bytes) SAMPLE distinct vectors, as units, and their ids."""
    first = W.partitionBy(F.length("v")).orderBy(F.xxhash64("v"), "v")
    # The hash bounds what is sorted where one length has most rows.
    sizes = index.groupBy(F.length("v").alias("size")).agg(F.count("*").alias("n"))
    few = index.withColumn("size", F.length("v")).join(F.broadcast(sizes), "size").filter(F.xxhash64("v") / 2.0**64 + 0.5 <= 4.0 * SAMPLE / F.col("n"))
    rows = few.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= SAMPLE).select("v", "ids").collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r["v"]), []).append(r)
    return {size: (_unit(np.frombuffer(b"".join(r["v"] for r in own)).reshape(len(own), -1)), [r["ids"] for r in own]) for size, own in by.items()}


def search(vectors: DataFrame, queries, k: int = 5, success: float = SUCCESS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by cosine for the rows that the condition `queries` selects.

    vectors(vec_id, embedding).  Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do rows without an id; vectors of different lengths never meet.  Copies of
    a vector are searched once and reported one by one, ties to the smaller id.
    """
    rows = durable(V.usable(vectors, lambda x: x if x.any() else None))
    index = durable(V.distinct(rows, k))
    n = index.count()
    sample = _sample(index)
    each = 1 - (1 - success) ** (1 / TABLES)
    parts = max(1, -(-n // V.BLOCK_ROWS))

    def codes_of(slots: np.ndarray, mix: np.ndarray, dim: int):
        with np.errstate(over="ignore"):
            return (slots.astype(np.int64) * mix).sum(1) + dim

    def part_of(codes: np.ndarray, table: int):
        return table * parts + (codes.view(np.uint64) % np.uint64(parts)).astype(np.int64)

    def place(batches):
        for b in batches:
            raw = b.column(0).to_pylist()
            sizes = np.array([len(x) for x in raw])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                v = np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), -1)
                own = b.take(pa.array(at))
                for t in range(TABLES):
                    a, shift, mix = _directions(v.shape[1], t)
                    code = codes_of(np.floor((_unit(v) @ a + shift) / WIDTH), mix, v.shape[1])
                    part = part_of(code, t)
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(code), own.column(0), own.column(1)], ["part", "code", "v", "ids"])

    def meet(batches):
        """Each query against the sample."""
        for b in batches:
            out = []
            for q, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x, ids = sample.get(len(raw), (None, []))
                if ids:
                    out += [(q, v, s) for s, v in V.best(x @ _unit(np.frombuffer(raw)), ids, q, k)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    def ask(limit):
        def run(batches):
            for b in batches:
                for q, raw, cos in zip(*(c.to_pylist() for c in b.columns)):
                    out = [[], []]
                    v = _unit(np.frombuffer(raw))
                    if cos is None and limit is None:  # all rows, once: those of the first table
                        out = [list(range(parts)), [None] * parts]
                    for t in range(TABLES if not out[0] else 0):
                        a, shift, mix = _directions(len(v), t)
                        codes = codes_of(probes(v @ a, shift, min(max(cos or 0.0, 0.0), 1.0), each)[:limit], mix, len(v))
                        own = part_of(codes, t)
                        for p in np.unique(own).tolist():
                            out[0].append(p)
                            out[1].append(codes[own == p])
                    m = len(out[0])
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array([q] * m, pa.int64()), pa.array([raw] * m, pa.binary()), pa.array(out[1], pa.list_(pa.int64()))],
                                                     ["part", "query_id", "v", "codes"])
        return run

    # A bucket may hold any number of rows, so what goes to one task is cut by count, and queries go to every cut.
    placed = durable(index.mapInArrow(place, "part long, code long, v binary, ids array<long>"))
    cuts = durable(placed.groupBy("part").agg(F.ceil(F.count("*") / (2 * V.BLOCK_ROWS)).alias("cuts")))
    held = placed.join(cuts, "part").withColumn("cut", F.pmod(F.xxhash64("v"), F.col("cuts"))).drop("cuts")
    def rerank(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(asked):
            sizes = own["v"].map(len).to_numpy()
            for size in np.unique(sizes):
                mine = own[sizes == size].sort_values("code", kind="stable")
                x = np.frombuffer(b"".join(mine["v"])).reshape(len(mine), -1)
                length, code, ids = np.linalg.norm(x, axis=1), mine["code"].to_numpy(), mine["ids"].tolist()
                cells, start = np.unique(code, return_index=True)
                end = np.append(start[1:], len(code))
                for q, raw, codes in zip(asked["query_id"], asked["v"], asked["codes"]):
                    if len(raw) != size:
                        continue
                    hit = np.arange(len(cells)) if codes is None else np.flatnonzero(np.isin(cells, codes))
                    at = np.concatenate([np.arange(start[i], end[i]) for i in hit]) if len(hit) else np.zeros(0, np.int64)
                    y = np.frombuffer(raw)
                    scores = (x[at] @ y) / (length[at] * np.linalg.norm(y))
                    out += [(q, v, s) for s, v in V.best(scores, [ids[i] for i in at], q, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def look(asked: DataFrame, limit: int | None) -> DataFrame:
        asked = asked.select("query_id", "v", "cos").mapInArrow(ask(limit), "part long, query_id long, v binary, codes array<long>")
        asked = asked.join(cuts.withColumnRenamed("cuts", "last"), "part").withColumn("cut", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last") - 1))).drop("last")
        return durable(held.groupBy("part", "cut").cogroup(asked.groupBy("part", "cut")).applyInPandas(rerank, "query_id long, vec_id long, score double"))

    asked = durable(rows.filter(queries).select(F.col("vec_id").alias("query_id"), "v"))
    found = durable(asked.mapInArrow(meet, "query_id long, vec_id long, score double"))
    for limit in (FIRST, None):
        worst = V.ranked(found, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("cos"))
        found = found.union(look(asked.join(worst, "query_id", "left"), limit))
    return V.ranked(found, k)
