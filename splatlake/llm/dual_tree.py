"""Exact top-k inner products by dual-tree search over cover trees.

Queries and rows share the top level of one tree: pivots from a bounded sample, every vector below its nearest
pivot, with the exact covering radius of each node.  For a query node (center a, radius
r) and a row node (center b, radius s) no inner product exceeds a.b + r|b| + s|a| + rs; a pair of
nodes whose bound is below the worst k-th score of the query node is never expanded.  Below
the top each task builds a tree over its own rows and goes on in the same way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import vectors as V
from .common import durable

SCALE = 64
SAMPLE, PIVOTS = 2048, 24  # vectors looked at for pivots; top-level nodes
GROUP = 1024  # queries that travel together
LEAF, FAN = 256, 16


def quantise(x: np.ndarray) -> np.ndarray:
    """floor(64 * x), exact in doubles up to 2^53."""
    return np.floor(SCALE * x)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles are exact below 2^53, beyond that Python's integers count."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return a @ b.T
    return np.array([[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a], object).reshape(len(a), len(b))


def centers(x: np.ndarray, n: int) -> np.ndarray:
    """Rows that are far from each other: each the farthest from those before (first: row 0)."""
    chosen, gap = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return np.array(chosen)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest center of each row and the distance to it."""
    square = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]
    at = square.argmin(1)
    return at, np.linalg.norm(x - c[at], axis=1)


class Node:
    """A ball over some rows: center, covering radius, and children or the rows themselves."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, center: np.ndarray):
        self.rows, self.center, self.children = rows, center, []
        self.radius = float(np.linalg.norm(x[rows] - center, axis=1).max())
        if len(rows) > LEAF and self.radius > 0:
            c = x[rows[centers(x[rows], FAN)]]
            at, _ = nearest(x[rows], c)
            self.children = [Node(x, rows[at == i], c[i]) for i in range(len(c)) if (at == i).any()]


def bound(a, r, b, s):
    """No inner product of a vector within r of a and one within s of b is larger."""
    na, nb = np.linalg.norm(a, axis=-1), np.linalg.norm(b, axis=-1)
    return ((a * b).sum(-1) + r * nb + s * na + r * s) * (1 + 1e-12) + 1e-6 * (1 + na * nb)


def dual(q: np.ndarray, x: np.ndarray, worst: np.ndarray, keep) -> None:
    """Visit pairs of nodes over q and x; keep(query rows, data rows) scores a pair of leaves and may raise `worst`."""
    if not len(q) or not len(x):
        return
    todo = [(Node(q, np.arange(len(q)), q.mean(0)), Node(x, np.arange(len(x)), x.mean(0)))]
    while todo:
        a, b = todo.pop()
        if bound(a.center, a.radius, b.center, b.radius) < worst[a.rows].min():
            continue
        if not a.children and not b.children:
            keep(a.rows, b.rows)
            continue
        pairs = [(a, y) for y in b.children] if b.children and (not a.children or b.radius >= a.radius) else [(y, b) for y in a.children]
        todo += sorted(pairs, key=lambda p: bound(p[0].center, p[0].radius, p[1].center, p[1].radius))  # best last, so next


def _block(own: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """Top k within one row node of the queries sent to it, given the worst score each must beat."""
    out = []
    for size in sorted(set(own["v"].map(len)) & set(asked["v"].map(len))):
        mine, theirs = own[own["v"].map(len) == size], asked[asked["v"].map(len) == size]
        x = np.frombuffer(b"".join(mine["v"])).reshape(len(mine), -1)
        q = np.frombuffer(b"".join(theirs["v"])).reshape(len(theirs), -1)
        ids, name = mine["ids"].tolist(), theirs["query_id"].tolist()
        worst = theirs["worst"].to_numpy(np.float64).copy()
        tops: list[list] = [[] for _ in name]

        def keep(qs, xs):
            score = products(q[qs], x[xs])
            for i, s in zip(qs.tolist(), score):
                near = np.flatnonzero(s >= worst[i])
                if len(near):
                    tops[i] = sorted([(-v, y) for v, y in tops[i]] + [(-v, y) for v, y in V.best(s[near], [ids[j] for j in xs[near]], name[i], k)])[:k]
                    tops[i] = [(-v, y) for v, y in tops[i]]
                    if len(tops[i]) == k:
                        worst[i] = max(worst[i], float(tops[i][-1][0]))

        if x.shape[1]:
            dual(q, x, worst, keep)
        else:
            tops = [V.best(np.zeros(len(x)), ids, n, k) for n in name]
        limit = (1 << 63) - 1
        out += [(n, y, max(-limit, min(limit, int(v)))) for n, top in zip(name, tops) for v, y in top]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, queries, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of floor(64 x), for the rows that `queries` selects.

    vectors(vec_id, embedding).  Null vectors and such as hold null or non-finite components take
    no part, nor do rows without an id; vectors of different lengths never meet.  Scores beyond a long are held at its ends.  Copies are searched once and
    reported one by one, ties to the smaller id.
    """
    rows = durable(V.usable(vectors, quantise))
    index = durable(V.distinct(rows, k))
    sample = [np.frombuffer(r[0]) for r in index.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()]
    pivots = {}
    for size in {len(x) for x in sample}:
        x = np.array([y for y in sample if len(y) == size])
        pivots[size] = x[centers(x, PIVOTS)] if size else x[:1]
    # pivots: PIVOTS vectors per vector length in the sample, whatever the table's size; other lengths use the origin.

    def assign(batches):
        for b in batches:
            at = b.schema.get_field_index("v")
            node, away = [], []
            for raw in b.column(at).to_pylist():
                x = np.frombuffer(raw)[None]
                c = pivots.get(x.shape[1], np.zeros((1, x.shape[1])))
                i, d = nearest(x, c)
                node.append(x.shape[1] * PIVOTS + int(i[0]))
                away.append(float(d[0]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(node, pa.int64()), pa.array(away, pa.float64())], [*b.schema.names, "node", "away"])

    def tree(df, schema, rows_each):
        df = durable(df.mapInArrow(assign, f"{schema}, node long, away double"))
        cuts = df.groupBy("node").agg(F.ceil(F.count("*") / rows_each).alias("cuts"))
        return durable(df.join(cuts, "node").withColumn("cut", F.pmod(F.xxhash64("v"), F.col("cuts"))).drop("cuts"))

    data = tree(index.select("v", "ids"), "v binary, ids array<long>", V.BLOCK_ROWS)
    asked = tree(rows.filter(queries).select("v", F.col("vec_id").alias("query_id")), "v binary, query_id long", GROUP)

    def ball(df):
        return df.groupBy("node", "cut").agg(F.max("away").alias("radius"))

    def run(pairs):
        """pairs: asked rows with worst, and the row node (to_node, to_cut) each goes to."""
        return durable(data.withColumnsRenamed({"node": "to_node", "cut": "to_cut"}).groupBy("to_node", "to_cut").cogroup(pairs.groupBy("to_node", "to_cut"))
                       .applyInPandas(lambda a, b: _block(a, b, k), "query_id long, vec_id long, score long"))

    data_balls = durable(ball(data))
    first = asked.select("query_id", "v", F.lit(-1e300).alias("worst"), F.col("node").alias("to_node")).join(
        data_balls.filter("cut = 0").select(F.col("node").alias("to_node"), F.col("cut").alias("to_cut")), "to_node")
    found = run(first)
    worst = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(None)).alias("worst"))
    asked = durable(asked.join(worst, "query_id", "left").withColumn("worst", F.coalesce(F.col("worst").cast("double"), F.lit(-1e300))))

    def prune(batches):
        for b in batches:
            g = {c: b.column(b.schema.get_field_index(c)).to_pylist() for c in ("node", "radius", "low", "to_node", "to_radius")}
            keep = []
            for n, r, low, m, s in zip(*g.values()):
                a, c = (pivots.get(i // PIVOTS, np.zeros((1, i // PIVOTS)))[i % PIVOTS] for i in (n, m))
                keep.append(bound(a, r, c, s) >= low)
            yield b.filter(pa.array(keep, pa.bool_())).select(["node", "cut", "to_node", "to_cut"])

    # Node pairs: both sides are balls of thousands of vectors, and only nodes of the same vector length meet.
    groups = asked.groupBy("node", "cut").agg(F.max("away").alias("radius"), F.min("worst").alias("low"))
    others = data_balls.select(F.col("node").alias("to_node"), F.col("cut").alias("to_cut"), F.col("radius").alias("to_radius"))
    size = lambda c: F.floor(F.col(c) / PIVOTS)
    pairs = groups.join(others, size("node") == size("to_node")).filter("NOT (node = to_node AND to_cut = 0)").mapInArrow(prune, "node long, cut long, to_node long, to_cut long")
    rest = run(asked.join(pairs, ["node", "cut"]).select("query_id", "v", "worst", "to_node", "to_cut"))
    return V.ranked(found.union(rest), k)
