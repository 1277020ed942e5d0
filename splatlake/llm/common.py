"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scaling import dropped_shuffles, durable, setting, shared_path

__all__ = ["components", "durable", "dropped_shuffles", "shared_path", "small_batches", "table", "words_of", "WordHashes", "mix64"]


def small_batches(spark: SparkSession, rows: int = 1000):
    """Fewer rows per Arrow batch while eager steps with wide rows run; the session's own setting comes back."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table; others, whatever their names, are left behind."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words; those seen lately are remembered, `room` at most."""

    def __init__(self, room: int = 1 << 18):
        self.room, self.known = room, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        fresh = set(words).difference(known)
        if len(known) + len(fresh) > self.room:
            known.clear()
            fresh = set(words)
        known.update(zip(fresh, map(xxhash.xxh64_intdigest, fresh)))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every end of an edge (a, b): component is the smallest node reachable.

    Each round moves every node to the smallest label next to it and then to that
    label's own label, so long chains halve.  Each round is written out.
    """
    both = durable(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    for _ in range(rounds):
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        step = durable(step.join(jump, "component", "left").select("node", F.least("component", F.coalesce("far", "component")).alias("component"), "was"))
        labels = step.drop("was")
        if step.filter("component <> was").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
