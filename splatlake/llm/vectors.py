"""Shared preparation of vector tables: usable vectors, distinct ones with their smallest ids, task sizes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

BLOCK_ROWS = 16_384  # distinct vectors that one search task holds


def usable(vectors: DataFrame, convert) -> DataFrame:
    """(vec_id, v) of vectors(vec_id, embedding): v holds convert(components) as bytes, or the row is left out.

    Left out are null vectors and ids, and vectors that hold null or non-finite components.  Of rows
    that share a vec_id the one of the smallest v counts.
    """

    def run(batches):
        for b in batches:
            ids, rows = [], []
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or x is None or None in x:
                    continue
                x = np.array(x, np.float64)
                if np.isfinite(x).all() and (y := convert(x)) is not None:
                    ids.append(i)
                    rows.append(y.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], ["vec_id", "v"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, v binary")
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each distinct vector with its k + 1 smallest ids; ties go to small ids, so no other copy can be among k nearest."""
    first = rows.withColumn("_at", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).filter(F.col("_at") <= k + 1)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def best(scores: np.ndarray, ids: list, own: int, k: int) -> list[tuple[float, int]]:
    """The k best (score, id), ties to small ids, of distinct vectors with their lists of ids."""
    if not len(scores):
        return []
    if len(scores) > k + 1:
        cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    found = sorted((-scores[i], v) for i in at.tolist() for v in ids[i] if v != own)
    return [(-s, v) for s, v in found[:k]]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of what tasks found."""
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    at = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return one.withColumn("rank", at).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
