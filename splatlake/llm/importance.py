"""Importance resampling towards a target corpus: bucket gains held in an array, ranks by a distributed radix sort.

A document's weight is the sum, over its word runs, of the gain of the run's bucket: how much likelier the target texts are to
hold that bucket than all documents. Adding Gumbel noise to the weights and taking the highest draws without replacement
in proportion to exp(weight).

Ranks come from a least-significant-digit radix sort of a composite key. Rows stand at positions 0..N-1, cut into blocks. A pass
counts each block's rows by digit, adds up the counts before (digits before, then earlier blocks of the same digit), and so gives
every row its destination; rows of one digit keep their order. Nothing but the counts is ever summed in one place: the digit
totals, `2 ** DIGIT_BITS` numbers at most.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from .common import durable

BUCKETS = 10_000
LEAST_WORDS = 20  # shorter documents are never drawn
PERCENT = 10
SEED = 2024
DIGIT_BITS = 11
BLOCK_ROWS = 1 << 17
_ROOM = 1 << 18  # words remembered with their buckets
# Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: digits, letters and all that is not ASCII; the rest becomes a space.
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_LOWEST = -(1 << 63)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Features:
    """Buckets of all runs of 1 to `longest` words; buckets of words seen lately are remembered."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.known = longest, buckets, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        fresh = set(words).difference(known)
        if len(known) + len(fresh) > _ROOM:
            known.clear()
            fresh = set(words)
        for w in fresh:
            known[w] = zlib.crc32(w) % self.buckets
        parts = [np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
        for n in range(2, self.longest + 1):
            runs = zip(*[words[i:] for i in range(n)])
            parts.append(np.fromiter((zlib.crc32(b" ".join(r)) % self.buckets for r in runs), np.int64, max(0, len(words) - n + 1)))
        return np.concatenate(parts)


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many word runs of all texts (column text) fall into each bucket."""

    def run(batches):
        counts, features = np.zeros(buckets, np.int64), Features(longest, buckets)
        for b in batches:
            for text in b.column(0):
                counts += np.bincount(features(words_of(text.as_py())), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.collect():  # at most one row per bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed target share of each bucket over its source share."""
    wide, narrow = int(source.sum()) + len(source), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((t + 1) * wide / ((s + 1) * narrow))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of docs(doc_id, text)."""
    buckets = len(gain)

    def run(batches):
        features = Features(longest, buckets)
        for b in batches:
            sizes, counts, sums = [], [], []
            for text in b.column(1):
                words = words_of(text.as_py())
                at = features(words)
                sizes.append(len(words))
                counts.append(len(at))
                sums.append(int(gain[at].sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def with_noise(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """Add score: the weight plus Gumbel noise from the hash of seed and doc_id (a null id counts as empty)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weights.withColumn("score", F.col("weight") + noise)


def radix_rank(rows: DataFrame, keys, digit_bits: int = DIGIT_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add rank: the place from 1 of each row in the order of `keys`, pairs of a long column and whether it descends.

    Nulls come first where a key ascends, last where it descends. Rows equal in all keys get consecutive ranks in any order. Each pass is written out, so a lost
    executor repeats one pass at most. Keys are taken relative to their extremes, so only digits that differ cost a pass.
    """
    keys = [(c, down) for c, down in keys]
    bounds = rows.agg(F.count("*"), *[f(F.col(c)) for c, _ in keys for f in (F.min, F.max)], *[F.count(F.col(c)) for c, _ in keys]).first()
    n = bounds[0]
    plan = []  # (column of non-negative bits, number of bits), the least significant first
    for k, (c, down) in reversed(list(enumerate(keys))):
        low, high, known = bounds[1 + 2 * k], bounds[2 + 2 * k], bounds[1 + 2 * len(keys) + k]
        if known:
            value = F.coalesce(F.col(c).cast("long"), F.lit(low).cast("long"))
            bits = (high - low).bit_length()
            if bits < 64 and high - low < 1 << 63:
                value = F.lit(high) - value if down else value - F.lit(low)
            else:  # the range does not fit a long: flipping the sign bit orders all longs as bit patterns
                bits, value = 64, value.bitwiseXOR(F.lit(-1 if down else 0).cast("long")).bitwiseXOR(F.lit(_LOWEST))
            plan.append((value, bits))
        if 0 < known < n:
            plan.append((F.when(F.col(c).isNull(), int(down)).otherwise(int(not down)).cast("long"), 1))
    names = rows.columns
    now = durable(rows.withColumn("_block", F.spark_partition_id().cast("long")).withColumn("_at", F.monotonically_increasing_id()))
    ends = np.cumsum([bits for _, bits in plan], dtype=int).tolist()
    for low in range(0, max([1, *ends]), digit_bits):  # without any digit one pass still numbers the rows
        digit = F.lit(0).cast("long")
        for (value, bits), end in zip(plan, ends):  # a digit may span several keys
            start, stop = max(low, end - bits), min(low + digit_bits, end)
            if start < stop:
                part = F.shiftrightunsigned(value, start - end + bits).bitwiseAND(F.lit((1 << (stop - start)) - 1))
                digit = digit + F.shiftleft(part, start - low)
        dealt = now.withColumn("_digit", digit.cast("int"))
        counts = durable(dealt.groupBy("_digit", "_block").agg(F.count("*").alias("_n")))
        totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_all"))
        base = F.sum("_all").over(W.orderBy("_digit")) - F.col("_all")  # over the digits, whose number is fixed
        before = F.sum("_n").over(W.partitionBy("_digit").orderBy("_block")) - F.col("_n")
        starts = counts.withColumn("_before", before).join(F.broadcast(totals.select("_digit", base.alias("_base"))), "_digit")
        starts = starts.select("_digit", "_block", (F.col("_base") + F.col("_before")).alias("_start"))
        place = F.row_number().over(W.partitionBy("_digit", "_block").orderBy("_at")) - 1
        moved = dealt.withColumn("_place", place).join(starts, ["_digit", "_block"]).withColumn("_to", F.col("_start") + F.col("_place"))
        now = durable(moved.select(*[F.col(f"`{c}`") for c in names], F.floor(F.col("_to") / block_rows).cast("long").alias("_block"), F.col("_to").alias("_at")))
    return now.select(*[F.col(f"`{c}`") for c in names], (F.col("_at") + 1).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and rank: the draw of floor(percent * N / 100) rows that resemble the target texts most.

    N counts the rows of docs(doc_id, text) with at least `least_words` words; of these the highest scores are drawn, ties to the
    smaller doc_id (null first), then to fewer features; rank is null for the rest. Null and empty texts have no features and
    weight 0. Repeated rows count and rank each. Empty tables of documents or targets are allowed. Other columns are left behind.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    scored = durable(with_noise(weigh(docs, gain, longest), seed))
    able = F.col("n_words") >= least_words
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = radix_rank(scored.filter(able).select(*out), [("score", True), ("doc_id", False), ("n_features", False)])
    drawn = percent * scored.filter(able).count() // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.filter(~able).select(*out, F.lit(None).cast("long").alias("rank")))
