"""Quality classification by supervised subword embeddings.

A document is the multiset of its words' features: the hashed word, the hashed character n-grams of `<word>`, a feature wherever a
word repeats the one before it, and one end of text. Each hashed feature has a learned vector; their mean goes through a softmax. Vectors and
softmax are trained together by stochastic gradient descent in numpy, on a bounded sample of labelled documents, whole texts.

Since the output is linear in the mean, a fitted model is one number per feature bucket: what the feature adds to the log-odds. Scoring sums
these numbers over a text of any length, remembering the sums of words seen lately.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordHashes, mix64

BUCKETS = 1 << 16  # hashed features
SIZE = 16  # numbers of a feature's vector
GRAMS = (1, 2, 3, 4)  # characters of an n-gram
SAMPLE = 2000  # labelled documents of each class that are trained on
EPOCHS = 6
RATE = 2.0
CUT = 0.7
_ROOM = 1 << 17  # words whose sums a scoring task remembers
_REPEAT, _END = 0, 1  # buckets of a repeated word and of the end of a text


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, case kept; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(hashes) % np.uint64(buckets - 2)).astype(np.int64) + 2


def word_features(words: list[bytes], buckets: int = BUCKETS, grams=GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, bucket) of every feature of the given words: itself and the character n-grams of `<word>`."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(b"".join(b"<" + w + b">" for w in words).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w.decode("utf-8", "surrogatepass")) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    owners = [np.arange(len(words))]
    found = [_buckets(WordHashes()(words), buckets)]
    rolled = np.zeros(len(points), np.uint64)
    for n in range(1, max(grams) + 1):
        if n > len(points):
            break
        rolled = rolled[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(1)
        if n in grams:
            inside = owner[: len(rolled)] == owner[n - 1 :]
            owners.append(owner[: len(rolled)][inside])
            found.append(_buckets(rolled[inside] + np.uint64(n << 56), buckets))
    return np.concatenate(owners), np.concatenate(found)


def document_features(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, shares) of one document; the shares add up to 1."""
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    times = np.bincount(at, minlength=len(known)).astype(np.float64)
    owner, found = word_features(list(known), buckets)
    counts = np.bincount(found, times[owner], minlength=buckets)
    counts[_REPEAT] += np.count_nonzero(at[1:] == at[:-1])
    counts[_END] += 1
    held = np.flatnonzero(counts)
    return held, counts[held] / counts.sum()


@dataclass
class Model:
    odds: np.ndarray  # what each feature adds to the log-odds of class 1, times its share
    prior: float | None = None  # the score of every text where the labels hold fewer than two classes


def train(sample: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, size: int = SIZE, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Fit vectors and softmax to (buckets, shares, class 0 or 1); the step falls linearly to zero, one document a step."""
    ones = sum(y for _, _, y in sample)
    if not 0 < ones < len(sample):
        return Model(np.zeros(buckets), (ones + 1) / (len(sample) + 2))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (buckets, size)).astype(np.float32)
    out = np.zeros((2, size), np.float32)
    steps, done = epochs * len(sample), 0
    for _ in range(epochs):
        for k in rng.permutation(len(sample)):
            held, shares, y = sample[k]
            shares = shares.astype(np.float32)
            mean = shares @ vectors[held]
            logits = out @ mean
            logits -= logits.max()
            p = np.exp(logits)
            p /= p.sum()
            p[y] -= 1  # gradient of the loss by the logits
            step = np.float32(rate * (1 - done / steps))
            pull = out.T @ p
            out -= step * np.outer(p, mean)
            vectors[held] -= step * shares[:, None] * pull[None, :]
            done += 1
    return Model(vectors.astype(np.float64) @ (out[1] - out[0]).astype(np.float64))


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE, buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features and class of at most `rows` documents of each class, picked by the hash of their ids whatever their length.

    Labels other than 0 and 1, ids that carry both, and null ids teach nothing; of documents that share an id the one of the least text is taken.
    Texts are read whole, in the tasks; what comes back is at most 2 * rows documents of at most `buckets` numbers each.
    """
    marks = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("_y"), F.max(label).alias("_top"))
    known = docs.select("doc_id").join(marks.filter("_y = _top").select("doc_id", "_y"), "doc_id").distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [r for y in (0, 1) for r in known.filter(F.col("_y") == y).orderBy(*order).limit(rows).collect()]
    if not picked:
        return []
    spark = docs.sparkSession
    picked = spark.createDataFrame(picked, known.schema)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("_y").alias("_y"))

    def run(batches):
        for b in batches:
            for text, y in zip(b.column(0), b.column(1).to_pylist()):
                held, shares = document_features(words_of(text.as_py()), buckets)
                yield pa.RecordBatch.from_arrays([pa.array([held.astype(np.int32)], pa.list_(pa.int32())), pa.array([shares.astype(np.float32)], pa.list_(pa.float32())), pa.array([y], pa.int32()), pa.array([hash_of(held, shares)], pa.int64())], ["held", "shares", "y", "key"])

    def hash_of(held, shares) -> int:
        return int((mix64(held.astype(np.uint64)) ^ mix64((shares * (1 << 40)).astype(np.uint64))).sum(dtype=np.uint64) >> np.uint64(1))

    rows = texts.select("text", F.col("_y").cast("int").alias("_y")).mapInArrow(run, "held array<int>, shares array<float>, y int, key long").toArrow()
    found = [(rows["held"][i].values.to_numpy(), rows["shares"][i].values.to_numpy(), rows["y"][i].as_py()) for i in np.argsort(rows["key"].to_numpy(), kind="stable")]
    return found  # ordered by content, so a fit does not depend on the order of arrival


def classify(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """(doc_id, score, predicted) of every row of docs(doc_id, text): the probability of class 1, and whether it is at least `cut`.

    Null and empty texts have the end of text as their only feature. Rows that repeat are scored each; other columns are left behind. An empty table gives an
    empty one. A model of fewer than two classes gives every text the smoothed share of class 1.
    """
    odds, prior = model.odds, model.prior

    def run(batches):
        known: dict = {}  # word -> its number
        sums, sizes = np.zeros(0), np.zeros(0)
        for b in batches:
            scores = []
            for text in b.column(1):
                words = words_of(text.as_py())
                fresh = [w for w in dict.fromkeys(words) if w not in known]
                if len(known) + len(fresh) > _ROOM and known:
                    known, sums, sizes = {}, np.zeros(0), np.zeros(0)
                    fresh = list(dict.fromkeys(words))
                if fresh:
                    owner, found = word_features(fresh, len(odds))
                    if len(known) + len(fresh) > len(sums):  # grow by doubling
                        room = max(4096, 2 * (len(known) + len(fresh)))
                        sums, sizes = np.resize(sums, room), np.resize(sizes, room)
                    at = slice(len(known), len(known) + len(fresh))
                    sums[at] = np.bincount(owner, odds[found], minlength=len(fresh))
                    sizes[at] = np.bincount(owner, minlength=len(fresh))
                    known.update(zip(fresh, range(at.start, at.stop)))
                ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                again = np.count_nonzero(ids[1:] == ids[:-1])
                z = (sums[ids].sum() + again * odds[_REPEAT] + odds[_END]) / (sizes[ids].sum() + again + 1)
                scores.append(prior if prior is not None else float(1 / (1 + np.exp(-np.clip(z, -700, 700)))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))
