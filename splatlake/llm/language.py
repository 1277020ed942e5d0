"""Language identification by string kernels.

A text's kernel features are which character n-grams it holds (presence, n = 1 to 3, over letters of any script; a run of
other characters is one boundary).  The blended-spectrum kernel of two texts is
the mean over n of the cosines of their presence vectors.  Landmark texts, dealt over all languages, give
Nystrom coordinates; one-versus-rest ridge regression on these gives one score per language.  Both are
fitted on a bounded sample of labelled texts of any length, whose n-grams tasks find in whole texts; prediction reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W
from pyspark.sql.types import DoubleType, StringType, StructType

LANDMARKS = 96  # texts that span the Nystrom coordinates; two of each language, where these are more
SAMPLE = 1600  # labelled texts for the regression, landmarks included; one of each language, where these are more
RIDGE = 1e-3
UNKNOWN = "und"
ORDERS = 3
_POINT_BITS = 21  # a code point; three of them fit a long
_CELLS = 1 << 22  # numbers of one batch's presence matrix


@dataclass
class Model:
    grams: list[np.ndarray]  # for each n the codes of the n-grams that landmarks hold, sorted; their rows follow each other
    landmarks: np.ndarray  # rows x landmarks: presence / norm, per n
    solve: np.ndarray  # landmarks x languages
    bias: np.ndarray
    languages: list[str]


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)


def presence(text: str | None) -> list[np.ndarray]:
    """Codes of the n-grams that a text holds, for n = 1, 2, 3, each sorted; a text without a letter holds none."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(_letters()[points], points, 0)
    if not points.any():
        return [np.zeros(0, np.int64)] * ORDERS
    points = points[(points > 0) | (np.concatenate([[1], points[:-1]]) > 0)]
    points = np.pad(points, (int(points[0] > 0), int(points[-1] > 0)))  # a boundary at both ends
    codes, found = points, []
    for n in range(1, ORDERS + 1):
        found.append(np.unique(codes))
        if n < ORDERS:
            codes = (codes[:-1] << _POINT_BITS) + points[n:]
    return found


def _vectors(held: list[list[np.ndarray]], grams: list[np.ndarray]) -> np.ndarray:
    """Presence over norm of each text in the rows of the dictionary, a third for each n; the norm counts all n-grams of the text."""
    out = np.zeros((len(held), sum(map(len, grams))), np.float32)
    for i, codes in enumerate(held):
        start = 0
        for own, known in zip(codes, grams):
            at = np.searchsorted(known, own)
            at[at == len(known)] = 0
            at = at[known[at] == own] if len(known) else at[:0]
            out[i, start + at] = 1 / np.sqrt(max(1, len(own)))
            start += len(known)
    return out


def kernel(model: Model, held: list[list[np.ndarray]]) -> np.ndarray:
    """Blended-spectrum kernel of texts, given as their n-grams, with the landmarks; one matrix product a batch."""
    out, width = np.zeros((len(held), model.landmarks.shape[1])), max(1, model.landmarks.shape[0])
    step = max(1, min(64, _CELLS // width))
    for lo in range(0, len(held), step):
        out[lo : lo + step] = _vectors(held[lo : lo + step], model.grams) @ model.landmarks
    return out


def fit(held: list, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on labelled texts, or on their n-grams as `sample` finds them; landmarks are dealt over the languages."""
    held = [presence(x) if isinstance(x, str) else x for x in held]
    languages = sorted(set(langs))
    if not languages:
        return Model([np.zeros(0, np.int64)] * ORDERS, np.zeros((0, 0), np.float32), np.zeros((0, 0)), np.zeros(0), [])
    by = {g: [i for i, x in enumerate(langs) if x == g] for g in languages}
    dealt = [i for k in range(max(map(len, by.values()))) for g in languages for i in by[g][k : k + 1]]
    chosen = dealt[: max(landmarks, 2 * len(languages))]
    grams = [np.unique(np.concatenate([held[i][n] for i in chosen])) for n in range(ORDERS)]
    model = Model(grams, _vectors([held[i] for i in chosen], grams).T / ORDERS, np.zeros(0), np.zeros(0), languages)
    k = kernel(model, [held[i] for i in chosen])
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    z = kernel(model, held) @ half
    y = np.array([[1.0 if x == g else -1.0 for g in languages] for x in langs])
    weight = np.array([1.0 / len(by[x]) for x in langs])[:, None]  # rare languages count as much
    weight *= len(langs) / weight.sum()
    mean, bias = (z * weight).mean(0), (y * weight).mean(0)
    zc = z - mean
    solved = np.linalg.solve(zc.T @ (zc * weight) + ridge * len(langs) * np.eye(z.shape[1]), (zc * weight).T @ (y - bias))
    model.solve, model.bias = half @ solved, bias - mean @ solved
    return model


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score in 0 to 1 (margin of the best score, squashed); `und`, 0 for null and letterless texts."""
    held = [presence(t) for t in texts] if model.languages else []
    known = [i for i, codes in enumerate(held) if len(codes[0])]
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if known:
        y = kernel(model, [held[i] for i in known]) @ model.solve + model.bias
        best = y.argmax(1)
        for i, b, s in zip(known, best, 1 / (1 + np.exp(-3 * y[np.arange(len(best)), best]))):
            names[i], scores[i] = model.languages[b], float(s)
    return names, scores


def sample(labelled: DataFrame, size: int = SAMPLE) -> tuple[list, list[str]]:
    """N-grams and languages of at most `size` rows of labelled(doc_id, text, lang), the same share of each language (one row at least), by hash of the id.

    Rows are picked whatever the length of their texts, and tasks find the n-grams of the whole texts; only these come back.
    Languages are counted in one pass over all rows; a second one picks, so the passes do not grow with the number of languages.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", F.xxhash64("doc_id").alias("h"), "text")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row a language
    if not counts:
        return [], []
    each = max(1, size // len(counts))
    # Of a frequent language only rows of small hashes are ranked, eight times as many as wanted.
    odds = labelled.sparkSession.createDataFrame([(c["lang"], min(1.0, 8 * each / c["n"])) for c in counts], "lang string, odds double")
    few = rows.join(F.broadcast(odds), "lang").filter(F.col("h") / 2.0**64 + 0.5 <= F.col("odds"))
    first = W.partitionBy("lang").orderBy("h", "text")
    picked = few.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= each).select("lang", "at", "text")

    def run(batches):
        for b in batches:
            for lang, at, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                codes = [pa.array([c], pa.list_(pa.int64())) for c in presence(text.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([at], pa.int32()), *codes], ["lang", "at", *columns])

    columns = [f"g{n}" for n in range(1, ORDERS + 1)]
    found = picked.mapInArrow(run, "lang string, at int, " + ", ".join(f"{c} array<long>" for c in columns)).toArrow()
    found = found.sort_by([("lang", "ascending"), ("at", "ascending")]).combine_chunks()
    return [[found[c][i].values.to_numpy() for c in columns] for i in range(len(found))], found["lang"].to_pylist()


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score; text is read whole, other columns are kept but never looked at.

    Columns of these two names are replaced.  A null text, one without a letter, or a model without
    languages gives `und` and 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by landmarks and alphabet
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for b in batches:
            for lo in range(0, max(1, b.num_rows), 512):
                part = b.slice(lo, 512)
                names, scores = predict(m, part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*part.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(run, schema)
