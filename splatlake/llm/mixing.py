"""Mixing sources to target weights by iterative proportional fitting.

Token weights are raked cell by cell (source x language x topic) until the weighted token
totals match the target share of every source, language and topic; documents are
then kept with probabilities in proportion to their cell's weight, so that a
wanted number of tokens is kept in expectation.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from .common import durable

DIMENSIONS = ("source", "lang", "topic")
TOLERANCE = 1e-6  # relative error of a margin's share that counts as met
LOCAL_CELLS = 1 << 17  # cells that the driver fits by itself
TEMPERATURE = 0.7  # default targets: observed token shares to this power, so that rare kinds gain
KEEP = 0.8  # share of tokens to keep in expectation
NONE = "\x00null"  # a null category is one of its own
SPACE = 1 << 32


def topic_of(text: Column) -> Column:
    """Form of a text, for tables without a topic of their own: table, list, shouting, short, long or prose."""
    text = F.coalesce(text, F.lit(""))
    size = F.length(text)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)) * 20 > size / 5
    return (F.when(count(r"\|"), "table").when(count(r"[#$%&*]{3}"), "decorated").when(count("!!"), "shouting")
            .when(size < 500, "short").when(size > 8000, "long").otherwise("prose"))


def tokens_of(text: Column) -> Column:
    """Runs of anything but white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from a key's text and the seed, alike on every engine and run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / SPACE


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, passes: int | None = None, tolerance: float = TOLERANCE, temperature: float = TEMPERATURE, local: int = LOCAL_CELLS) -> DataFrame:
    """cells(source, lang, topic, tokens) with `weight`, the factor on each cell's tokens, and `misfit`.

    targets holds, per dimension, a table (category, share); shares are scaled to sum to 1
    over the categories present.  A dimension without one aims at its observed token
    shares to the power of `temperature`.  Cells without tokens, and categories the targets
    leave out or set to 0, get weight 0.  Rounds go on until every margin is within `tolerance` of its
    target share (relative), whatever their number; only a caller's own `passes` ends them sooner.  Margins that
    no weights can meet together end once twice the rounds no longer lower the error.  misfit, alike in every row, is the largest relative
    error left; above `tolerance` it is warned of.  Up to `local` cells are fitted on the driver, more in Spark.
    """
    targets = targets or {}
    cells = cells.withColumn("weight", F.when(F.col("tokens") > 0, 1.0).otherwise(0.0))
    for d in DIMENSIONS:
        own = cells.groupBy(d).agg(F.sum("tokens").alias("_t")).filter("_t > 0")
        if d in targets:
            own = own.join(targets[d].select(F.col("category").alias(d), F.greatest(F.col("share").cast("double"), F.lit(0.0)).alias("_s")), d)
        else:
            own = own.withColumn("_s", F.pow("_t", F.lit(float(temperature))))
        own = own.withColumn(f"_goal_{d}", F.col("_s") / F.sum("_s").over(W.partitionBy(F.lit(0)))).select(d, f"_goal_{d}")
        cells = cells.join(own, d, "left").fillna(0.0, [f"_goal_{d}"])
    cells = durable(cells)
    n, total = cells.agg(F.count("*"), F.sum("tokens")).first()
    errors: list[float] = []
    if total:
        cells = (_fit_here if n <= local else _fit_spread)(cells, float(total), passes, tolerance, errors)
    misfit = errors[-1] if errors else 0.0
    if misfit > tolerance:
        warnings.warn(f"margins do not meet their targets: largest relative error {misfit:.3g} after {len(errors)} rounds")
    return cells.select(*DIMENSIONS, "tokens", "weight", F.lit(float(misfit)).alias("misfit"))


def _over(errors: list[float], passes: int | None, tolerance: float, least: int) -> bool:
    """Whether the rounds end: margins met, the caller's limit reached, or the error the same as after half the rounds (looked at when `least` rounds have doubled)."""
    n = len(errors)
    if n and (errors[-1] <= tolerance or n == passes):
        return True
    return n >= 2 * least and n & (n - 1) == 0 and errors[-1] > 0.99 * errors[n // 2 - 1]


def _fit_here(cells: DataFrame, total: float, passes: int | None, tolerance: float, errors: list[float]) -> DataFrame:
    """Rounds in numpy; one number per cell and dimension."""
    table = cells.toArrow()
    tokens, weight = (np.array(table[c].to_pylist(), np.float64) for c in ("tokens", "weight"))
    kinds = []
    for d in DIMENSIONS:
        at = table[d].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        goal = np.zeros(at.max() + 1)
        goal[at] = table[f"_goal_{d}"].to_numpy()
        kinds.append((at, goal))
    share = lambda at, goal: np.bincount(at, tokens * weight, len(goal)) / total
    while not _over(errors, passes, tolerance, 512):
        for at, goal in kinds:
            own = share(at, goal)
            weight *= np.divide(goal, own, out=np.zeros_like(own), where=own > 0)[at]
        errors.append(max(float(np.abs(share(at, goal)[goal > 0] / goal[goal > 0] - 1).max(initial=0)) for at, goal in kinds))
    fitted = table.select([*DIMENSIONS, "tokens"]).append_column("weight", pa.array(weight))
    return cells.sparkSession.createDataFrame(fitted)


def _fit_spread(cells: DataFrame, total: float, passes: int | None, tolerance: float, errors: list[float]) -> DataFrame:
    """Rounds in Spark, each written out."""
    mass = F.col("tokens") * F.col("weight")
    while not _over(errors, passes, tolerance, 64):
        for d in DIMENSIONS:
            cells = cells.withColumn("_share", F.sum(mass).over(W.partitionBy(d)) / F.lit(total))
            cells = cells.withColumn("weight", F.when(F.col("_share") > 0, F.col("weight") * F.col(f"_goal_{d}") / F.col("_share")).otherwise(0.0))
        cells = durable(cells.drop("_share"))
        off = lambda d: cells.groupBy(d).agg(F.abs(F.try_divide(F.sum(mass) / F.lit(total), F.first(f"_goal_{d}")) - 1).alias("off"), F.first(f"_goal_{d}").alias("goal")).filter("goal > 0").select("off")
        first, second, third = map(off, DIMENSIONS)
        errors.append(first.union(second).union(third).agg(F.coalesce(F.max("off"), F.lit(0.0))).first()[0])
    return cells


def scale(cells: DataFrame, keep: float) -> DataFrame:
    """cells with `probability` = min(1, c * weight), c such that `keep` of all tokens are expected.

    c is exact: cells are taken from the largest weight down, and those that reach 1 stop
    growing.  Where less than that share has a weight above 0, all of it is kept.
    """
    order = W.partitionBy(F.lit(0)).orderBy(F.desc("weight"), *DIMENSIONS)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    run = cells.withColumn("_full", F.coalesce(F.sum("tokens").over(before), F.lit(0))).withColumn("_mass", F.col("tokens") * F.col("weight"))
    run = run.withColumn("_rest", F.sum("_mass").over(order.rowsBetween(0, W.unboundedFollowing))).withColumn("_goal", F.sum("tokens").over(W.partitionBy(F.lit(0))) * F.lit(float(keep)))
    run = run.withColumn("_c", F.when((F.col("_rest") > 0) & (F.col("weight") > 0), (F.col("_goal") - F.col("_full")) / F.col("_rest")))
    fits = run.withColumn("_c", F.when((F.col("_c") >= 0) & (F.col("_c") * F.col("weight") <= 1), F.col("_c")))
    fits = fits.withColumn("_c", F.max("_c").over(W.partitionBy(F.lit(0))))
    p = F.when(F.col("weight") <= 0, 0.0).when(F.col("_c").isNull(), 1.0).otherwise(F.least(F.lit(1.0), F.col("_c") * F.col("weight")))
    return fits.withColumn("probability", p).select(*DIMENSIONS, "tokens", "weight", "probability")


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, seed: str = "mix", topic: Column | None = None, **fit) -> DataFrame:
    """docs(doc_id, text, source, lang) with topic, tokens, weight, probability and sampled.

    One row per document in any case; columns of these five names are replaced.  Null sources,
    languages and topics are categories of their own.  A document without words has
    no tokens and takes its cell's probability; a cell of such documents only gets 0.
    Rows of equal doc_id are sampled together where their cells agree.
    """
    out = ("topic", "tokens", "weight", "probability", "sampled")
    docs = docs.withColumn("_topic", topic if topic is not None else topic_of(F.col("text"))).withColumn("_tokens", tokens_of(F.col("text"))).drop(*out)
    docs = docs.withColumnsRenamed({"_topic": "topic", "_tokens": "tokens"})
    key = {d: F.coalesce(F.col(d).cast("string"), F.lit(NONE)) for d in DIMENSIONS}
    cells = durable(docs.groupBy(*[key[d].alias(d) for d in DIMENSIONS]).agg(F.sum("tokens").alias("tokens")))
    cells = durable(scale(rake(cells, targets, **fit), keep))
    odds = cells.select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], "weight", "probability")
    docs = docs.withColumns({f"_{d}": key[d] for d in DIMENSIONS})
    joined = docs.join(odds, [f"_{d}" for d in DIMENSIONS]).drop(*[f"_{d}" for d in DIMENSIONS])
    return joined.withColumn("sampled", uniform(F.col("doc_id"), seed) < F.col("probability"))
