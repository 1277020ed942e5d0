"""Exact order statistics per group: percentiles, k-th values and row ranks.

Groups of ordinary size come together by the shuffle's own spillable sort; a task selects the few values wanted from one
group's plain arrays at a time, and no list of boxed values is ever built.  Groups that the size check finds too large for one task (only those) get the same
numbers from jobs whose per-task state is bounded whatever the group size:

* values at given ranks: a mergeable quantile sketch brackets every rank; one more pass counts the values below, at and above the bracket
  and each value strictly inside (a fixed small share, however the values are spread), which are then sorted or, where still many, sketched again;
* ranks of all rows: range-partition by (group, order), number the rows inside each
  partition, and add the sizes of the partitions before it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .scalars import col
from .scaling import ONE_TASK_ROWS, Groups, attach, durable, groups_of, hot_groups, _setting

SKETCH = 4096  # size of a quantile sketch; its rank error is about 0.13 % of the rows
MARGIN = 0.004  # a bracket reaches this share of the rows to both sides of a rank,
GRID = 500  # and from there to the next of so many quantiles


def _bound(size_of: DataFrame | None, df: DataFrame, keys) -> DataFrame:
    """The frame to measure: `size_of` when it knows all the keys."""
    return size_of if size_of is not None and set(keys) <= set(size_of.columns) else df


def _orderable(c) -> Column:
    c = col(c).cast("double")
    return F.when(~F.isnan(c), c)


def _inside(values: DataFrame, spans: DataFrame, keys) -> DataFrame:
    """Every value next to each open span (above `lo` where has_lo, below `hi` where has_hi) of its group that holds it."""
    held = "(NOT has_lo OR v > lo) AND (NOT has_hi OR v < hi)"
    return attach(values.select(*keys, "v"), spans, keys, "inner").filter(held)


def _summaries(df: DataFrame, keys, pools, aggs=()) -> DataFrame:
    """One row per group: for every pool of columns `_s<i>` with n, least, most and a sketch of its values, and the aggregates.

    The columns are computed once a row, before the several aggregates that use them.
    """
    named = [[f"_v{i}_{j}" for j in range(len(columns))] for i, columns in enumerate(pools)]
    rows = df.withColumns({n: c for names, columns in zip(named, pools) for n, c in zip(names, columns)})

    def over(columns):
        merged = reduce(F.kll_sketch_merge_double, [F.kll_sketch_agg_double(c, F.lit(SKETCH)) for c in columns])
        least, most = [F.min(c) for c in columns], [F.max(c) for c in columns]
        ends = [F.least(*least), F.greatest(*most)] if len(columns) > 1 else [least[0], most[0]]
        return F.struct(reduce(lambda a, b: a + b, [F.count(c) for c in columns]).alias("n"), ends[0].alias("least"), ends[1].alias("most"), merged.alias("sketch"))

    return durable(rows.groupBy(*keys).agg(*[over(names).alias(f"_s{i}") for i, names in enumerate(named)], *aggs))


def values_at_ranks(values: DataFrame, keys, targets: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """Value at 0-based rank `r` of column `v` for every (keys, r) row of `targets`.

    Two passes find a rank: one sketches its span, one counts around each rank's bracket and keeps the about one hundredth of the values inside
    (each once, with its count), of which at most oneTaskRows are sorted; more are a span of their own.
    A rank that a bracket missed, which a sketch allows, goes on with what lies beside it.  Ranks with one bracket (those next to
    each other) are counted together, the first and last rank of a span need none, and a span known to be short is sorted at once.
    `first` (keys, n, least, most, sketch) saves the first pass where the caller has summed up the groups.
    """
    keys = list(keys)
    limit = _setting(values, "oneTaskRows", ONE_TASK_ROWS)
    span = [*keys, "has_lo", "lo", "has_hi", "hi"]
    values = values.filter(F.col("v").isNotNull())
    number = lambda x: F.lit(float(x))
    state = durable(targets.select(*keys, "r").distinct().withColumns({"has_lo": F.lit(False), "lo": number(0), "has_hi": F.lit(False), "hi": number(0),
                                                                      "below": F.lit(0).cast("bigint"), "n": F.lit(-1).cast("bigint")}))
    short = f"n BETWEEN 0 AND {limit}"
    found = []
    while not state.isEmpty():
        unknown = state.filter(f"NOT {short}").drop("n")
        if first is not None:
            spans, first = first.withColumns({"has_lo": F.lit(False), "lo": number(0), "has_hi": F.lit(False), "hi": number(0)}), None
        else:
            spans = durable(_inside(values, unknown.select(*span).distinct(), keys).groupBy(*span)
                            .agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.kll_sketch_agg_double("v", F.lit(SKETCH)).alias("sketch")))
        known = unknown.join(spans, span).withColumn("end", F.when(F.expr("r = below"), F.col("least")).when(F.expr("r = below + n - 1"), F.col("most")))
        found.append(known.filter("end IS NOT NULL").select(*keys, "r", F.col("end").alias("value")))
        known = known.filter("end IS NULL")
        few = durable(known.filter(short).select(*span, "r", "below").unionByName(state.filter(short).select(*span, "r", "below")))
        at = F.row_number().over(Window.partitionBy(*span).orderBy("v")) - 1
        placed = _inside(values, few.select(*span).distinct(), keys).withColumn("at", at)
        found.append(durable(placed.join(few.withColumn("at", F.col("r") - F.col("below")).drop("below"), [*span, "at"]).select(*keys, "r", F.col("v").alias("value"))))
        share = (F.col("r") - F.col("below")) / F.greatest(F.lit(1), F.col("n") - 1) * GRID
        cuts = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
        cut = lambda at: F.get(cuts, F.greatest(F.lit(0), F.least(F.lit(GRID), at)).cast("int"))
        ends = [F.round(share) + d * (MARGIN * GRID + 1) for d in (-1, 1)]  # the ranks beside a percentile round alike
        brackets = durable(known.filter(F.col("n") > limit).select(*span, "r", "below", cut(ends[0]).alias("first"), cut(ends[1]).alias("last")))
        if brackets.isEmpty():
            break
        beside = _inside(values, brackets.select(*span, "first", "last").distinct(), keys)
        bracket = [*span, "first", "last"]
        zone = F.expr("CASE WHEN v < first THEN 0 WHEN v = first THEN 1 WHEN v < last THEN 2 WHEN v = last THEN 3 ELSE 4 END")
        zones = durable(beside.groupBy(*bracket, zone.alias("_zone"), F.when(zone == 2, F.col("v")).alias("_v")).agg(F.count("*").alias("_n")))
        sizes = zones.groupBy(*bracket).agg(*[F.coalesce(F.sum(F.when(F.col("_zone") == i, F.col("_n"))), F.lit(0)).alias(c) for i, c in enumerate(("c0", "c1", "c2", "c3", "rest"))])
        counts = durable(brackets.join(sizes, bracket).withColumn("seek", F.col("r") - F.col("below")))
        hit = F.when(F.expr("seek >= c0 AND seek < c0 + c1"), F.col("first")).when(F.expr("seek >= c0 + c1 + c2 AND seek < c0 + c1 + c2 + c3"), F.col("last"))
        found.append(counts.withColumn("value", hit).filter("value IS NOT NULL").select(*keys, "r", "value"))
        middle = F.expr("seek >= c0 + c1 AND seek < c0 + c1 + c2")
        near = counts.filter(middle & (F.col("c2") <= limit)).select(*bracket, "r", (F.col("seek") - F.col("c0") - F.col("c1")).alias("_at"))
        held = attach(zones.filter("_zone = 2").select(*bracket, "_v", "_n"), near.select(*bracket).distinct(), bracket, "left_semi")
        held = held.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*bracket).orderBy("_v")))
        found.append(durable(attach(held, near, bracket, "inner").filter("_at >= _upto - _n AND _at < _upto").select(*keys, "r", F.col("_v").alias("value"))))
        left = lambda where, lo, hi, add, n: counts.filter(where).select(*keys, "r", *lo, *hi, (F.col("below") + F.expr(add)).alias("below"), F.col(n).alias("n"))
        same_lo, same_hi = [F.col("has_lo"), F.col("lo")], [F.col("has_hi"), F.col("hi")]
        from_ = lambda c: [F.lit(True).alias("has_lo"), F.col(c).alias("lo")]
        upto = lambda c: [F.lit(True).alias("has_hi"), F.col(c).alias("hi")]
        state = durable(left("seek < c0", same_lo, upto("first"), "0", "c0").unionByName(left(middle & (F.col("c2") > limit), from_("first"), upto("last"), "c0 + c1", "c2"))
                        .unionByName(left("seek >= c0 + c1 + c2 + c3", from_("last"), same_hi, "c0 + c1 + c2 + c3", "rest")))
    out = found[0] if found else targets.select(*keys, "r", F.lit(None).cast("double").alias("value")).limit(0)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def group_stats(df: DataFrame, keys, percentiles: dict, aggs=(), size_of: DataFrame | Groups | None = None, approx: bool = False) -> DataFrame:
    """One row per group with exact interpolated percentiles and ordinary aggregates.

    `percentiles` maps an output name to (column, fraction); a tuple of columns is pooled.
    NULL and NaN are left out.  `size_of` is the frame that bounds this one row by row
    and is cheaper to count, or that frame's groups by the same keys.  With `approx` percentiles come from quantile sketches: one pass, no shuffle
    of rows, a value whose rank is off by about 0.13 % of the group's rows (with 99 % confidence), not interpolated.
    """
    keys, aggs = list(keys), list(aggs)
    pools: dict = {}  # percentiles of one column share one sorted list
    for name, (c, p) in percentiles.items():
        members = c if isinstance(c, tuple) else (c,)
        mark = tuple(x if isinstance(x, str) else id(x) for x in members)
        columns = [_orderable(x) for x in members]
        pools.setdefault(mark, (columns, []))[1].append((name, float(p)))
    pools = list(pools.values())
    if approx:
        return _sketched_stats(df, keys, pools, percentiles, aggs)
    groups = size_of if isinstance(size_of, Groups) and size_of.keys == tuple(keys) else None
    if groups is None:
        groups = groups_of(df if isinstance(size_of, Groups) else _bound(size_of, df, keys), keys)
    hot = groups.hot
    if hot is None:
        return _sorted_stats(df, keys, pools, percentiles, aggs)
    if not groups.rest:  # no pass over all rows to find none
        return _spread_stats(df, keys, pools, percentiles, aggs)
    cold = _sorted_stats(attach(df, hot, keys, "left_anti"), keys, pools, percentiles, aggs)
    return cold.unionByName(_spread_stats(attach(df, hot, keys, "left_semi"), keys, pools, percentiles, aggs))


def _between(low: Column, high: Column, h: Column, r: Column) -> Column:
    """Linear interpolation at real rank `h` between the values at ranks r and r + 1."""
    return F.when(h == r, low).otherwise((r + 1 - h) * low + (h - r) * high)


def _stacked(df: DataFrame, keys, pools) -> DataFrame:
    """(keys, m, v): every value of every pool m."""
    entries = [F.struct(F.lit(i).alias("m"), c.alias("v")) for i, (columns, _) in enumerate(pools) for c in columns]
    if len(entries) == 1:
        rows = df.select(*keys, F.lit(0).alias("m"), pools[0][0][0].alias("v"))
    else:
        rows = df.select(*keys, F.explode(F.array(*entries)).alias("e")).select(*keys, "e.m", "e.v")
    return rows.filter("v IS NOT NULL")


def _beside(df: DataFrame, keys, wide: DataFrame, names, aggs) -> DataFrame:
    """The ordinary aggregates of every group next to its percentiles."""
    plain = df.groupBy(*keys).agg(*(aggs or [F.count("*").alias("_n")]))
    rest = [F.col(c) for c in plain.columns if c not in keys and c != "_n"]
    return plain.join(wide, keys, "left").select(*keys, *names, *rest)


def _sorted_stats(df: DataFrame, keys, pools, percentiles, aggs) -> DataFrame:
    """Narrow rows are shuffled and sorted by group (spilling where needed); a task selects ranks in one group's plain arrays at a time.

    A group has at most oneTaskRows rows, so a task holds that many times 8 bytes a column, and nothing boxed.
    """
    plan, columns = [], []  # for each pool its columns' numbers and the fractions wanted
    for own, wanted in pools:
        plan.append((range(len(columns), len(columns) + len(own)), [p for _, p in wanted]))
        columns += own
    order = [name for _, wanted in pools for name, _ in wanted]
    rows = df.select(*keys, *[c.alias(f"_v{k}") for k, c in enumerate(columns)])
    schema = T.StructType([*rows.schema.fields[: len(keys)], *[T.StructField(n, T.DoubleType()) for n in order]])

    depth, width = len(keys), len(columns)

    def select(batches):
        heads, found, last, held = [], [], None, [[] for _ in range(width)]

        def close():
            values = [np.concatenate(parts) for parts in held]
            heads.append(last)
            found.append([x for own, fractions in plan for x in _percentiles(np.concatenate([values[k] for k in own]) if len(own) > 1 else values[own[0]], fractions)])

        def batch():
            arrays = [pa.array([h[i] for h in heads], kinds[i]) for i in range(depth)] + [pa.array([f[i] for f in found], pa.float64()) for i in range(len(order))]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for b in batches:
            if not b.num_rows:
                continue
            kinds = b.schema.types[:depth]
            change = np.zeros(b.num_rows, bool)
            for i in range(depth):
                codes = b.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                change[1:] |= codes[1:] != codes[:-1]
            values = [b.column(depth + k) for k in range(width)]
            lacks = [v.is_null().to_numpy(zero_copy_only=False) if v.null_count else None for v in values]
            values = [v.to_numpy(zero_copy_only=False) for v in values]
            starts = [0, *np.flatnonzero(change).tolist()]
            for start, end in zip(starts, [*starts[1:], b.num_rows]):
                head = tuple(b.column(i)[start].as_py() for i in range(depth))
                if head != last:
                    if last is not None:
                        close()
                    last, held = head, [[] for _ in range(width)]
                for parts, v, lack in zip(held, values, lacks):
                    part = v[start:end]
                    parts.append(part if lack is None else part[~lack[start:end]])
            if len(heads) >= 4096:
                yield batch()
                heads, found = [], []
        if last is not None:
            close()
        if heads:
            yield batch()

    wide = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(select, schema)
    return _beside(df, keys, wide, list(percentiles), aggs) if aggs else wide.select(*keys, *percentiles)


def _percentiles(values: np.ndarray, fractions) -> list[float | None]:
    """Interpolated percentiles; the two values around a rank are found without a full sort."""
    if not len(values):
        return [None] * len(fractions)
    reals = [(len(values) - 1) * p for p in fractions]
    ranks = sorted({min(len(values) - 1, int(h) + d) for h in reals for d in (0, 1)})
    values = np.partition(values, ranks) + 0.0  # one sign of zero
    return [float(values[r]) if h == r else float((r + 1 - h) * values[r] + (h - r) * values[r + 1]) for h, r in ((h, int(h)) for h in reals)]


def _sketched_stats(df: DataFrame, keys, pools, percentiles, aggs) -> DataFrame:
    sketches = _stacked(df, keys, pools).groupBy(*keys, "m").agg(F.kll_sketch_agg_double("v", F.lit(SKETCH)).alias("s"))
    cuts = [F.max(F.when(F.col("m") == i, F.kll_sketch_get_quantile_double("s", F.lit(p)))).alias(name) for i, (_, wanted) in enumerate(pools) for name, p in wanted]
    return _beside(df, keys, sketches.groupBy(*keys).agg(*cuts), list(percentiles), aggs)


def _spread_stats(df: DataFrame, keys, pools, percentiles, aggs) -> DataFrame:
    values = _stacked(df, keys, pools)
    groups = _summaries(df, keys, [columns for columns, _ in pools], aggs)
    summed = [F.struct(F.lit(i).alias("m"), *[F.col(f"_s{i}.{c}").alias(c) for c in ("n", "least", "most", "sketch")]) for i in range(len(pools))]
    first = groups.select(*keys, F.inline(F.array(*summed))).filter("n > 0")
    sizes = first.select(*keys, "m", "n")
    wanted = [F.struct(F.lit(i).alias("m"), F.lit(name).alias("name"), F.lit(p).alias("p")) for i, (_, names) in enumerate(pools) for name, p in names]
    goals = (sizes.withColumn("w", F.explode(F.filter(F.array(*wanted), lambda w: w["m"] == F.col("m"))))
             .select(*keys, "m", "w.name", (F.col("w.p") * (F.col("n") - 1)).alias("h"))
             .withColumn("r_lo", F.floor("h")).withColumn("r_hi", F.ceil("h")))
    targets = goals.select(*keys, "m", F.explode(F.array("r_lo", "r_hi")).alias("r"))
    found = values_at_ranks(values, [*keys, "m"], targets, first)
    low = found.select(*keys, "m", F.col("r").alias("r_lo"), F.col("value").alias("v_lo"))
    high = found.select(*keys, "m", F.col("r").alias("r_hi"), F.col("value").alias("v_hi"))
    both = goals.join(low, [*keys, "m", "r_lo"]).join(high, [*keys, "m", "r_hi"])
    value = _between(F.col("v_lo"), F.col("v_hi"), F.col("h"), F.col("r_lo"))
    wide = (both.withColumn("value", value).groupBy(*keys)
            .agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in percentiles]))
    rest = groups.drop(*[f"_s{i}" for i in range(len(pools))])
    return rest.join(wide, keys, "left").select(*keys, *percentiles, *[c for c in rest.columns if c not in keys])


def ranked(df: DataFrame, keys, order, name: str = "ordinal", size_of: DataFrame | None = None) -> DataFrame:
    """Add the 1-based position of each row inside its group; `order` must be total."""
    keys, order = list(keys), [col(o) for o in order]
    hot = hot_groups(_bound(size_of, df, keys), keys)
    whole = lambda rows: rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    if hot is None:
        return whole(df)
    return whole(attach(df, hot, keys, "left_anti")).unionByName(_spread_rank(attach(df, hot, keys, "left_semi"), keys, order, name))


def _spread_rank(df: DataFrame, keys, order, name: str) -> DataFrame:
    by = [F.col(k) for k in keys] + order
    split = (df.repartitionByRange(*by).sortWithinPartitions(*by)
             .withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    split = durable(split)
    parts = split.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_n")
    parts = parts.withColumn("_shift", before - F.col("_first") + 1).drop("_n", "_first")
    return (attach(split, parts, [*keys, "_part"], "inner")
            .withColumn(name, F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift"))


def kth_rank(frac: float, at_least: int = 1) -> Column:
    """1-based rank int(n * frac) of a group of `n` values."""
    return F.greatest(F.lit(at_least), F.floor(F.col("n") * F.lit(float(frac)))).cast("bigint")


def lower_median_rank() -> Column:
    return F.floor((F.col("n") + 1) / 2).cast("bigint")


def rank_stats(df: DataFrame, keys, value, ranks: dict, size_of: DataFrame | None = None) -> DataFrame:
    """Values at 1-based ranks, without interpolation; `ranks` maps a name to a rank in terms of `n`."""
    keys = list(keys)
    values = df.select(*keys, _orderable(value).alias("v")).filter("v IS NOT NULL")
    hot = hot_groups(_bound(size_of, values, keys), keys)

    def whole(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy("v")
        n = F.count("*").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        placed = rows.withColumns({"n": n, "_at": F.row_number().over(order)})  # one pass over a sort that spills
        hit = {name: F.col("_at") == r for name, r in ranks.items()}
        return placed.filter(reduce(or_, hit.values())).groupBy(*keys).agg(*[F.max(F.when(h, F.col("v"))).alias(name) for name, h in hit.items()])

    if hot is None:
        return whole(values)
    large = attach(values, hot, keys, "left_semi")
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), (r - 1).alias("r")) for name, r in ranks.items()]))
    first = _summaries(large, keys, [[F.col("v")]]).select(*keys, "_s0.*")
    goals = first.select(*keys, wanted.alias("w")).select(*keys, "w.name", "w.r")
    found = goals.join(values_at_ranks(large, keys, goals.select(*keys, "r"), first), [*keys, "r"])
    far = found.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in ranks])
    return whole(attach(values, hot, keys, "left_anti")).unionByName(far)


def kth_smallest(df: DataFrame, keys, value, frac: float, at_least: int = 1, size_of: DataFrame | None = None) -> DataFrame:
    """The int(n * frac)-th smallest value per group (column `kth`)."""
    return rank_stats(df, keys, value, {"kth": kth_rank(frac, at_least)}, size_of)


def lower_median(df: DataFrame, keys, value, size_of: DataFrame | None = None) -> DataFrame:
    """The ((n + 1) / 2)-th smallest value per group (column `value`)."""
    return rank_stats(df, keys, value, {"value": lower_median_rank()}, size_of)


def lagged(df: DataFrame, keys, order, columns: dict, size_of: DataFrame | None = None) -> DataFrame:
    """Add columns holding the previous row's values; `columns` maps new name to source column."""
    keys, order = list(keys), [col(o) for o in order]
    if hot_groups(_bound(size_of, df, keys), keys) is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({new: F.lag(old).over(w) for new, old in columns.items()})
    numbered = durable(ranked(df, keys, order, "_at", size_of))
    before = numbered.select(*keys, (F.col("_at") + 1).alias("_at"), *[F.col(old).alias(new) for new, old in columns.items()])
    # every (group, position) is one row, so this join has no hot key
    return numbered.join(before, [*keys, "_at"], "left").drop("_at")


def evenly_spaced(position, n, wanted: int, rounding) -> Column:
    """True where 0-based `position` is one of `wanted` steps rounded over 0..n-1; all when n <= wanted."""
    position, n = col(position), col(n)
    if wanted <= 0:
        return F.lit(False)
    if wanted == 1:
        hit = position == 0
    else:
        step = (n - 1) / F.lit(float(wanted - 1))
        guess = F.floor(F.try_divide(position.cast("double"), step))
        tries = [guess + d for d in (-1, 0, 1, 2)]
        hit = F.lit(False)
        for i in tries:
            at = F.when(i == wanted - 1, (n - 1).cast("double")).otherwise(i * step)
            hit = hit | ((i >= 0) & (i < wanted) & (rounding(at) == position))
    return F.coalesce((n <= wanted) | hit, F.lit(False))
