"""Exact order statistics: the spread-out forms give what one task gives."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from splatlake.functions.order_stats import group_stats, kth_smallest, lagged, lower_median, ranked


def skewed(spark, seed=1):
    """One group holds most rows; ties, outliers, NaN, infinities and NULLs included."""
    rng = np.random.default_rng(seed)
    v = np.concatenate([rng.normal(0, 1, 300), np.full(80, 0.25), [1e12, -1e12, np.inf, np.nan], rng.integers(0, 5, 30)])
    pdf = pd.DataFrame({"k": [0] * 384 + [1] * 20 + [2] * 10, "id": range(len(v)), "v": v})
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.when(F.col("id") != 7, F.col("v")))


def expected(pdf, p):
    pdf = pdf[(pdf["id"] != 7) & ~pdf["v"].isna()]
    out = {}
    for k, g in pdf.groupby("k"):
        s = np.sort(g["v"].to_numpy())
        h = (len(s) - 1) * p
        lo = int(np.floor(h))
        out[k] = s[lo] if h == lo else (lo + 1 - h) * s[lo] + (h - lo) * s[lo + 1]
    return out


@pytest.mark.parametrize("p", [0.0, 0.37, 0.99])
def test_percentile_small_and_spread_agree(spark, spread, p):
    pdf, df = skewed(spark)
    got = {r["k"]: r["q"] for r in group_stats(df, ["k"], {"q": ("v", p)}, [F.count("*").alias("n")]).collect()}
    assert got == pytest.approx(expected(pdf, p), rel=1e-12)


def test_pooled_columns(spark, spread):
    _, df = skewed(spark)
    df = df.filter("v IS NOT NULL AND NOT isnan(v)").withColumn("w", F.col("v") * 2)
    row = {r["k"]: r["q"] for r in group_stats(df, ["k"], {"q": (("v", "w"), 0.5)}).collect()}
    pdf = df.toPandas()
    for k, g in pdf.groupby("k"):
        assert row[k] == pytest.approx(np.percentile(np.concatenate([g["v"], g["w"]]), 50))


def test_ranks_match_window(spark, spread):
    _, df = skewed(spark)
    order = [F.col("v").desc(), F.col("id")]
    spread_out = {r["id"]: r["ordinal"] for r in ranked(df, ["k"], order).collect()}
    spark.conf.set("spark.splatlake.oneTaskBytes", str(1 << 40))
    whole = {r["id"]: r["ordinal"] for r in ranked(df, ["k"], order).collect()}
    assert spread_out == whole


def test_kth_and_lower_median(spark, spread):
    pdf, df = skewed(spark)
    clean = pdf[(pdf["id"] != 7) & ~pdf["v"].isna()]
    kth = {r["k"]: r["kth"] for r in kth_smallest(df, ["k"], "v", 0.9).collect()}
    mid = {r["k"]: r["value"] for r in lower_median(df, ["k"], "v").collect()}
    for k, g in clean.groupby("k"):
        s = np.sort(g["v"].to_numpy())
        assert kth[k] == s[max(1, int(len(s) * 0.9)) - 1]
        assert mid[k] == s[(len(s) + 1) // 2 - 1]


def test_lagged_matches_window(spark, spread):
    _, df = skewed(spark)
    got = {r["id"]: r["prev"] for r in lagged(df, ["k"], ["id"], {"prev": "id"}).collect()}
    spark.conf.set("spark.splatlake.oneTaskBytes", str(1 << 40))
    assert got == {r["id"]: r["prev"] for r in lagged(df, ["k"], ["id"], {"prev": "id"}).collect()}


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e300, 1e300, allow_nan=False), min_size=61, max_size=90))
def test_spread_median_of_any_doubles(spark, spread, values):
    df = spark.createDataFrame(pd.DataFrame({"k": 0, "v": values}))
    got = lower_median(df, ["k"], "v").first()["value"]
    assert got == sorted(values)[(len(values) + 1) // 2 - 1]


def test_percentiles_build_no_lists(spark):
    _, df = skewed(spark)
    out = group_stats(df, ["k"], {"q": ("v", 0.5), "top": (F.col("v") * 2, 0.9)}, [F.count("*").alias("n")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan
    assert "collect_list" not in kth_smallest(df, ["k"], "v", 0.5)._jdf.queryExecution().executedPlan().toString()


def test_percentiles_of_many_groups_odd_keys_and_empty_ones(spark):
    rows = [(None if k == 3 else f"k{k}", k % 4 if k % 5 else None, float(v) if v % 7 else None) for k in range(300) for v in range(k % 9)] + [("none", 1, None), ("none", 1, float("nan"))]
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {(r.a, r.b): (r.lo, r.mid) for r in group_stats(df, ["a", "b"], {"mid": ("v", 0.5), "lo": ("v", 0.0)}).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    groups = {}
    for a, b, v in rows:
        groups.setdefault((a, b), []).extend([v] if v is not None and v == v else [])
    assert got == {k: (min(v), float(np.percentile(v, 50))) if v else (None, None) for k, v in groups.items()}


def test_extreme_values_keep_their_size(spark, spread):
    top = 1.7976931348623157e308
    values = [top] * 40 + [-top] * 40 + [0.0, np.inf, -np.inf, 5e-324]
    df = spark.createDataFrame(pd.DataFrame({"k": 0, "v": values}))
    row = group_stats(df, ["k"], {"a": ("v", 10 / 83), "b": ("v", 70 / 83), "c": ("v", 1.0), "d": ("v", 0.0), "e": ("v", 41 / 83)}).first()
    assert (row.a, row.b, row.c, row.d) == (-top, top, np.inf, -np.inf) and row.e == sorted(values)[41]


def test_heavy_tails_take_as_many_rounds_as_any(spark, spread, monkeypatch):
    from splatlake.functions import order_stats

    written = []
    monkeypatch.setattr(order_stats, "durable", lambda df, real=order_stats.durable: written.append(1) or real(df))
    rounds = []
    for values in (np.arange(4000.0), np.exp(np.arange(4000) / 6.0) - 1, np.r_[np.zeros(3990), 1e300, -1e300, np.arange(8.0)]):
        written.clear()
        assert lower_median(spark.createDataFrame(pd.DataFrame({"k": 0, "v": values})), ["k"], "v").first()["value"] == sorted(values)[1999]
        rounds.append(len(written))
    assert max(rounds) <= rounds[0] + 3  # one round more at most


def test_approximate_percentiles_are_near(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), F.sqrt("id").alias("v"))
    exact = {r.k: r for r in group_stats(df, ["k"], {"a": ("v", 0.1), "b": ("v", 0.9)}, [F.count("*").alias("n")]).collect()}
    for r in group_stats(df, ["k"], {"a": ("v", 0.1), "b": ("v", 0.9)}, [F.count("*").alias("n")], approx=True).collect():
        assert r.n == exact[r.k].n and abs(r.a ** 2 - exact[r.k].a ** 2) < 1000 and abs(r.b ** 2 - exact[r.k].b ** 2) < 1000


def test_attach_sets_hot_keys_apart(spark, spread):
    from splatlake.functions.scaling import attach

    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(600)] + [(None, 1)], "k int, i int")
    table = spark.createDataFrame([(k, f"t{k}") for k in range(0, 600, 2)] + [(0, "again")], "k int, t string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        for isolate in (True, False):
            got = attach(rows, table, ["k"], how, isolate=isolate)
            assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(table, ["k"], how).collect())), how
    assert "explode" not in attach(rows.filter("i % 3 = 0"), table, ["k"])._jdf.queryExecution().optimizedPlan().toString()


def test_made_rows_are_counted_before_a_broadcast(spark):
    from splatlake.functions.scaling import small_side
    from splatlake.operators.runs import completed_vs_skipped

    spark.conf.set("spark.splatlake.broadcastBytes", "100000")
    try:
        made = spark.range(500).select(F.explode(F.sequence(F.lit(0), F.lit(99))).alias("i"), F.concat(F.lit("out/"), "id", F.lit("_"), "i").alias("output_dir"))
        assert not small_side(made)[1] and small_side(made.filter("i = 0"))[1]
        runs = made.select(F.col("output_dir"), F.lit("").alias("output_name"))
        got = completed_vs_skipped(runs, made.filter("i < 50"))
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert {(r.status, r["count"]) for r in got.groupBy("status").count().collect()} == {("completed", 25000), ("skipped", 25000)}
    finally:
        spark.conf.unset("spark.splatlake.broadcastBytes")


def test_neighbouring_ranks_share_a_bracket(spark, spread, monkeypatch):
    """Values meet one bracket for a percentile, and none for the smallest and the largest one."""
    from splatlake.functions import order_stats

    met = []

    def inside(values, spans, keys, real=order_stats._inside):
        met.append(spans.count() if "first" in spans.columns else 0)
        return real(values, spans, keys)

    monkeypatch.setattr(order_stats, "_inside", inside)
    df = spark.createDataFrame(pd.DataFrame({"k": 0, "v": np.arange(4000.0) ** 2}))
    row = group_stats(df, ["k"], {"mid": ("v", 0.5), "low": ("v", 0.0), "top": ("v", 1.0)}).first()
    assert (row.mid, row.low, row.top) == ((1999.0 ** 2 + 2000.0 ** 2) / 2, 0.0, 3999.0 ** 2)
    assert max(met) == 1


def test_two_passes_find_the_percentiles_of_hot_groups(spark):
    """One pass sums the groups up, with the plain aggregates; one counts around the brackets and keeps what lies inside."""
    from splatlake.functions import order_stats

    def counted(rows):
        return rows.mapInArrow(lambda batches: (seen.add(1) or b for b in batches), rows.schema)

    seen = spark.sparkContext.accumulator(0)
    df = counted(spark.createDataFrame(pd.DataFrame({"k": [0] * 3000 + [1] * 3000, "v": np.arange(6000.0) ** 2})).coalesce(1))
    spark.conf.set("spark.splatlake.oneTaskRows", "200")
    try:
        out = order_stats.durable(order_stats._spread_stats(df, ["k"], [([F.col("v")], [("q", 0.37), ("p", 0.9)])], ["q", "p"], [F.max("v").alias("top")]))
    finally:
        spark.conf.unset("spark.splatlake.oneTaskRows")
    read = seen.value
    df.count()
    once = seen.value - read
    v = np.arange(6000.0) ** 2
    for row in out.collect():
        own = v[:3000] if row.k == 0 else v[3000:]
        assert (row.q, row.p, row.top) == (pytest.approx(np.percentile(own, 37)), pytest.approx(np.percentile(own, 90)), own[-1])
    assert read <= 2 * once


@pytest.mark.parametrize("small", [0, 20])
def test_no_pass_for_groups_that_are_not_there(spark, spread, monkeypatch, small):
    """Where every group is hot, no pass looks for others; a row without a key is no hot group's."""
    from splatlake.functions import order_stats

    sorted_too = []
    monkeypatch.setattr(order_stats, "_sorted_stats", lambda *a, real=order_stats._sorted_stats: sorted_too.append(1) or real(*a))
    pdf = pd.DataFrame({"k": [0] * 300 + [1] * 300 + [2] * small, "v": np.arange(600.0 + small) ** 2})
    got = {r.k: r.q for r in group_stats(spark.createDataFrame(pdf), ["k"], {"q": ("v", 0.37)}, [F.count("*").alias("n")]).collect()}
    assert got == {k: pytest.approx(np.percentile(g["v"], 37)) for k, g in pdf.groupby("k")}
    assert len(sorted_too) == (1 if small else 0)
    keyless = spark.createDataFrame(pdf).withColumn("k", F.when(F.col("v") > 0, F.col("k")))
    groups = order_stats.groups_of(keyless, ["k"])
    assert sorted(r.k for r in groups.hot.collect()) == [0, 1] and groups.rest
