"""Gold: distributed exact median vs numpy, top-k ties, count identities."""

import numpy as np
from pyspark.sql import functions as F

from tests.paths import SF_SMALL
from jobmart.operators import gold
from jobmart.operators.quantiles import grouped_median
from jobmart.plans import registry


def test_grouped_median_matches_numpy(spark):
    rng = np.random.default_rng(7)
    rows = []
    # a hot group (large, many duplicates), mid groups, tiny groups, a group of NULLs only
    rows += [("hot", None, float(x)) for x in rng.integers(0, 500, 20000)]
    rows += [("mid", "a", float(x)) for x in rng.normal(1000, 50, 3001).round(2)]
    rows += [("t1", "b", 5.0)]
    rows += [("t2", "b", 1.0), ("t2", "b", 4.0)]
    rows += [("nul", "c", None)]
    df = spark.createDataFrame(rows, "k string, k2 string, v double")
    got = {(r.k, r.k2): r.m for r in grouped_median(df, ["k", "k2"], "v", "m").collect()}
    exp = {}
    for k in {(a, b) for a, b, _ in rows}:
        vals = [v for a, b, v in rows if (a, b) == k and v is not None]
        if vals:
            exp[k] = float(np.median(vals))
    assert set(got) == set(exp)
    for k in exp:
        assert abs(got[k] - exp[k]) < 1e-9, k


def test_top_categories_tie_break(spark):
    rows = [("c", "s", lbl, True) for lbl in ["b", "a", "c", "d", "e", "f", "f"]]
    df = spark.createDataFrame(rows, "city string, state_code string, category_label string, is_active boolean")
    got = gold.top_categories(df, 3).collect()[0].top_categories
    assert got == ["f", "a", "b"]


def test_stats_identities(spark):
    st = registry.q_city_job_stats(spark, SF_SMALL)
    assert st.where(F.col("junior_jobs") + F.col("mid_jobs") + F.col("senior_jobs") != F.col("total_jobs")).count() == 0
    assert st.where(F.col("active_jobs") + F.col("expired_jobs") > F.col("total_jobs")).count() == 0


def test_grouped_median_randomized(spark):
    rng = np.random.default_rng(11)
    rows, exp = [], {}
    for g in range(40):
        n = int(rng.choice([1, 2, 3, 7, 50, 999, 6000]))
        kind = g % 4
        if kind == 0:
            vals = rng.integers(-5, 5, n).astype(float)             # heavy ties around zero
        elif kind == 1:
            vals = np.full(n, 42.0)                                # a constant group (hi == lo)
        elif kind == 2:
            vals = rng.lognormal(10, 3, n)                         # extreme spread
        else:
            vals = rng.normal(0, 1e-6, n) + 1e9                    # tiny spread at a large magnitude
        rows += [(f"g{g}", float(x)) for x in vals]
        exp[f"g{g}"] = float(np.median(vals))
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in grouped_median(df, ["k"], "v", "m").collect()}
    assert set(got) == set(exp)
    for k, e in exp.items():
        assert got[k] == e or abs(got[k] - e) <= 1e-9 * max(1.0, abs(e)), (k, got[k], e)


def test_grouped_median_fallback_path(spark, monkeypatch):
    """A coarse sketch and no band margin make the band miss; the exact fallback must take over."""
    from jobmart.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    monkeypatch.setattr(quantiles, "_BAND", 0.0)
    rng = np.random.default_rng(3)
    rows = [(f"g{g}", float(x)) for g in range(6) for x in rng.normal(g * 10, 3, 500 + g)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in quantiles.grouped_median(df, ["k"], "v", "m").collect()}
    for g in range(6):
        vals = [v for k, v in rows if k == f"g{g}"]
        assert abs(got[f"g{g}"] - float(np.median(vals))) < 1e-9


def test_hot_group_that_misses_its_band_is_searched(spark, monkeypatch):
    """A group with most rows, a band that misses and values many orders of magnitude apart: exact, and no
    window holds more than a group's slots."""
    from jobmart.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    monkeypatch.setattr(quantiles, "_BAND", 0.0)
    rng = np.random.default_rng(5)
    hot = [float(x) for x in rng.normal(0, 1, 4000) * 10.0 ** rng.integers(-9, 9, 4000)] + [0.0, 5e-324]
    few = [[1.0], [1.0, 2.0], [3.0] * 9, [-1.7e308, 1.7e308], [2.0, 2.0, 2.0, 7.0]]
    groups = {"hot": hot, **{f"g{i}": v for i, v in enumerate(few)}}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "_b0 string, _v double")
    got = {r["_b0"]: r["_med"] for r in quantiles._searched(df.withColumnRenamed("_b0", "k"), ["k"]).withColumnRenamed("k", "_b0").collect()}

    def middle(vs):
        a, b = sorted(vs)[(len(vs) - 1) // 2], sorted(vs)[len(vs) // 2]
        return a + (b - a) * 0.5

    assert {k: m for k, m in got.items() if k != "g3"} == {k: middle(vs) for k, vs in groups.items() if k != "g3"}
    assert {r.k: r.m for r in quantiles.grouped_median(df.withColumnRenamed("_b0", "k"), ["k"], "_v", "m").collect()}["hot"] == middle(hot)


def test_grouped_median_single_hot_group(spark):
    """All postings in one group (the hot-key case): exact medians of both salary columns."""
    from tests.paths import SF_MID
    from jobmart.operators.quantiles import grouped_medians

    j = registry.postings(spark, SF_MID).withColumn("city", F.lit("HOT"))
    got = grouped_medians(j, ["city"], {"mn": "salary_min", "mx": "salary_max"}).collect()[0]
    vals = j.select(F.col("salary_min").cast("double").alias("a"), F.col("salary_max").cast("double").alias("b")).toPandas()
    assert got.mn == float(np.median(vals.a.dropna())) and got.mx == float(np.median(vals.b.dropna()))
