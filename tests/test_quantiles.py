"""Exact distributed quantiles and the numeric profile against numpy / literal values."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators import profile as P
from tidepool.operators.quantiles import exact_quantiles

PROBS = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}


def test_outlier_series_literals(spark):
    df = spark.createDataFrame([("s", float(x)) for x in (1, 2, 3, 4, 5, 100)], "dataset string, value double")
    r = P.numeric_profile(df.withColumn("variable", F.lit("x")), ["dataset", "variable"]).first()
    assert (r.p25, r.median, r.p75, r.std, r.outliers) == (2.25, 3.5, 4.75, 39.6253, 1)
    assert r.iqr == 2.5 and r.total == 6 and r.valid == 6 and r.outlier_pct == 16.67


def test_one_value_and_all_missing(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None), ("b", None)], "variable string, value double")
    rows = {r.variable: r for r in P.numeric_profile(df, ["variable"]).collect()}
    assert rows["a"].std is None and rows["a"].median == 5.0 and rows["a"].outliers == 0
    assert rows["b"].valid == 0 and rows["b"].missing_pct == 100.0 and rows["b"].mean is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.integers(-5, 5), st.floats(-1e6, 1e6))),
                min_size=1, max_size=60))
def test_matches_numpy_linear(spark, rows):
    data = [(g, float(v)) for g, v in rows]
    df = spark.createDataFrame(data, "g int, v double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", PROBS).collect()}
    for g in {g for g, _ in data}:
        vals = np.array([v for gg, v in data if gg == g])
        for name, p in PROBS.items():
            assert np.isclose(getattr(got[g], name), np.percentile(vals, p * 100), rtol=1e-12, atol=1e-9)


def test_weighted_equals_expanded(spark):
    rows = [(1.0, 3), (2.0, 1), (10.0, 5), (4.0, 2)]
    df = spark.createDataFrame(rows, "v double, w long")
    got = exact_quantiles(df, [], "v", PROBS, weight="w").first()
    expanded = np.repeat([v for v, _ in rows], [w for _, w in rows])
    for name, p in PROBS.items():
        assert np.isclose(getattr(got, name), np.percentile(expanded, p * 100))


def test_hot_group_skew(spark):
    # One group holds most rows and one repeated value: still exact, no group gathered.
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(1.5)).otherwise(F.col("id") / 7.0).alias("v"))
    pdf = df.toPandas()
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", PROBS).collect()}
    for g, part in pdf.groupby("g"):
        for name, p in PROBS.items():
            assert np.isclose(getattr(got[g], name), np.percentile(part.v, p * 100))


def test_geometric_spread_and_infinities(spark):
    vals = [10.0 ** e for e in range(-150, 151)] + [-(10.0 ** e) for e in range(0, 100, 7)] + [0.0, 5e-324, 1.7e308]
    for extra in ([], [float("inf")], [float("inf")] * 150 + [float("-inf")]):
        df = spark.createDataFrame([(v,) for v in vals + extra], "v double")
        got = exact_quantiles(df, [], "v", PROBS).first()
        for name, p in PROBS.items():
            # between two equal ranks the quantile is their value; numpy subtracts, which gives NaN between infinities
            ranked = sorted(vals + extra)
            low, high = (ranked[int(f(p * (len(ranked) - 1)))] for f in (np.floor, np.ceil))
            want = low if low == high else np.percentile(ranked, p * 100)
            assert np.isclose(getattr(got, name), want, rtol=1e-12) or getattr(got, name) == want, (name, len(extra))


def test_many_rows_with_inf_in_a_group(spark):
    df = spark.range(300_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") == 7, F.lit(float("inf"))).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("v"))
    pdf = df.toPandas()
    for r in exact_quantiles(df, ["g"], "v", PROBS).collect():
        part = pdf[pdf.g == r.g].v
        for name, p in PROBS.items():
            assert np.isclose(getattr(r, name), np.percentile(part, p * 100))


def test_plan_of_the_last_pass_is_lazy(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    plan = exact_quantiles(df, [], "v", PROBS)._jdf.queryExecution().executedPlan().toString()
    assert "Range" in plan and "LocalTableScan" not in plan
