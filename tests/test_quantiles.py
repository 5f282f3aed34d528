import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimsight.functions.quantiles import exact_median, exact_quantiles, mode_value


def _df(spark, values, col="x"):
    return spark.createDataFrame([(v,) for v in values], f"{col} double")


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 10.0], [5.0, 1.0, 3.0], [2.0], [7.0, 7.0, 7.0, 7.0]])
def test_median_odd_even(spark, values):
    assert exact_median(_df(spark, values), "x") == pytest.approx(float(np.median(values)))


def test_median_all_null_and_empty(spark):
    assert exact_median(_df(spark, [None, None]), "x") is None
    assert exact_median(_df(spark, []), "x") is None


def test_median_skips_null_and_nan(spark):
    assert exact_median(_df(spark, [None, 1.0, float("nan"), 3.0]), "x") == 2.0


def test_many_passes_with_hot_value(spark):
    # A third of the rows share one value; tiny buckets force several refinement passes.
    rng = np.random.default_rng(1)
    vals = [float(v) for v in rng.normal(size=600)] + [0.25] * 300
    got = exact_quantiles(_df(spark, vals), ["x"], [0.1, 0.25, 0.5, 0.75, 0.9], buckets=4, final_rows=5)
    for p, v in got["x"].items():
        assert v == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40),
       st.sampled_from([0.0, 0.25, 0.5, 0.75, 1.0]))
def test_quantile_matches_numpy(spark, values, p):
    got = exact_quantiles(_df(spark, values), ["x"], [p], buckets=3, final_rows=2)["x"][p]
    assert got == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-9)


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert mode_value(df, "c") == "a"  # tie -> smallest; NULL never counts
    assert mode_value(spark.createDataFrame([(None,)], "c string"), "c") is None


def test_infinities_at_any_size(spark):
    inf = float("inf")
    vals = [float(i % 97) for i in range(600)] + [inf] * 5 + [-inf] * 3 + [1e308, -1e308, 5e-324]
    for final_rows in (5, 20_000):
        got = exact_quantiles(_df(spark, vals), ["x"], [0.0, 0.001, 0.5, 0.9, 1.0], buckets=50, final_rows=final_rows)["x"]
        assert got[0.0] == got[0.001] == -inf and got[1.0] == inf
        assert got[0.5] == float(np.quantile(vals, 0.5)) and got[0.9] == pytest.approx(sorted(vals)[int(0.9 * 610)], abs=1.0)
    assert exact_quantiles(_df(spark, [inf, inf]), ["x"], [0.5])["x"][0.5] == inf


def test_passes_are_few(spark):
    """Three jobs for several columns and quantiles of 200,000 rows: one sketch, one check, one answer at most."""
    df = spark.range(200_000).selectExpr("CAST(id * 7919 % 200003 AS DOUBLE) AS x", "CAST(id % 10 AS DOUBLE) AS y")
    spark.sparkContext.setJobGroup("quantiles", "count jobs")
    got = exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles")
    spark.sparkContext.setJobGroup("other", "")
    want = np.quantile(np.arange(200_000) * 7919 % 200003, [0.25, 0.5, 0.75])
    assert [got["x"][p] for p in (0.25, 0.5, 0.75)] == list(want) and got["y"][0.5] == 4.5
    assert len(jobs) <= 6
