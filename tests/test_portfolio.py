import pytest
from pyspark.sql import functions as F

from claimsight.operators import metrics as M
from claimsight.operators import portfolio as P
from claimsight.operators import quality as Q

SCHEMA = ("Claim_ID string, Policy_ID string, Accident_Date timestamp_ntz, Settlement_Date timestamp_ntz, "
          "Ultimate_Claim_Amount double, Estimated_Claim_Amount double, Predictions double, "
          "Recommended_Reserve double, Severity string, Claim_Type string, FNOL_Delay double, "
          "Driver_Age int, Vehicle_Age int, Weather_Condition string")


def _scored(spark, rows):
    import datetime as dt
    out = []
    for i, (month, amount) in enumerate(rows):
        d = dt.datetime(2024, month, 15)
        p = amount * 0.9
        out.append((f"c{i}", f"p{i % 3}", d, d + dt.timedelta(days=10, hours=5), amount, amount * 1.1, p,
                    p * 1.15, None, "Collision" if i % 2 else "Theft", 30.0 * (i % 3), 20 + i, i % 15, "Rainy"))
    df = spark.createDataFrame(out, SCHEMA)
    from claimsight.functions import rules as R
    return df.withColumn("Severity", R.severity("Predictions"))


def test_monthly_gap_and_moving_average(spark):
    # months 1, 2 and 5 (gap not filled): the 3-row mean runs over rows, not calendar months
    df = _scored(spark, [(1, 100.0), (1, 300.0), (2, 20000.0), (5, 50.0)])
    got = [(r["Month"].month, r["value"], r["moving_avg"]) for r in P.monthly_exposure(df).orderBy("Month").collect()]
    assert got == [(1, 400.0, 400.0), (2, 20000.0, 10200.0), (5, 50.0, pytest.approx(20450.0 / 3))]


def test_monthly_high_severity_month_without_high(spark):
    df = _scored(spark, [(1, 100.0), (2, 20000.0), (2, 10.0)])
    got = {r["Month"].month: r["value"] for r in P.monthly_high_severity_pct(df, 15000).collect()}
    assert got == {1: 0.0, 2: 50.0}


def test_single_month_and_sum_property(spark):
    df = _scored(spark, [(3, 10.0), (3, 20.0)])
    assert P.monthly_exposure(df).first()["moving_avg"] == 30.0
    big = _scored(spark, [(m, 1000.0 * m) for m in range(1, 13)])
    total = P.dashboard_tiles(big).first()["total_exposure"]
    assert P.monthly_exposure(big).agg(F.sum("value")).first()[0] == pytest.approx(total)


def test_severity_counts_sum_to_rows(spark):
    df = _scored(spark, [(1, a) for a in (10.0, 5000.0, 14999.99, 15000.0, 29999.0, 30000.0, 80000.0)])
    dist = {r["Severity"]: r["count"] for r in P.severity_distribution(df).collect()}
    assert dist == {"Low": 1, "Medium": 2, "High": 2, "Critical": 2}
    assert sum(dist.values()) == df.count()


def test_empty_aggregates(spark):
    empty = spark.createDataFrame([], SCHEMA)
    t = P.dashboard_tiles(empty).first()
    assert (t["total_claims"], t["total_exposure"], t["average_claim"], t["high_severity_count"]) == (0, 0.0, None, 0)
    k = P.portfolio_kpis(empty).first()
    assert k["median_claim"] is None and k["total_exposure"] == 0.0
    s = P.detailed_savings(empty).first()
    assert s["total_savings"] == 0.0
    assert P.amount_histogram(empty).count() == 0
    assert P.savings_projection(empty).first()["total_savings"] == 0.0
    assert P.dashboard_alerts(empty).count() == 0


def test_histogram_counts(spark):
    df = _scored(spark, [(1, float(a)) for a in range(100)])
    h = P.amount_histogram(df, bins=10).orderBy("bin").collect()
    assert [r["count"] for r in h] == [10] * 10 and h[-1]["bin_end"] == pytest.approx(99.0)


def test_reserve_adequacy_status_and_lift(spark):
    df = _scored(spark, [(1, 1000.0), (1, 3000.0), (4, 2000.0)])
    rows = {r["Claim_Type"]: r for r in P.reserve_adequacy(df, "claim_type").collect()}
    for r in rows.values():
        # predictions are 0.9 * actual, reserve 1.035 * actual: small surplus, model better than estimate
        assert r["Status"] == "🟢Adequate"
        assert r["Model_Lift_%"] == pytest.approx(0.0)  # |y - 1.1y| == |y - 0.9y|
    q = P.reserve_adequacy(df, "Volume").collect()
    assert {r["Quarter_Year"] for r in q} == {"2024Q1", "2024Q2"}
    assert P.reserve_adequacy(df, "unknown").columns[0] == "Claim_Type"


def test_analysis_dimension_drops_null_groups(spark):
    df = _scored(spark, [(1, 10.0), (1, 20.0)]).withColumn("Weather_Condition", F.lit(None).cast("string"))
    assert P.analysis_by_dimension(df, "weather").count() == 0
    assert P.analysis_by_dimension(df, "Volume").first()["Volume"] == 2


def test_feature_statistics_against_numpy(spark):
    import numpy as np
    vals = [1.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = P.feature_statistics(df, ["x"]).first()
    assert r["median"] == 2.5 and r["q25"] == pytest.approx(np.quantile(vals, 0.25))
    assert r["std"] == pytest.approx(np.std(vals, ddof=1))


def test_prediction_variance_rules(spark):
    df = spark.createDataFrame([("a", 100.0), ("a", 100.0), ("b", 100.0), ("b", 160.0), ("c", 5.0)],
                               "Claim_ID string, prediction double")
    got = {r["Claim_ID"]: (r["cv"], r["confidence"]) for r in P.prediction_variance(df).collect()}
    assert got["a"] == (0.0, "High") and got["b"][1] == "Medium" and got["c"] == (0.0, "Low")


@pytest.mark.parametrize("y,p,r2", [([1.0, 2.0, 3.0], [1.0, 2.0, 3.0], 1.0), ([5.0, 5.0], [5.0, 5.0], 1.0),
                                    ([5.0, 5.0], [4.0, 6.0], 0.0), ([0.0, 0.0], [0.0, 0.0], 1.0)])
def test_r2_edges(spark, y, p, r2):
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    assert df.agg(M.r2("y", "p")).first()[0] == pytest.approx(r2)


def test_smape_and_mape_zero_handling(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "y double, p double")
    r = df.agg(M.smape("y", "p").alias("s"), M.mape("y", "p").alias("m")).first()
    assert r["s"] == 0.0 and r["m"] == 0.0
    df2 = spark.createDataFrame([(0.0, 0.0), (1.0, 3.0)], "y double, p double")
    assert df2.agg(M.smape("y", "p")).first()[0] == pytest.approx(1.0)


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "k string, v double")
    miss = {r["column"]: (r["missing"], r["critical"]) for r in Q.missing_report(df, 0.5).collect()}
    assert miss == {"k": (0, False), "v": (2, True)}
    d = Q.duplicate_report(df).first()
    assert (d["duplicates"], d["rows"]) == (1, 3)
    with pytest.raises(Q.ValidationError):
        Q.validate(df, 0.5)
    assert Q.validate(df, 0.9)["passed"]
    odd = spark.createDataFrame([(None, "a"), ("a", None), (None, "a")], "x string, y string")  # NULLs in other places differ
    assert Q.duplicate_report(odd).first()["duplicates"] == 1
    assert tuple(Q.duplicate_report(odd.limit(0)).first())[:2] == (0, 0)


def test_validate_upload_messages(spark):
    df = spark.createDataFrame([("p", None, 1.0)] * 9 + [("p", "c", 1.0)],
                               "Policy_ID string, Claim_ID string, Estimated_Claim_Amount double")
    r = Q.validate_upload(df).first()
    assert not r["is_valid"]
    assert r["errors"][0] == "Missing required columns: Driver_Age, Vehicle_Age, Claim_Type"
    assert r["errors"][1] == "Claim_ID has 90.0% missing values (threshold: 10%)"
    empty = spark.createDataFrame([], "Policy_ID string")
    assert "Uploaded file contains no data" in Q.validate_upload(empty).first()["errors"]


def test_claims_without_a_date_have_no_month(spark):
    import datetime as dt
    rows = [("a", "p1", dt.datetime(2024, 1, 5), 100.0, 90.0), ("b", "p2", dt.datetime(2024, 2, 5), 300.0, 310.0), ("c", "p3", None, 900.0, 0.0)]
    df = spark.createDataFrame(rows, "Claim_ID string, Policy_ID string, Accident_Date timestamp_ntz, Ultimate_Claim_Amount double, Predictions double")
    got = [(r["value"], r["moving_avg"]) for r in P.monthly_exposure(df).orderBy("Month").collect()]
    assert got == [(100.0, 100.0), (300.0, 200.0)]
    for series in (P.monthly_volume(df), P.monthly_high_severity_pct(df), P.monthly_mae(df), P.trend_volume(df)):
        assert series.count() == 2 and series.where("Month IS NULL").count() == 0
