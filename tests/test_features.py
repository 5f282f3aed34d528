import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimsight.functions import rules as R
from claimsight.operators import features as FE
from claimsight.operators.joins import attach_group_mean, merge_claims_policies


def _claims(spark, rows):
    return spark.createDataFrame(rows, "Claim_ID string, Accident_Date string, FNOL_Date string, "
                                       "Date_of_Birth string, Full_License_Issue_Date string, Vehicle_Year int")


def test_dates_edge_cases(spark):
    rows = [
        ("c1", "2024-03-10 01:00:00", "2024-03-12 03:30:00", "2000-02-29", "2020-01-01", 2015),  # DST + leap day
        ("c2", "not a date", "2024-01-02", "1990-01-01", "2010-01-01", 2020),                  # malformed
        ("c3", "2024-05-01 12:00:00", "2024-04-30 12:00:00", "1999-05-02", "2025-05-01", 2030),  # FNOL before, licence after
    ]
    df = FE.ages(FE.fnol_delay(FE.parse_dates(_claims(spark, rows))))
    got = {r["Claim_ID"]: r for r in df.collect()}
    assert got["c1"]["FNOL_Delay"] == pytest.approx(50.5)     # zone-free, no clock-change hour
    assert got["c1"]["Driver_Age"] == 24                      # 8776 days // 365
    assert got["c2"]["Accident_Date"] is None and got["c2"]["FNOL_Delay"] is None
    assert got["c3"]["FNOL_Delay"] == pytest.approx(-24.0)
    assert got["c3"]["Driver_Age"] == 25                      # 9131 days // 365
    assert got["c3"]["License_Age"] == 1                      # |floor(-365/365)| = 1
    assert got["c3"]["Vehicle_Age"] == 6                      # |2024 - 2030|


def test_negative_day_gap_floors(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00", "2024-01-11 00:00:00")],
                               "id string, Accident_Date string, Full_License_Issue_Date string")
    out = FE.ages(FE.parse_dates(df)).first()
    assert out["License_Age"] == 1  # floor(-10/365) = -1, then abs


@pytest.mark.parametrize("amount,bucket", [(0.0, None), (1000.0, "0-1k"), (1000.01, "1k-5k"), (5000.0, "1k-5k"),
                                           (50000.0, "20k-50k"), (50000.01, "50+"), (-5.0, None), (None, None)])
def test_estimate_bucket_edges(spark, amount, bucket):
    df = spark.createDataFrame([(amount,)], "x double")
    assert df.select(R.estimate_bucket("x").alias("b")).first()["b"] == bucket


@pytest.mark.parametrize("age,flag", [(0, "Yes"), (24, "Yes"), (25, "No"), (65, "No"), (66, "Yes"), (100, "Yes"),
                                      (None, "No")])
def test_high_risk_driver(spark, age, flag):
    df = spark.createDataFrame([(age,)], "Driver_Age int")
    assert FE.flags(df).first()["High_Risk_Driver"] == flag


def test_high_risk_upper_age_parameter(spark):
    df = spark.createDataFrame([(66,), (71,)], "Driver_Age int")
    got = [r["High_Risk_Driver"] for r in FE.flags(df, high_risk_max_age=70).orderBy("Driver_Age").collect()]
    assert got == ["No", "Yes"]


@pytest.mark.parametrize("age,left,right", [(0, "<25", None), (25, "25-34", "<25"), (65, "65+", "55-64"),
                                            (100, None, "65+"), (2, "<25", "<25")])
def test_driver_bands_both_sides(spark, age, left, right):
    df = spark.createDataFrame([(age,)], "a int")
    r = df.select(R.driver_age_band("a", right=False).alias("l"), R.driver_age_band("a", right=True).alias("r")).first()
    assert (r["l"], r["r"]) == (left, right)


@pytest.mark.parametrize("age,left,right", [(0, "New (0-3)", None), (3, "Modern (4-7)", "0-3"),
                                            (20, "Vintage (20+)", "13-20"), (21, "Vintage (20+)", "20+")])
def test_vehicle_bands(spark, age, left, right):
    df = spark.createDataFrame([(age,)], "a int")
    r = df.select(R.vehicle_age_band("a", right=False).alias("l"), R.vehicle_age_band("a", right=True).alias("r")).first()
    assert (r["l"], r["r"]) == (left, right)


def test_impute_median_even_count_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None), (None, None)],
                               "Estimated_Claim_Amount double, Ultimate_Claim_Amount double")
    out = FE.impute_median(df).collect()
    assert sorted(r["Estimated_Claim_Amount"] for r in out) == [1.0, 2.0, 2.5, 3.0, 10.0]
    assert all(r["Ultimate_Claim_Amount"] is None for r in out)


def test_impute_mode_ties(spark):
    df = spark.createDataFrame([("Rainy", None), ("Clear", None), ("Rainy", None), ("Clear", None), (None, None)],
                               "Weather_Condition string, Traffic_Condition string")
    out = FE.impute_mode(df)
    assert sorted(r["Weather_Condition"] for r in out.collect()) == ["Clear", "Clear", "Clear", "Rainy", "Rainy"]
    assert all(r["Traffic_Condition"] is None for r in out.collect())


def test_merge_keys(spark):
    claims = spark.createDataFrame([("c1", "p1", "u1"), ("c2", None, None), ("c3", "p9", "u9")],
                                   "Claim_ID string, Policy_ID string, Customer_ID string")
    policies = spark.createDataFrame([("p1", "u1", 2010), ("p1", "u1", 2011), (None, None, 2000)],
                                     "Policy_ID string, Customer_ID string, Vehicle_Year int")
    out = merge_claims_policies(claims, policies).collect()
    ids = sorted((r["Claim_ID"], r["Vehicle_Year"]) for r in out)
    # duplicate policy multiplies, NULL keys match NULL keys, unmatched claim dropped
    assert ids == [("c1", 2010), ("c1", 2011), ("c2", 2000)]
    strict = merge_claims_policies(claims, policies, null_safe=False).collect()
    assert sorted(r["Claim_ID"] for r in strict) == ["c1", "c1"]


def test_merge_suffixes(spark):
    a = spark.createDataFrame([("p", "u", "x")], "Policy_ID string, Customer_ID string, Note string")
    b = spark.createDataFrame([("p", "u", "y")], "Policy_ID string, Customer_ID string, Note string")
    assert set(merge_claims_policies(a, b).columns) == {"Policy_ID", "Customer_ID", "Note_x", "Note_y"}


def test_group_mean_null_key(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 3.0), (None, 5.0), ("B", 4.0)], "Claim_Type string, e double")
    got = {r["e"]: r["m"] for r in attach_group_mean(df, "Claim_Type", "e", "m").collect()}
    assert got == {1.0: 2.0, 3.0: 2.0, 5.0: None, 4.0: 4.0}


def test_estimate_relative_zero_mean(spark):
    df = spark.createDataFrame([("A", 0.0, 1, "High", "Stormy")],
                               "Claim_Type string, Estimated_Claim_Amount double, Vehicle_Age int, "
                               "Traffic_Condition string, Weather_Condition string")
    r = FE.estimate_features(df).first()
    assert r["Estimate_Relative_to_Type"] is None and r["Complexity_Score"] == "Yes"
    assert r["Estimate_Bucket"] is None


def test_upload_features_as_of(spark):
    df = spark.createDataFrame([("2000-01-01", "2020-01-01", 2015, "2024-01-01 00:00:00", "2024-01-01 06:00:00")],
                               "Date_of_Birth string, Full_License_Issue_Date string, Vehicle_Year int, "
                               "Accident_Date string, FNOL_Date string")
    r = FE.upload_features(df, dt.datetime(2026, 1, 1)).first()
    assert r["Driver_Age"] == pytest.approx(9497 / 365.25)
    assert r["Vehicle_Age"] == 11 and r["FNOL_Delay"] == pytest.approx(6.0)


def test_settlement_delay(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", "2024-01-03 09:00:00")], "FNOL_Date string, Settlement_Date string")
    assert FE.settlement_delay(FE.parse_dates(df, ["FNOL_Date", "Settlement_Date"])).first()["Settlement_Delay"] == 1


def test_feature_list():
    assert FE.feature_list()[0] == "FNOL_Delay" and len(FE.feature_list(True)) == 12 + 10 + 6


def test_parse_dates_keeps_typed_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "Accident_Date date")
    out = FE.parse_dates(df)
    assert out.schema["Accident_Date"].dataType.simpleString() == "timestamp_ntz"
    assert out.select(F.col("Accident_Date").cast("string")).first()[0] == "2024-02-29 00:00:00"
