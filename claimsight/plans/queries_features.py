"""Registered queries for cleaning, features, filters, joins and quality (2.2-2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimsight import config as K
from claimsight.operators import features as FE
from claimsight.operators import filters as FL
from claimsight.operators import quality as Q
from claimsight.plans.catalog import merged, prepared, register, rnd, scored, ts_text

_TS = "'%Y-%m-%d %H:%M:%S'"


# --------------------------------------------------------------------------- F1-F21
@register("parse_dates", f"""
t AS (SELECT Claim_ID,
    CASE WHEN Claim_ID % 43 = 0 THEN 'not-a-date' WHEN Claim_ID % 47 = 0 THEN '2001-02-29 10:00:00'
         ELSE strftime(FNOL_Date, {_TS}) END AS FNOL_Date,
    strftime(Date_of_Birth, '%Y-%m-%d') AS Date_of_Birth
  FROM merged)
SELECT Claim_ID, strftime(TRY_CAST(FNOL_Date AS TIMESTAMP), {_TS}) AS FNOL_Date,
  strftime(TRY_CAST(Date_of_Birth AS TIMESTAMP), {_TS}) AS Date_of_Birth FROM t""")
def q_parse_dates(spark, sf):
    k = F.col("Claim_ID")
    text = (F.when(k % 43 == 0, F.lit("not-a-date")).when(k % 47 == 0, F.lit("2001-02-29 10:00:00"))
            .otherwise(F.col("FNOL_Date").cast("string")))
    raw = merged(spark, sf).select("Claim_ID", text.alias("FNOL_Date"),
                                   F.col("Date_of_Birth").cast("date").cast("string").alias("Date_of_Birth"))
    return ts_text(FE.parse_dates(raw, ["FNOL_Date", "Date_of_Birth"]), "FNOL_Date", "Date_of_Birth")


@register("impute_median", """
SELECT Claim_ID, round(Estimated_Claim_Amount, 4) AS Estimated_Claim_Amount,
  round(Ultimate_Claim_Amount, 4) AS Ultimate_Claim_Amount FROM imputed""")
def q_impute_median(spark, sf):
    out = FE.impute_median(merged(spark, sf)).select("Claim_ID", *K.NUMERIC_IMPUTE_COLUMNS)
    return rnd(out, {c: 4 for c in K.NUMERIC_IMPUTE_COLUMNS})


@register("impute_mean", """
SELECT Claim_ID,
  round(coalesce(Estimated_Claim_Amount, avg(Estimated_Claim_Amount) OVER ()), 4) AS Estimated_Claim_Amount,
  round(coalesce(Ultimate_Claim_Amount, avg(Ultimate_Claim_Amount) OVER ()), 4) AS Ultimate_Claim_Amount
FROM merged""")
def q_impute_mean(spark, sf):
    out = FE.impute_mean(merged(spark, sf)).select("Claim_ID", *K.NUMERIC_IMPUTE_COLUMNS)
    return rnd(out, {c: 4 for c in K.NUMERIC_IMPUTE_COLUMNS})


@register("impute_mode", "SELECT Claim_ID, Traffic_Condition, Weather_Condition FROM imputed")
def q_impute_mode(spark, sf):
    return FE.impute_mode(merged(spark, sf)).select("Claim_ID", *K.CATEGORICAL_IMPUTE_COLUMNS)


@register("fnol_delay", "SELECT Claim_ID, round(FNOL_Delay, 6) AS FNOL_Delay FROM features")
def q_fnol_delay(spark, sf):
    return rnd(FE.fnol_delay(merged(spark, sf)).select("Claim_ID", "FNOL_Delay"), {"FNOL_Delay": 6})


@register("ages", "SELECT Claim_ID, Driver_Age, License_Age, Vehicle_Age FROM features")
def q_ages(spark, sf):
    return FE.ages(merged(spark, sf)).select("Claim_ID", "Driver_Age", "License_Age", "Vehicle_Age")


@register("risk_flags", """
SELECT Claim_ID, High_Risk_Driver, Inexperienced_Driver, Old_Vehicle, Early_FNOL FROM features""")
def q_risk_flags(spark, sf):
    return prepared(spark, sf).select("Claim_ID", "High_Risk_Driver", "Inexperienced_Driver",
                                      "Old_Vehicle", "Early_FNOL")


@register("risk_flags_age70", """
SELECT Claim_ID, CASE WHEN Driver_Age < 25 OR Driver_Age > 70 THEN 'Yes' ELSE 'No' END AS High_Risk_Driver,
  CASE WHEN FNOL_Delay <= 1 THEN 'Yes' ELSE 'No' END AS Early_FNOL FROM features""")
def q_risk_flags_age70(spark, sf):
    """The form's variant of the flags: upper age 70, early FNOL within 1 hour."""
    base = FE.ages(FE.fnol_delay(merged(spark, sf)))
    return FE.flags(base, high_risk_max_age=70, early_fnol_hours=1.0) \
        .select("Claim_ID", "High_Risk_Driver", "Early_FNOL")


@register("estimate_features", """
SELECT Claim_ID, round(Estimate_to_Age_Ratio, 4) AS Estimate_to_Age_Ratio, Estimate_Bucket,
  round(Type_Avg_Estimate, 4) AS Type_Avg_Estimate,
  round(Estimate_Relative_to_Type, 8) AS Estimate_Relative_to_Type, Complexity_Score
FROM features""")
def q_estimate_features(spark, sf):
    out = prepared(spark, sf).select("Claim_ID", "Estimate_to_Age_Ratio", "Estimate_Bucket",
                                     "Type_Avg_Estimate", "Estimate_Relative_to_Type", "Complexity_Score")
    return rnd(out, {"Estimate_to_Age_Ratio": 4, "Type_Avg_Estimate": 4, "Estimate_Relative_to_Type": 8})


@register("type_average", """
SELECT Claim_Type, round(avg(Estimated_Claim_Amount), 4) AS Type_Avg_Estimate
FROM imputed WHERE Claim_Type IS NOT NULL GROUP BY 1""")
def q_type_average(spark, sf):
    out = prepared(spark, sf).select("Claim_Type", "Type_Avg_Estimate").where(F.col("Claim_Type").isNotNull())
    return rnd(out.dropDuplicates(["Claim_Type"]), {"Type_Avg_Estimate": 4})


@register("settlement_delay", """
SELECT Claim_ID, CAST(floor(date_diff('second', FNOL_Date, Settlement_Date) / 86400.0E0) AS BIGINT)
  AS Settlement_Delay FROM merged""")
def q_settlement_delay(spark, sf):
    return FE.settlement_delay(merged(spark, sf)).select("Claim_ID", "Settlement_Delay")


@register("derive_features", """
SELECT Claim_ID, round(Estimated_Claim_Amount, 4) AS Estimated_Claim_Amount,
  round(Ultimate_Claim_Amount, 4) AS Ultimate_Claim_Amount, Traffic_Condition, Weather_Condition,
  round(FNOL_Delay, 6) AS FNOL_Delay, Driver_Age, License_Age, Vehicle_Age, High_Risk_Driver,
  Inexperienced_Driver, Old_Vehicle, Early_FNOL, round(Estimate_to_Age_Ratio, 4) AS Estimate_to_Age_Ratio,
  Estimate_Bucket, round(Estimate_Relative_to_Type, 8) AS Estimate_Relative_to_Type, Complexity_Score
FROM features""")
def q_derive_features(spark, sf):
    cols = ["Claim_ID", "Estimated_Claim_Amount", "Ultimate_Claim_Amount", "Traffic_Condition",
            "Weather_Condition"] + list(K.DERIVED_FEATURES)
    return rnd(prepared(spark, sf).select(*cols),
               {"Estimated_Claim_Amount": 4, "Ultimate_Claim_Amount": 4, "FNOL_Delay": 6,
                "Estimate_to_Age_Ratio": 4, "Estimate_Relative_to_Type": 8})


_AS_OF = "2026-01-01 00:00:00"


@register("upload_features", f"""
SELECT Claim_ID, round(date_diff('second', Accident_Date, FNOL_Date) / 3600.0E0, 6) AS FNOL_Delay,
  round(floor(date_diff('second', Date_of_Birth, TIMESTAMP '{_AS_OF}') / 86400.0E0) / 365.25E0, 6) AS Driver_Age,
  round(floor(date_diff('second', Full_License_Issue_Date, TIMESTAMP '{_AS_OF}') / 86400.0E0) / 365.25E0, 6)
    AS License_Age,
  CAST(2026 - Vehicle_Year AS BIGINT) AS Vehicle_Age
FROM merged""")
def q_upload_features(spark, sf):
    out = FE.upload_features(merged(spark, sf), _AS_OF).select(
        "Claim_ID", "FNOL_Delay", "Driver_Age", "License_Age", "Vehicle_Age")
    return rnd(out, {"FNOL_Delay": 6, "Driver_Age": 6, "License_Age": 6})


# --------------------------------------------------------------------------- P1-P12
@register("select_available", """
SELECT round(FNOL_Delay, 6) AS FNOL_Delay, Driver_Age, License_Age, Vehicle_Age,
  round(Estimate_to_Age_Ratio, 4) AS Estimate_to_Age_Ratio,
  round(Estimate_Relative_to_Type, 8) AS Estimate_Relative_to_Type, Traffic_Condition, Weather_Condition,
  High_Risk_Driver, Inexperienced_Driver, Old_Vehicle, Early_FNOL, Estimate_Bucket, Claim_Type,
  Vehicle_Type, Complexity_Score
FROM scored""")
def q_select_available(spark, sf):
    return rnd(FL.select_available(scored(spark, sf)),
               {"FNOL_Delay": 6, "Estimate_to_Age_Ratio": 4, "Estimate_Relative_to_Type": 8})


@register("drop_missing_target", """
SELECT Claim_ID, round(Ultimate_Claim_Amount, 4) AS Ultimate_Claim_Amount
FROM merged WHERE Ultimate_Claim_Amount IS NOT NULL""")
def q_drop_missing_target(spark, sf):
    out = FL.drop_missing_target(merged(spark, sf)).select("Claim_ID", "Ultimate_Claim_Amount")
    return rnd(out, {"Ultimate_Claim_Amount": 4})


@register("features_and_target", """
SELECT Claim_ID, round(ln(1 + Ultimate_Claim_Amount), 9) AS label FROM features""")
def q_features_and_target(spark, sf):
    return rnd(FL.features_and_target(prepared(spark, sf)).select("Claim_ID", "label"), {"label": 9})


@register("date_range", f"""
SELECT Claim_ID, strftime(Accident_Date, {_TS}) AS Accident_Date FROM scored
WHERE CAST(Accident_Date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def q_date_range(spark, sf):
    return ts_text(FL.date_range(scored(spark, sf), "1996-01-01", "1999-12-31")
                   .select("Claim_ID", "Accident_Date"), "Accident_Date")


@register("date_range_ts", f"""
SELECT Claim_ID, strftime(FNOL_Date, {_TS}) AS FNOL_Date FROM scored
WHERE FNOL_Date >= TIMESTAMP '1996-01-01 00:00:00' AND FNOL_Date <= TIMESTAMP '1999-12-31 00:00:00'""")
def q_date_range_ts(spark, sf):
    return ts_text(FL.date_range_ts(scored(spark, sf), "1996-01-01", "1999-12-31", col="FNOL_Date")
                   .select("Claim_ID", "FNOL_Date"), "FNOL_Date")


@register("high_severity", """
SELECT Claim_ID, round(Ultimate_Claim_Amount, 4) AS Ultimate_Claim_Amount FROM scored
WHERE Ultimate_Claim_Amount >= 30000""")
def q_high_severity(spark, sf):
    return rnd(FL.high_severity(scored(spark, sf)).select("Claim_ID", "Ultimate_Claim_Amount"),
               {"Ultimate_Claim_Amount": 4})


@register("late_claims", "SELECT Claim_ID, round(FNOL_Delay, 6) AS FNOL_Delay FROM scored WHERE FNOL_Delay > 48")
def q_late_claims(spark, sf):
    return rnd(FL.late_claims(scored(spark, sf)).select("Claim_ID", "FNOL_Delay"), {"FNOL_Delay": 6})


def _money_sql(x: str) -> str:
    return f"coalesce('£' || format('{{:,.2f}}', {x}), '')"


@register("display_columns", f"""
SELECT Claim_ID, Policy_ID, High_Risk_Driver, Inexperienced_Driver,
  {_money_sql('Estimated_Claim_Amount')} AS Estimated_Claim_Amount,
  {_money_sql('Ultimate_Claim_Amount')} AS Ultimate_Claim_Amount,
  {_money_sql('Predictions')} AS Predictions, Severity,
  {_money_sql('Recommended_Reserve')} AS Recommended_Reserve
FROM scored""")
def q_display_columns(spark, sf):
    return FL.display_columns(scored(spark, sf))


@register("scatter_points", """
SELECT round(Estimated_Claim_Amount, 4) AS Estimated_Claim_Amount,
  round(Ultimate_Claim_Amount, 4) AS Ultimate_Claim_Amount,
  round(greatest(max(Estimated_Claim_Amount) OVER (), max(Ultimate_Claim_Amount) OVER ()), 4) AS diagonal_max
FROM scored""")
def q_scatter_points(spark, sf):
    return rnd(FL.scatter_points(scored(spark, sf)),
               {"Estimated_Claim_Amount": 4, "Ultimate_Claim_Amount": 4, "diagonal_max": 4})


@register("sample_n", """
SELECT Claim_ID FROM scored ORDER BY md5(CAST(Claim_ID AS VARCHAR) || '#42'), Claim_ID LIMIT 3000""")
def q_sample_n(spark, sf):
    return FL.sample_n(scored(spark, sf), 3000, seed=42).select("Claim_ID")


@register("reference_rows", """
SELECT Claim_ID, Policy_ID, Claim_Type FROM scored ORDER BY Claim_ID LIMIT 5""")
def q_reference_rows(spark, sf):
    return FL.reference_rows(scored(spark, sf), 5).select("Claim_ID", "Policy_ID", "Claim_Type")


@register("with_claim_inputs", """
o AS (SELECT Claim_ID, Estimated_Claim_Amount * 1.25E0 AS Estimated_Claim_Amount, 'Stormy' AS Weather_Condition,
        Driver_Age + 5 AS Driver_Age FROM features),
w AS (SELECT f.Claim_ID, o.Estimated_Claim_Amount, o.Weather_Condition, o.Driver_Age, f.License_Age,
        f.Vehicle_Age, f.FNOL_Delay, f.Traffic_Condition, f.Type_Avg_Estimate
      FROM features f JOIN o ON f.Claim_ID = o.Claim_ID)
SELECT Claim_ID, CASE WHEN Driver_Age < 25 OR Driver_Age > 65 THEN 'Yes' ELSE 'No' END AS High_Risk_Driver,
  round(Estimated_Claim_Amount / (Vehicle_Age + 1), 4) AS Estimate_to_Age_Ratio,
  CASE WHEN Estimated_Claim_Amount > 0 AND Estimated_Claim_Amount <= 1000 THEN '0-1k'
       WHEN Estimated_Claim_Amount > 1000 AND Estimated_Claim_Amount <= 5000 THEN '1k-5k'
       WHEN Estimated_Claim_Amount > 5000 AND Estimated_Claim_Amount <= 10000 THEN '5k-10k'
       WHEN Estimated_Claim_Amount > 10000 AND Estimated_Claim_Amount <= 20000 THEN '10k-20k'
       WHEN Estimated_Claim_Amount > 20000 AND Estimated_Claim_Amount <= 50000 THEN '20k-50k'
       WHEN Estimated_Claim_Amount > 50000 THEN '50+' END AS Estimate_Bucket,
  round(Estimated_Claim_Amount / Type_Avg_Estimate, 8) AS Estimate_Relative_to_Type,
  CASE WHEN Traffic_Condition IN ('High', 'Severe') AND Weather_Condition = 'Stormy' THEN 'Yes' ELSE 'No' END
    AS Complexity_Score
FROM w""")
def q_with_claim_inputs(spark, sf):
    """What-if: every claim re-assessed with a 25% higher estimate, stormy weather, driver 5 years older."""
    base = prepared(spark, sf)
    overrides = base.select("Claim_ID", (F.col("Estimated_Claim_Amount") * 1.25).alias("Estimated_Claim_Amount"),
                            F.lit("Stormy").alias("Weather_Condition"),
                            (F.col("Driver_Age") + 5).alias("Driver_Age"))
    type_means = base.select("Claim_Type", "Type_Avg_Estimate").dropDuplicates(["Claim_Type"])
    out = FL.with_claim_inputs(base, overrides, type_means=type_means)
    return rnd(out.select("Claim_ID", "High_Risk_Driver", "Estimate_to_Age_Ratio", "Estimate_Bucket",
                          "Estimate_Relative_to_Type", "Complexity_Score"),
               {"Estimate_to_Age_Ratio": 4, "Estimate_Relative_to_Type": 8})


# --------------------------------------------------------------------------- J1
@register("merge_claims_policies", f"""
SELECT Claim_ID, Policy_ID, Customer_ID, strftime(Date_of_Birth, {_TS}) AS Date_of_Birth,
  strftime(Full_License_Issue_Date, {_TS}) AS Full_License_Issue_Date, Vehicle_Year, Vehicle_Type
FROM merged""")
def q_merge_claims_policies(spark, sf):
    out = merged(spark, sf).select("Claim_ID", "Policy_ID", "Customer_ID", "Date_of_Birth",
                                   "Full_License_Issue_Date", "Vehicle_Year", "Vehicle_Type")
    return ts_text(out, "Date_of_Birth", "Full_License_Issue_Date")


# --------------------------------------------------------------------------- Q1-Q6
_MERGED_COLS = ("Claim_ID", "Policy_ID", "Customer_ID", "Accident_Date", "FNOL_Date", "Settlement_Date",
                "Estimated_Claim_Amount", "Ultimate_Claim_Amount", "Claim_Type", "Traffic_Condition",
                "Weather_Condition", "Date_of_Birth", "Full_License_Issue_Date", "Vehicle_Year", "Vehicle_Type")

_MISSING_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing, "
    f"round(100.0E0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS missing_pct, "
    f"100.0E0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) > 10.0 AS critical FROM merged"
    for c in _MERGED_COLS)


@register("missing_report", _MISSING_SQL)
def q_missing_report(spark, sf):
    return rnd(Q.missing_report(merged(spark, sf)), {"missing_pct": 6})


@register("duplicate_report", """
g AS (SELECT Policy_ID, Claim_Type, Vehicle_Type, count(*) AS c FROM merged GROUP BY ALL)
SELECT CAST(sum(c - 1) AS BIGINT) AS duplicates, CAST(sum(c) AS BIGINT) AS "rows",
  round(100.0E0 * sum(c - 1) / sum(c), 6) AS duplicate_pct FROM g""")
def q_duplicate_report(spark, sf):
    df = merged(spark, sf).select("Policy_ID", "Claim_Type", "Vehicle_Type")
    return rnd(Q.duplicate_report(df), {"duplicate_pct": 6})


@register("duplicate_rows", """
u AS (SELECT * FROM merged UNION ALL SELECT * FROM merged WHERE Claim_ID % 10 = 0 UNION ALL SELECT * FROM merged WHERE Claim_ID % 30 = 0),
g AS (SELECT count(*) AS c FROM u GROUP BY ALL), n AS (SELECT count(*) AS n FROM u), k AS (SELECT count(*) AS k FROM (SELECT DISTINCT * FROM u))
SELECT CAST(n - k AS BIGINT) AS duplicates, CAST(n AS BIGINT) AS "rows", round(100.0E0 * (n - k) / n, 6) AS duplicate_pct FROM n CROSS JOIN k""")
def q_duplicate_rows(spark, sf):
    """Whole rows that occur two and three times, with NULLs in them (Q2)."""
    df = merged(spark, sf)
    df = df.unionByName(df.where("Claim_ID % 10 = 0")).unionByName(df.where("Claim_ID % 30 = 0"))
    return rnd(Q.duplicate_report(df), {"duplicate_pct": 6})


def _validate_sql(table: str, present: tuple, missing: tuple) -> str:
    msgs = []
    if missing:
        msgs.append("'Missing required columns: " + ", ".join(missing) + "'")
    msgs.append("CASE WHEN n = 0 THEN 'Uploaded file contains no data' END")
    for i, c in enumerate(present):
        pct = f"(100.0E0 * n{i} / n)"
        msgs.append(f"CASE WHEN n > 0 AND n{i} > 0 AND {pct} > 10 THEN "
                    f"'{c} has ' || format('{{:.1f}}', {pct}) || '% missing values (threshold: 10%)' END")
    counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n{i}" for i, c in enumerate(present))
    return f"""
a AS (SELECT count(*) AS n, {counts} FROM {table}),
m AS (SELECT list_filter([{", ".join(msgs)}], lambda x: x IS NOT NULL) AS errs FROM a)
SELECT len(errs) = 0 AS is_valid, array_to_string(errs, ' | ') AS errors FROM m"""


@register("validate_upload", _validate_sql(
    "merged", ("Policy_ID", "Claim_ID", "Estimated_Claim_Amount", "Claim_Type"), ("Driver_Age", "Vehicle_Age")))
def q_validate_upload(spark, sf):
    """Raw claims as an upload: the two derived columns are missing."""
    out = Q.validate_upload(merged(spark, sf))
    return out.select("is_valid", F.array_join("errors", " | ").alias("errors"))


@register("validate_upload_scored", _validate_sql("scored", K.UPLOAD_REQUIRED_COLUMNS, ()))
def q_validate_upload_scored(spark, sf):
    out = Q.validate_upload(scored(spark, sf))
    return out.select("is_valid", F.array_join("errors", " | ").alias("errors"))


@register("shape", "SELECT CAST(count(*) AS BIGINT) AS \"rows\", CAST(28 AS BIGINT) AS columns FROM features")
def q_shape(spark, sf):
    return Q.shape(prepared(spark, sf))


# Expected schema of the prepared claims (the oracle states it; Spark must produce it)
_PREPARED_TYPES = (
    ("Claim_ID", "bigint"), ("Policy_ID", "bigint"), ("Customer_ID", "bigint"),
    ("Accident_Date", "timestamp_ntz"), ("FNOL_Date", "timestamp_ntz"), ("Settlement_Date", "timestamp_ntz"),
    ("Estimated_Claim_Amount", "double"), ("Ultimate_Claim_Amount", "double"), ("Claim_Type", "string"),
    ("Traffic_Condition", "string"), ("Weather_Condition", "string"), ("Date_of_Birth", "timestamp_ntz"),
    ("Full_License_Issue_Date", "timestamp_ntz"), ("Vehicle_Year", "int"), ("Vehicle_Type", "string"),
    ("FNOL_Delay", "double"), ("Driver_Age", "bigint"), ("License_Age", "bigint"), ("Vehicle_Age", "bigint"),
    ("High_Risk_Driver", "string"), ("Inexperienced_Driver", "string"), ("Old_Vehicle", "string"),
    ("Early_FNOL", "string"), ("Estimate_to_Age_Ratio", "double"), ("Estimate_Bucket", "string"),
    ("Type_Avg_Estimate", "double"), ("Estimate_Relative_to_Type", "double"), ("Complexity_Score", "string"),
)


@register("type_report", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null FROM features"
    for c, t in _PREPARED_TYPES))
def q_type_report(spark, sf):
    """Column name, Spark type and non-NULL count of the prepared claims (Q3)."""
    return Q.type_report(prepared(spark, sf))


_NULLS = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _MERGED_COLS)
_CRITICAL = " || ".join(
    f"CASE WHEN 100.0E0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) > 10 THEN '{c},' ELSE '' END"
    for c in _MERGED_COLS)


@register("quality_gate", f"""
a AS (SELECT count(*) AS n, {_NULLS} AS nulls, {_CRITICAL} AS crit FROM merged),
d AS (SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM merged)),
r AS (SELECT n, nulls, rtrim(crit, ',') AS crit, n - distinct_rows AS dups FROM a CROSS JOIN d)
SELECT 'rows' AS "check", CAST(n AS VARCHAR) AS value FROM r
UNION ALL SELECT 'columns', '{len(_MERGED_COLS)}'
UNION ALL SELECT 'total_missing', CAST(nulls AS VARCHAR) FROM r
UNION ALL SELECT 'critical_missing', crit FROM r
UNION ALL SELECT 'duplicate_rows', CAST(dups AS VARCHAR) FROM r
UNION ALL SELECT 'validation_passed', CASE WHEN crit = '' THEN 'True' ELSE 'False' END FROM r""")
def q_quality_gate(spark, sf):
    """The preparation's quality gate on the joined claims (Q4): one row per check."""
    one = Q.quality_gate(merged(spark, sf))
    checks = {"rows": "n_rows", "columns": "n_columns", "total_missing": "missing_cells", "duplicate_rows": "duplicate_rows"}
    cells = [F.struct(F.lit(k).alias("check"), F.col(c).cast("string").alias("value")) for k, c in checks.items()]
    cells += [F.struct(F.lit("critical_missing").alias("check"), F.array_join("critical_columns", ",").alias("value")),
              F.struct(F.lit("validation_passed").alias("check"), F.when(F.col("passed"), "True").otherwise("False").alias("value"))]
    return one.select(F.inline(F.array(*cells)))
