"""Independent SQL (DuckDB dialect) for the correctness checks.

The same claims/policies mapping, imputation, feature derivation, split and
baseline scoring as the Spark code, spelled as CTEs over the driver's raw
tables.  Each registered query appends its final SELECT to :data:`PREFIX`.
"""

from __future__ import annotations

TEST_MD5 = "33333333333333333333333333333333"  # 0.2 of the 128-bit range

CLAIMS_CTE = """
claims AS (
  SELECT o_orderkey AS Claim_ID, o_custkey AS Policy_ID, o_custkey AS Customer_ID,
    o_orderdate AS Accident_Date,
    o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey * 7 % 97 AS INT) AS FNOL_Date,
    o_orderdate + INTERVAL '1' HOUR
      * CAST(o_orderkey * 7 % 97 + 24 * (o_orderkey * 13 % 181) AS INT) AS Settlement_Date,
    CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice / 5.0E0 END AS Estimated_Claim_Amount,
    CASE WHEN o_orderkey % 71 <> 0
      THEN o_totalprice / 5.0E0 * (0.7E0 + (o_orderkey % 61) / 100.0E0) END AS Ultimate_Claim_Amount,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Collision' WHEN '2-HIGH' THEN 'Theft'
      WHEN '3-MEDIUM' THEN 'Fire' WHEN '4-NOT SPECIFIED' THEN 'Windshield Damage'
      ELSE 'Third-Party Damage' END AS Claim_Type,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Light'
      WHEN o_orderkey % 4 = 1 THEN 'Moderate' WHEN o_orderkey % 4 = 2 THEN 'High'
      ELSE 'Severe' END AS Traffic_Condition,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'Clear'
      WHEN o_orderkey % 5 = 1 THEN 'Rainy' WHEN o_orderkey % 5 = 2 THEN 'Foggy'
      WHEN o_orderkey % 5 = 3 THEN 'Snowy' ELSE 'Stormy' END AS Weather_Condition
  FROM orders)"""

POLICIES_CTE = """
policies AS (
  SELECT c_custkey AS Policy_ID, c_custkey AS Customer_ID,
    TIMESTAMP '1920-01-01 00:00:00'
      + INTERVAL '1' DAY * CAST(c_custkey * 37 % 21000 AS INT) AS Date_of_Birth,
    TIMESTAMP '1937-01-01 00:00:00'
      + INTERVAL '1' DAY * CAST(c_custkey * 37 % 21000 + c_custkey % 900 AS INT)
      AS Full_License_Issue_Date,
    CAST(1980 + c_custkey % 25 AS INT) AS Vehicle_Year, c_mktsegment AS Vehicle_Type
  FROM customer)"""

MERGED_CTE = """
merged AS (
  SELECT c.*, p.Date_of_Birth, p.Full_License_Issue_Date, p.Vehicle_Year, p.Vehicle_Type
  FROM claims c JOIN policies p
    ON c.Policy_ID IS NOT DISTINCT FROM p.Policy_ID
   AND c.Customer_ID IS NOT DISTINCT FROM p.Customer_ID)"""

IMPUTED_CTE = """
impute_stats AS (
  SELECT median(Estimated_Claim_Amount) AS med_est, median(Ultimate_Claim_Amount) AS med_ult
  FROM merged),
mode_traffic AS (
  SELECT Traffic_Condition AS v FROM merged WHERE Traffic_Condition IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
mode_weather AS (
  SELECT Weather_Condition AS v FROM merged WHERE Weather_Condition IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
imputed AS (
  SELECT m.Claim_ID, m.Policy_ID, m.Customer_ID, m.Accident_Date, m.FNOL_Date, m.Settlement_Date,
    coalesce(m.Estimated_Claim_Amount, s.med_est) AS Estimated_Claim_Amount,
    coalesce(m.Ultimate_Claim_Amount, s.med_ult) AS Ultimate_Claim_Amount,
    m.Claim_Type,
    coalesce(m.Traffic_Condition, (SELECT v FROM mode_traffic)) AS Traffic_Condition,
    coalesce(m.Weather_Condition, (SELECT v FROM mode_weather)) AS Weather_Condition,
    m.Date_of_Birth, m.Full_License_Issue_Date, m.Vehicle_Year, m.Vehicle_Type
  FROM merged m CROSS JOIN impute_stats s)"""

FEATURES_CTE = """
feat_a AS (
  SELECT *,
    date_diff('second', Accident_Date, FNOL_Date) / 3600.0E0 AS FNOL_Delay,
    CAST(floor(floor(date_diff('second', Date_of_Birth, Accident_Date) / 86400.0E0) / 365) AS BIGINT)
      AS Driver_Age,
    CAST(abs(floor(floor(date_diff('second', Full_License_Issue_Date, Accident_Date) / 86400.0E0) / 365))
      AS BIGINT) AS License_Age,
    CAST(abs(year(Accident_Date) - Vehicle_Year) AS BIGINT) AS Vehicle_Age
  FROM imputed),
features AS (
  SELECT *,
    CASE WHEN Driver_Age < 25 OR Driver_Age > 65 THEN 'Yes' ELSE 'No' END AS High_Risk_Driver,
    CASE WHEN License_Age < 2 THEN 'Yes' ELSE 'No' END AS Inexperienced_Driver,
    CASE WHEN Vehicle_Age > 10 THEN 'Yes' ELSE 'No' END AS Old_Vehicle,
    CASE WHEN FNOL_Delay <= 24 THEN 'Yes' ELSE 'No' END AS Early_FNOL,
    Estimated_Claim_Amount / (Vehicle_Age + 1) AS Estimate_to_Age_Ratio,
    CASE WHEN Estimated_Claim_Amount > 0 AND Estimated_Claim_Amount <= 1000 THEN '0-1k'
         WHEN Estimated_Claim_Amount > 1000 AND Estimated_Claim_Amount <= 5000 THEN '1k-5k'
         WHEN Estimated_Claim_Amount > 5000 AND Estimated_Claim_Amount <= 10000 THEN '5k-10k'
         WHEN Estimated_Claim_Amount > 10000 AND Estimated_Claim_Amount <= 20000 THEN '10k-20k'
         WHEN Estimated_Claim_Amount > 20000 AND Estimated_Claim_Amount <= 50000 THEN '20k-50k'
         WHEN Estimated_Claim_Amount > 50000 THEN '50+' END AS Estimate_Bucket,
    CASE WHEN Claim_Type IS NOT NULL
      THEN avg(Estimated_Claim_Amount) OVER (PARTITION BY Claim_Type) END AS Type_Avg_Estimate,
    Estimated_Claim_Amount / CASE WHEN Claim_Type IS NOT NULL
      THEN avg(Estimated_Claim_Amount) OVER (PARTITION BY Claim_Type) END AS Estimate_Relative_to_Type,
    CASE WHEN Traffic_Condition IN ('High', 'Severe') AND Weather_Condition = 'Stormy'
      THEN 'Yes' ELSE 'No' END AS Complexity_Score
  FROM feat_a)"""

SCORED_CTE = f"""
split AS (
  SELECT *, CASE WHEN md5(CAST(Claim_ID AS VARCHAR) || '-42') < '{TEST_MD5}'
    THEN 'test' ELSE 'train' END AS split
  FROM features),
baseline AS (
  SELECT regr_intercept(ln(1 + Ultimate_Claim_Amount), ln(1 + Estimated_Claim_Amount)) AS a,
         regr_slope(ln(1 + Ultimate_Claim_Amount), ln(1 + Estimated_Claim_Amount)) AS b
  FROM split WHERE split = 'train'),
pred AS (
  SELECT s.*, exp(b.a + b.b * ln(1 + s.Estimated_Claim_Amount)) - 1 AS Predictions
  FROM split s CROSS JOIN baseline b),
scored AS (
  SELECT *,
    CASE WHEN Predictions < 5000 THEN 'Low' WHEN Predictions < 15000 THEN 'Medium'
         WHEN Predictions < 30000 THEN 'High' WHEN Predictions IS NOT NULL THEN 'Critical' END AS Severity,
    Predictions * 1.15E0 AS Recommended_Reserve
  FROM pred)"""

PREFIX = "WITH " + ",".join([CLAIMS_CTE, POLICIES_CTE, MERGED_CTE, IMPUTED_CTE,
                             FEATURES_CTE, SCORED_CTE]) + "\n"


def half_up(body: str) -> str:
    """Rewrite every ``round(expr, d)`` as ``floor(expr * 10^d + 0.5) / 10^d``.

    The Spark side rounds with the same double arithmetic
    (:func:`claimsight.plans.catalog.rnd`), so both engines round identically
    even where a value sits on a decimal half.
    """
    out, i, low = [], 0, body.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(body[i:])
                return "".join(out)
            out.append(body[i:j + 6])
            i = j + 6
            continue
        out.append(body[i:j])
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = body[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        if comma < 0:  # round(x): no digits
            comma = k - 1
            digits = 0
        else:
            digits = int(body[comma + 1:k - 1].strip())
        inner = half_up(body[j + 6:comma])
        out.append(f"(floor(({inner}) * 1e{digits} + 0.5) / 1e{digits})")
        i = k


def sql(body: str) -> str:
    """Full oracle SQL: the shared CTEs plus ``body`` (more CTEs and/or a SELECT)."""
    body = half_up(body.strip())
    if body.upper().startswith("SELECT"):
        return PREFIX + body
    # body starts with extra CTEs: "name AS (...), ... SELECT ..."
    return PREFIX.rstrip() + ",\n" + body


def severity_sql(x: str) -> str:
    return (f"CASE WHEN {x} < 5000 THEN 'Low' WHEN {x} < 15000 THEN 'Medium' "
            f"WHEN {x} < 30000 THEN 'High' WHEN {x} IS NOT NULL THEN 'Critical' END")
