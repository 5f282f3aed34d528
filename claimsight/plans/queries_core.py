"""Registered portfolio queries (sections 2.4 and 2.7 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimsight.operators import portfolio as P
from claimsight.plans.catalog import iso, register, rnd, scored

_MONTH_SQL = "CAST(date_trunc('month', Accident_Date) AS DATE)"


def _monthly_sql(value_expr: str, value_decimals: int, where: str = "") -> str:
    return f"""
m AS (SELECT {_MONTH_SQL} AS Month, {value_expr} AS value FROM scored {where} GROUP BY 1)
SELECT strftime(Month, '%Y-%m-%d') AS Month, round(value, {value_decimals}) AS value,
  round(avg(value) OVER (ORDER BY Month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), {value_decimals})
    AS moving_avg
FROM m"""


def _monthly(df, d):
    return iso(rnd(df, {"value": d, "moving_avg": d}), "Month")


@register("monthly_exposure", _monthly_sql("sum(Ultimate_Claim_Amount)", 2))
def q_monthly_exposure(spark, sf):
    return _monthly(P.monthly_exposure(scored(spark, sf)), 2)


@register("monthly_volume", _monthly_sql("CAST(count(Policy_ID) AS DOUBLE)", 6))
def q_monthly_volume(spark, sf):
    return _monthly(P.monthly_volume(scored(spark, sf)).withColumn("value", F.col("value").cast("double")), 6)


@register("monthly_high_severity_pct",
          _monthly_sql("100.0E0 * count(*) FILTER (WHERE Ultimate_Claim_Amount > 15000) / count(*)", 6))
def q_monthly_high_severity_pct(spark, sf):
    return _monthly(P.monthly_high_severity_pct(scored(spark, sf), 15000.0), 6)


@register("monthly_mae", _monthly_sql("avg(abs(Ultimate_Claim_Amount - Predictions))", 4))
def q_monthly_mae(spark, sf):
    return _monthly(P.monthly_mae(scored(spark, sf)), 4)


@register("dashboard_tiles", """
SELECT CAST(count(*) AS BIGINT) AS total_claims,
  round(coalesce(sum(Ultimate_Claim_Amount), 0), 2) AS total_exposure,
  round(avg(Ultimate_Claim_Amount), 4) AS average_claim,
  CAST(count(*) FILTER (WHERE Ultimate_Claim_Amount >= 30000) AS BIGINT) AS high_severity_count
FROM scored""")
def q_dashboard_tiles(spark, sf):
    return rnd(P.dashboard_tiles(scored(spark, sf)), {"total_exposure": 2, "average_claim": 4})


@register("portfolio_kpis", """
SELECT CAST(count(*) AS BIGINT) AS total_claims,
  round(coalesce(sum(Ultimate_Claim_Amount), 0), 2) AS total_exposure,
  round(avg(Ultimate_Claim_Amount), 4) AS average_claim,
  round(median(Ultimate_Claim_Amount), 4) AS median_claim,
  round(max(Ultimate_Claim_Amount), 4) AS max_claim
FROM scored""")
def q_portfolio_kpis(spark, sf):
    return rnd(P.portfolio_kpis(scored(spark, sf)),
               {"total_exposure": 2, "average_claim": 4, "median_claim": 4, "max_claim": 4})


@register("severity_distribution", """
SELECT CASE WHEN Ultimate_Claim_Amount < 5000 THEN 'Low' WHEN Ultimate_Claim_Amount < 15000 THEN 'Medium'
  WHEN Ultimate_Claim_Amount < 30000 THEN 'High' WHEN Ultimate_Claim_Amount IS NOT NULL THEN 'Critical' END
  AS Severity, CAST(count(*) AS BIGINT) AS count
FROM scored GROUP BY 1""")
def q_severity_distribution(spark, sf):
    return P.severity_distribution(scored(spark, sf))


@register("claims_by_type", """
SELECT Claim_Type, CAST(count(*) AS BIGINT) AS count FROM scored WHERE Claim_Type IS NOT NULL
GROUP BY 1 ORDER BY count DESC, Claim_Type""")
def q_claims_by_type(spark, sf):
    return P.claims_by_type(scored(spark, sf))


@register("dashboard_chart_severity", _monthly_sql(
    "100.0E0 * count(*) FILTER (WHERE Ultimate_Claim_Amount > 20000) / count(*)", 6,
    "WHERE CAST(Accident_Date AS DATE) BETWEEN DATE '1996-03-01' AND DATE '2000-06-30' "
    "AND Accident_Date >= TIMESTAMP '1996-03-01 00:00:00' AND Accident_Date <= TIMESTAMP '2000-06-30 00:00:00'"))
def q_dashboard_chart_severity(spark, sf):
    """Entry 3: date-range view, then the monthly share above a 20,000 threshold."""
    from claimsight.plans.scoring import dashboard_chart
    return _monthly(dashboard_chart(scored(spark, sf), "1996-03-01", "2000-06-30", "severity", 20000.0), 6)


@register("batch_severity_counts", """
SELECT Severity, CAST(count(*) AS BIGINT) AS count FROM scored WHERE Severity IS NOT NULL
GROUP BY 1 ORDER BY count DESC, Severity""")
def q_batch_severity_counts(spark, sf):
    return P.batch_severity_counts(scored(spark, sf))
