"""Registered queries for exact splits, large vocabularies, skewed joins, several models at once and the day-level rollup."""

from __future__ import annotations

import functools
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from claimsight.operators import levels as L
from claimsight.operators import ml as ML
from claimsight.operators import portfolio as P
from claimsight.operators.joins import merge_skewed, null_key_rows
from claimsight.operators.rollup import Rollup, build
from claimsight.operators.split import train_test_split, with_exact_split
from claimsight.plans.catalog import _CACHE, _key, iso, prepared, register, rnd, scored
from claimsight.plans.queries_checks import _RIVALS_SQL, FLAG, RIVALS
from claimsight.session import shared_path
from claimsight.sources.tables import fixture_claims, fixture_policies, read_table


@register("train_test_split_exact", """
o AS (SELECT Claim_ID, row_number() OVER (ORDER BY md5(CAST(Claim_ID AS VARCHAR) || '-42')) AS place, count(*) OVER () AS n FROM features)
SELECT Claim_ID, CASE WHEN place <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM o""")
def q_train_test_split_exact(spark, sf):
    """Exactly a fifth of the claims, rounded up, is the test part (M1)."""
    return with_exact_split(prepared(spark, sf)).select("Claim_ID", "split")


# --------------------------------------------------------------------------- many levels
_LEVELS, _BUCKETS = 3000, 512
_PLACE = "l_partkey || '/' || l_suppkey || '/' || CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_orderkey END"


@register("level_slots", f"""
v AS (SELECT CAST({_PLACE} AS VARCHAR) AS level FROM lineitem),
c AS (SELECT level, count(*) AS n FROM v GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, level) - 1 AS rank FROM c)
SELECT level, CAST(n AS BIGINT) AS n, CAST(CASE WHEN rank < {_LEVELS} THEN rank
  ELSE {_LEVELS} + CAST('0x' || substr(md5(level), 1, 15) AS BIGINT) % {_BUCKETS} END AS BIGINT) AS slot FROM r""")
def q_level_slots(spark, sf):
    """Slots of a column with about as many levels as rows: the commonest by rank, the others by hash bucket."""
    lines = read_table(spark, sf, "lineitem").select(F.expr(f"CAST({_PLACE} AS STRING)").alias("place"))
    table = L.level_table(lines, "place")
    return (L.with_slot(lines, "place", table, _LEVELS, _BUCKETS).groupBy(F.col("place").alias("level"), "slot")
            .agg(F.count(F.lit(1)).alias("n")).select("level", "n", "slot"))


@register("level_pipeline", """
t AS (SELECT Claim_ID, Policy_ID, Claim_Type FROM split WHERE split = 'train'),
p AS (SELECT CAST(Policy_ID AS VARCHAR) AS v, row_number() OVER (ORDER BY count(*) DESC, CAST(Policy_ID AS VARCHAR)) - 1 AS slot FROM t GROUP BY 1),
c AS (SELECT Claim_Type AS v, row_number() OVER (ORDER BY count(*) DESC, Claim_Type) - 1 AS slot FROM t GROUP BY 1),
k AS (SELECT least(count(*), 200) AS n FROM p)
SELECT s.Claim_ID, CAST(CASE WHEN p.slot < 200 THEN p.slot ELSE k.n + CAST('0x' || substr(md5(CAST(s.Policy_ID AS VARCHAR)), 1, 15) AS BIGINT) % 64 END AS INT) AS policy_slot,
  CAST(k.n + 64 + c.slot AS INT) AS type_slot, CAST(2 AS INT) AS entries
FROM split s CROSS JOIN k LEFT JOIN p ON p.v = CAST(s.Policy_ID AS VARCHAR) LEFT JOIN c ON c.v = s.Claim_Type""")
def q_level_pipeline(spark, sf):
    """Sparse features of two categories through level tables: 200 policies of their own, the others and unseen ones in 64 buckets (M3)."""
    df = prepared(spark, sf).withColumn("Policy_ID", F.col("Policy_ID").cast("string"))
    train, _ = train_test_split(df)
    prep = L.fit_level_pipeline(train, [], ["Policy_ID", "Claim_Type"], most_levels=200, buckets=64)
    # The vector is an argument, not a part of the lambda, which would turn it into an array again at every slot.
    at = F.array_compact(F.transform(vector_to_array("features"), lambda x, i: F.when(x != 0, i)))
    out = prep.transform(df).select("Claim_ID", at.alias("at"))
    return out.select("Claim_ID", F.col("at")[0].alias("policy_slot"), F.col("at")[1].alias("type_slot"), F.size("at").alias("entries"))


# --------------------------------------------------------------------------- a hot policy and NULL keys
def _skewed(spark, sf):
    """Every third claim has policy 1; some claims and policies have no key."""
    k = F.col("Claim_ID")
    key = F.when(k % 97 == 0, None).when(k % 3 == 0, 1).otherwise(F.col("Policy_ID")).cast("bigint")
    claims = fixture_claims(spark, sf).select("Claim_ID", key.alias("Policy_ID"), key.alias("Customer_ID"), "Estimated_Claim_Amount")
    p = F.col("Policy_ID")
    none = F.when((p % 211 == 0) & (p != 1), None).otherwise(p).cast("bigint")
    return claims, fixture_policies(spark, sf).select(none.alias("Policy_ID"), none.alias("Customer_ID"), "Vehicle_Year", "Vehicle_Type")


_SKEWED_SQL = """
c AS (SELECT Claim_ID, CASE WHEN Claim_ID % 97 = 0 THEN NULL WHEN Claim_ID % 3 = 0 THEN 1 ELSE Policy_ID END AS k FROM claims),
p AS (SELECT CASE WHEN Policy_ID % 211 = 0 AND Policy_ID <> 1 THEN NULL ELSE Policy_ID END AS k, Vehicle_Year, Vehicle_Type FROM policies)"""


@register("merge_hot_policy", _SKEWED_SQL + """
SELECT c.Claim_ID, c.k AS Policy_ID, p.Vehicle_Year, p.Vehicle_Type, (SELECT count(*) FROM c WHERE k IS NULL) AS null_claims,
  (SELECT count(*) FROM p WHERE k IS NULL) AS null_policies
FROM c JOIN p ON c.k IS NOT DISTINCT FROM p.k""")
def q_merge_hot_policy(spark, sf):
    """A third of the claims has one policy, and both sides have NULL keys, which match each other."""
    claims, policies = _skewed(spark, sf)
    n, m = null_key_rows(claims, policies)
    out = merge_skewed(claims, policies, heavy_rows=200)
    return out.select("Claim_ID", "Policy_ID", "Vehicle_Year", "Vehicle_Type", F.lit(n).cast("bigint").alias("null_claims"),
                      F.lit(m).cast("bigint").alias("null_policies"))


@register("merge_hot_policy_apart", _SKEWED_SQL + """
SELECT p.Vehicle_Type, CAST(count(*) AS BIGINT) AS claims, CAST(sum(c.Claim_ID) AS BIGINT) AS ids FROM c JOIN p ON c.k = p.k GROUP BY 1""")
def q_merge_hot_policy_apart(spark, sf):
    """The same join with the rows without a key kept apart."""
    claims, policies = _skewed(spark, sf)
    out = merge_skewed(claims, policies, nulls="apart", heavy_rows=200)
    return out.groupBy("Vehicle_Type").agg(F.count(F.lit(1)).alias("claims"), F.sum("Claim_ID").alias("ids"))


# --------------------------------------------------------------------------- several models
@register("model_variance", _RIVALS_SQL + """
, w AS (SELECT s.Claim_ID, exp(one.lp) - 1 AS a, exp(g.lp) - 1 AS b FROM split s CROSS JOIN one JOIN g ON g.High_Risk_Driver = s.High_Risk_Driver),
v AS (SELECT Claim_ID, (a + b) / 2 AS mean, abs(a - b) / 2 AS std FROM w)
SELECT Claim_ID, round(mean, 3) AS mean, round(std, 3) AS std, round(std / mean * 100, 5) AS cv,
  CASE WHEN std / mean * 100 < 10 THEN 'High' WHEN std / mean * 100 < 25 THEN 'Medium' ELSE 'Low' END AS confidence FROM v""")
def q_model_variance(spark, sf):
    """Two fitted pipelines score every claim in one scan; their spread per claim."""
    df = prepared(spark, sf)
    train, test = train_test_split(df)
    models = {tm.name: tm.model for tm in ML.train_all(train, test, list(RIVALS), RIVALS, **FLAG)}
    wide = ML.score_models(df, models)
    columns = [F.col("predictions")[i].alias(n) for i, n in enumerate(models)]
    return rnd(P.prediction_variance_wide(wide.select("Claim_ID", *columns), list(models)), {"mean": 3, "std": 3, "cv": 5})


# --------------------------------------------------------------------------- rollup
#: Three ranges of the dashboard's date filter: all claims, whole months, and months cut on both sides.
_RANGES = {"all": (None, None), "months": ("1995-02-01", "1996-11-30"), "days": ("1994-03-17", "1997-08-05")}


def _rollup(spark, sf) -> Rollup:
    """Built at the first call of a session, then only read."""
    key = _key(spark, sf, "rollup")
    if key not in _CACHE:
        base = shared_path(spark, f"rollup/{uuid.uuid4().hex}")
        build(scored(spark, sf), base)
        _CACHE[key] = base
    return Rollup(spark, _CACHE[key])


def _in_range(name: str) -> str:
    start, end = _RANGES[name]
    return "true" if start is None else f"CAST(Accident_Date AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'"


@register("rollup_kpis", " UNION ALL ".join(f"""
SELECT '{name}' AS range, CAST(count(*) AS BIGINT) AS total_claims, round(coalesce(sum(Ultimate_Claim_Amount), 0), 2) AS total_exposure,
  round(avg(Ultimate_Claim_Amount), 4) AS average_claim, round(median(Ultimate_Claim_Amount), 4) AS median_claim,
  round(max(Ultimate_Claim_Amount), 4) AS max_claim, CAST(count(*) FILTER (Ultimate_Claim_Amount >= 30000) AS BIGINT) AS high_severity_count
FROM scored WHERE {_in_range(name)}""" for name in _RANGES))
def q_rollup_kpis(spark, sf):
    """G1 and G3 for three date ranges from the day-level rollup, the exact median included."""
    rollup, parts = _rollup(spark, sf), []
    for name, (start, end) in _RANGES.items():
        tiles = rollup.tiles(start, end).select("high_severity_count")
        parts.append(rollup.kpis(start, end).crossJoin(tiles).withColumn("range", F.lit(name)))  # one row each
    out = functools.reduce(lambda a, b: a.unionByName(b), parts)
    return rnd(out, {"total_exposure": 2, "average_claim": 4, "median_claim": 4, "max_claim": 4})


_METRICS = {"exposure": "sum(Ultimate_Claim_Amount)", "volume": "count(Policy_ID)",
            "severity": "100.0E0 * count(*) FILTER (Ultimate_Claim_Amount > 15000) / count(*)",
            "efficiency": "avg(abs(Ultimate_Claim_Amount - Predictions))"}


@register("rollup_monthly", "s AS (" + " UNION ALL ".join(f"""
SELECT '{name}' AS range, '{metric}' AS metric, CAST(date_trunc('month', Accident_Date) AS DATE) AS m, CAST({sql} AS DOUBLE) AS value
FROM scored WHERE {_in_range(name)} GROUP BY 3""" for name in _RANGES for metric, sql in _METRICS.items()) + """)
SELECT range, metric, strftime(m, '%Y-%m-%d') AS Month, round(value, 2) AS value,
  round(avg(value) OVER (PARTITION BY range, metric ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving_avg FROM s""")
def q_rollup_monthly(spark, sf):
    """G4-G7 with their 3-month means for three date ranges from the day-level rollup."""
    rollup = _rollup(spark, sf)
    parts = [rollup.monthly(metric, start, end).withColumn("value", F.col("value").cast("double"))
             .withColumns({"range": F.lit(name), "metric": F.lit(metric)}) for name, (start, end) in _RANGES.items() for metric in _METRICS]
    return iso(rnd(functools.reduce(lambda a, b: a.unionByName(b), parts), {"value": 2, "moving_avg": 2}), "Month")


@register("rollup_trend", " UNION ALL ".join(f"""
SELECT '{name}' AS range, strftime(CAST(date_trunc('month', Accident_Date) AS DATE), '%Y-%m-%d') AS Month,
  CAST(count(DISTINCT Policy_ID) AS BIGINT) AS Volume, round(sum(Ultimate_Claim_Amount), 2) AS Total_Amount
FROM scored WHERE {_in_range(name)} GROUP BY 2""" for name in _RANGES))
def q_rollup_trend(spark, sf):
    """G11 for three date ranges from the rollup: exact distinct policies, also of months cut by the range."""
    rollup = _rollup(spark, sf)
    parts = [rollup.trend(start, end).withColumn("range", F.lit(name)) for name, (start, end) in _RANGES.items()]
    return iso(rnd(functools.reduce(lambda a, b: a.unionByName(b), parts), {"Total_Amount": 2}), "Month")
