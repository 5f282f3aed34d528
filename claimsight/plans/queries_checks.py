"""Registered queries whose models SQL can reproduce, and the entries run end to end.

A linear model without penalty on one feature is a least-squares line; a tree of depth 1 on a
two-valued feature is the mean label of each value.  With those settings the same training, tuning, scoring,
comparison and promotion code as anywhere else has an exact answer in SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from claimsight.operators import explain as X
from claimsight.operators import ml as ML
from claimsight.operators.features import estimate_features, lost_dates, parse_dates
from claimsight.operators.filters import sample_n
from claimsight.operators.portfolio import monthly_exposure
from claimsight.operators.split import train_test_split
from claimsight.plans.catalog import iso, prepared, register, rnd, scored
from claimsight.plans.oracle import severity_sql
from claimsight.plans.prepare import prepare_data, score_upload, train_and_promote
from claimsight.session import shared_path
from claimsight.sources import artifacts as A
from claimsight.sources.files import append_prediction_log, export_csv
from claimsight.sources.tables import fixture_claims, fixture_policies
from claimsight.streaming.arrivals import UPLOAD_COLUMNS

LINE = {"numeric": ["Estimated_Claim_Amount"], "categorical": []}
LINE_PARAMS = {"regParam": 0.0, "elasticNetParam": 0.0, "maxIter": 100}
FLAG = {"numeric": [], "categorical": ["High_Risk_Driver"]}
STUMPS = {"random_forest": {"numTrees": 1, "maxDepth": 1, "bootstrap": False},
          "gradient_boosting": {"maxIter": 1, "maxDepth": 1},
          "hist_boosting": {"maxIter": 1, "maxDepth": 1, "maxBins": 128}}
#: A penalty that leaves the intercept only, and a stump: two models with exact and different answers.
RIVALS = {"elastic_net": {"regParam": 1e6, "elasticNetParam": 1.0, "maxIter": 50},
          "gradient_boosting": {"maxIter": 1, "maxDepth": 1}}


def _dir(spark, what: str) -> str:
    return shared_path(spark, f"{what}/{uuid.uuid4().hex}")


_LINE_SQL = """
fit AS (SELECT regr_intercept(ln(1 + Ultimate_Claim_Amount), Estimated_Claim_Amount) AS a,
          regr_slope(ln(1 + Ultimate_Claim_Amount), Estimated_Claim_Amount) AS b FROM split WHERE split = 'train'),
line AS (SELECT s.*, a + b * Estimated_Claim_Amount AS lp, exp(a + b * Estimated_Claim_Amount) - 1 AS p FROM split s CROSS JOIN fit)"""


@register("score_least_squares", _LINE_SQL + f"""
SELECT Claim_ID, round(p, 3) AS Predictions, {severity_sql('p')} AS Severity, round(p * 1.15E0, 3) AS Recommended_Reserve FROM line""")
def q_score_least_squares(spark, sf):
    """Elastic net without penalty, trained and applied to every claim (M5, M9)."""
    df = prepared(spark, sf)
    tm = ML.fit_model(train_test_split(df)[0], "elastic_net", LINE_PARAMS, **LINE)
    out = ML.score(df, tm.model).select("Claim_ID", "Predictions", "Severity", "Recommended_Reserve")
    return rnd(out, {"Predictions": 3, "Recommended_Reserve": 3})


@register("report_least_squares", _LINE_SQL + """
SELECT round(1 - sum(power(Ultimate_Claim_Amount - p, 2)) / (var_pop(Ultimate_Claim_Amount) * count(*)), 6) AS r2,
  round(sqrt(avg(power(ln(1 + Ultimate_Claim_Amount) - lp, 2))), 8) AS rmsle,
  round(avg(abs(Ultimate_Claim_Amount - p)), 2) AS mae,
  round(100 * avg(abs(Ultimate_Claim_Amount - p) / greatest(abs(Ultimate_Claim_Amount), 2.220446049250313e-16)), 5) AS mape_pct
FROM line WHERE split = 'test'""")
def q_report_least_squares(spark, sf):
    """Report of the least-squares model on the test split."""
    train, test = train_test_split(prepared(spark, sf))
    tm = ML.fit_model(train, "elastic_net", LINE_PARAMS, **LINE)
    return rnd(ML.model_report(test, tm.model), {"r2": 6, "rmsle": 8, "mae": 2, "mape_pct": 5})


@register("train_stumps", """
g AS (SELECT High_Risk_Driver, avg(ln(1 + Ultimate_Claim_Amount)) AS lp FROM split WHERE split = 'train' GROUP BY 1)
SELECT m.model, g.High_Risk_Driver, CAST(count(*) AS BIGINT) AS claims, round(max(exp(lp) - 1), 4) AS prediction
FROM split s JOIN g ON g.High_Risk_Driver = s.High_Risk_Driver
CROSS JOIN (VALUES ('random_forest'), ('gradient_boosting'), ('hist_boosting')) m(model) GROUP BY 1, 2""")
def q_train_stumps(spark, sf):
    """One tree of depth 1 of each tree model on one two-valued feature: the group means (M6, M7, M8)."""
    df = prepared(spark, sf)
    train, _ = train_test_split(df)
    out = None
    for name, params in STUMPS.items():
        tm = ML.fit_model(train, name, params, **FLAG)
        part = (ML.score(df, tm.model).groupBy("High_Risk_Driver")
                .agg(F.count(F.lit(1)).alias("claims"), F.max("Predictions").alias("prediction")).withColumn("model", F.lit(name)))
        out = part if out is None else out.unionByName(part)
    return rnd(out, {"prediction": 4})


@register("tune_least_squares", """
f AS (SELECT ln(1 + Ultimate_Claim_Amount) AS ly, Estimated_Claim_Amount AS x,
        CAST('0x' || substr(md5(CAST(Claim_ID AS VARCHAR) || '#fold'), 1, 15) AS BIGINT) % 3 AS fold FROM split WHERE split = 'train'),
m AS (SELECT k, regr_intercept(ly, x) AS a, regr_slope(ly, x) AS b FROM f CROSS JOIN range(3) t(k) WHERE fold <> k GROUP BY k),
e AS (SELECT m.k, fold = m.k AS held, power(a + b * x - ly, 2) AS se,
        CASE WHEN abs(exp(ly) - 1) + abs(exp(a + b * x) - 1) <> 0
          THEN 2 * abs(exp(a + b * x) - exp(ly)) / (abs(exp(ly) - 1) + abs(exp(a + b * x) - 1)) END AS sm FROM f CROSS JOIN m),
c AS (SELECT k, sqrt(avg(se) FILTER (held)) AS v1, avg(sm) FILTER (held) AS v2, sqrt(avg(se) FILTER (NOT held)) AS t1,
        avg(sm) FILTER (NOT held) AS t2 FROM e GROUP BY k)
SELECT CAST(count(*) AS BIGINT) AS folds, round(avg(v1), 7) AS cv_rmsle, round(avg(v2), 7) AS cv_smape,
  round(avg(t1), 7) AS train_rmsle, round(avg(t2), 7) AS train_smape FROM c""")
def q_tune_least_squares(spark, sf):
    """Cross-validation of one grid point over 3 MD5 folds: RMSLE and SMAPE, held out and training."""
    train, _ = train_test_split(prepared(spark, sf))
    grid = {k: [v] for k, v in LINE_PARAMS.items()}
    _, table = ML.tune(train, "elastic_net", grid, folds=3, train_scores=True, **LINE)
    out = table.drop("params").withColumn("folds", F.lit(3).cast("long"))
    return rnd(out, {c: 7 for c in ("cv_rmsle", "cv_smape", "train_rmsle", "train_smape")})


_RIVALS_SQL = """
one AS (SELECT avg(ln(1 + Ultimate_Claim_Amount)) AS lp FROM split WHERE split = 'train'),
g AS (SELECT High_Risk_Driver, avg(ln(1 + Ultimate_Claim_Amount)) AS lp FROM split WHERE split = 'train' GROUP BY 1),
t AS (SELECT 'elastic_net' AS model, s.*, one.lp FROM split s CROSS JOIN one
      UNION ALL BY NAME SELECT 'gradient_boosting' AS model, s.*, g.lp FROM split s JOIN g ON g.High_Risk_Driver = s.High_Risk_Driver),
k AS (SELECT model, avg(power(ln(1 + Ultimate_Claim_Amount) - lp, 2)) AS mse_log, avg(power(Ultimate_Claim_Amount - exp(lp) + 1, 2)) AS mse,
        avg(abs(Ultimate_Claim_Amount - exp(lp) + 1)) AS mae,
        1 - sum(power(Ultimate_Claim_Amount - exp(lp) + 1, 2)) / (var_pop(Ultimate_Claim_Amount) * count(*)) AS r2
      FROM t WHERE split = 'test' GROUP BY model),
o AS (SELECT *, row_number() OVER (ORDER BY r2 DESC, model) AS place FROM k)"""


@register("rank_models", _RIVALS_SQL + """
SELECT CAST(place AS INT) AS place, model, round(mse_log, 7) AS mse_log, round(sqrt(mse_log), 7) AS rmse_log,
  round(sqrt(mse), 2) AS rmse, round(mae, 2) AS mae, round(r2, 7) AS r2, round(sqrt(mse_log), 7) AS rmsle FROM o""")
def q_rank_models(spark, sf):
    """Retraining: split, train two models, rank the runs by R2, errors on both scales."""
    _, table = ML.retrain(prepared(spark, sf), list(RIVALS), RIVALS, **FLAG)
    rows = [(i + 1, *[r[c] for c in ("model", "mse_log", "rmse_log", "rmse", "mae", "r2", "rmsle")]) for i, r in enumerate(table.collect())]
    out = spark.createDataFrame(rows, "place int, model string, mse_log double, rmse_log double, rmse double, mae double, r2 double, rmsle double")
    return rnd(out, {"mse_log": 7, "rmse_log": 7, "rmse": 2, "mae": 2, "r2": 7, "rmsle": 7})


@register("promoted_scores", _RIVALS_SQL + """
SELECT (SELECT model FROM o WHERE place = 1) AS source, t.High_Risk_Driver, CAST(count(*) AS BIGINT) AS claims,
  round(max(exp(t.lp) - 1), 3) AS prediction
FROM t WHERE t.model = (SELECT model FROM o WHERE place = 1) GROUP BY t.High_Risk_Driver""")
def q_promoted_scores(spark, sf):
    """Entry 2: train, save, promote the best; load the promoted model and score with it."""
    base = _dir(spark, "models")
    df = prepared(spark, sf)
    train_and_promote(spark, df, base, list(RIVALS), RIVALS, **FLAG)
    record = A.list_models(spark, base).where("name = 'promoted'").first()
    model = A.load_model(spark, base, "promoted")
    out = ML.score(df, model).groupBy("High_Risk_Driver").agg(F.count(F.lit(1)).alias("claims"), F.max("Predictions").alias("prediction"))
    return rnd(out.withColumn("source", F.lit(record["params"]["source"])), {"prediction": 3})


@register("prepare_from_csv", """
SELECT Claim_Type, CAST(count(*) AS BIGINT) AS claims, round(sum(Estimated_Claim_Amount), 1) AS estimate, CAST(sum(Driver_Age) AS BIGINT) AS ages,
  CAST(count(*) FILTER (WHERE Early_FNOL = 'Yes') AS BIGINT) AS early, (SELECT CAST(count(*) AS BIGINT) FROM features) AS n_rows
FROM features GROUP BY Claim_Type""")
def q_prepare_from_csv(spark, sf):
    """Entry 1: CSV files with differing column order to a versioned table, read back with its metadata."""
    base = _dir(spark, "entry")
    claims, policies = fixture_claims(spark, sf), fixture_policies(spark, sf)
    half = F.col("Claim_ID") % 2 == 0
    export_csv(claims.where(half), f"{base}/claims", mode="append")
    export_csv(claims.where(~half).select(*reversed(claims.columns)), f"{base}/claims", mode="append")
    export_csv(policies, f"{base}/policies")
    version = prepare_data(spark, f"{base}/claims", f"{base}/policies", f"{base}/out")
    n = A.read_metadata(spark, f"{base}/out").where(F.col("version") == version).select("n_rows")
    out = A.read_processed(spark, f"{base}/out").groupBy("Claim_Type").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("Estimated_Claim_Amount").alias("estimate"),
        F.sum(F.col("Driver_Age").cast("long")).alias("ages"), F.count_if(F.col("Early_FNOL") == "Yes").alias("early"))
    return rnd(out.crossJoin(n.limit(1)), {"estimate": 1})  # one row of metadata


@register("score_upload", _LINE_SQL + f"""
SELECT CAST(Claim_ID AS VARCHAR) AS Claim_ID, round(p, 3) AS Predictions, {severity_sql('p')} AS Severity,
  round(Estimate_Relative_to_Type, 8) AS Estimate_Relative_to_Type FROM line""")
def q_score_upload(spark, sf):
    """Batch upload: a CSV of claims through a saved model to enriched predictions."""
    base = _dir(spark, "batch")
    df = prepared(spark, sf)
    tm = ML.fit_model(train_test_split(df)[0], "elastic_net", LINE_PARAMS, **LINE)
    A.save_model(spark, tm.model, f"{base}/models", "line", tm.params)
    export_csv(df.select(*UPLOAD_COLUMNS), f"{base}/in")
    means = df.select("Claim_Type", "Type_Avg_Estimate").distinct()
    out = score_upload(spark, f"{base}/in", f"{base}/models", "line", "2026-01-01 00:00:00", means)
    return rnd(out.select("Claim_ID", "Predictions", "Severity", "Estimate_Relative_to_Type"), {"Predictions": 3, "Estimate_Relative_to_Type": 8})


@register("prediction_log", """
SELECT Severity, CAST(2 * count(*) AS BIGINT) AS logged, CAST(count(DISTINCT Claim_ID) AS BIGINT) AS claims FROM scored GROUP BY Severity""")
def q_prediction_log(spark, sf):
    """Predictions appended twice to the log and read back."""
    path = _dir(spark, "log")
    out = scored(spark, sf).select("Claim_ID", "Predictions", "Severity")
    for _ in range(2):
        append_prediction_log(out, path)
    log = spark.read.parquet(path).where("scored_at IS NOT NULL")
    return log.groupBy("Severity").agg(F.count(F.lit(1)).alias("logged"), F.count_distinct("Claim_ID").alias("claims"))


@register("null_claim_types", """
c AS (SELECT Claim_ID, Estimated_Claim_Amount, CASE WHEN Claim_ID % 7 <> 0 THEN Claim_Type END AS Claim_Type FROM features),
m AS (SELECT Claim_Type, avg(Estimated_Claim_Amount) AS mean FROM c WHERE Claim_Type IS NOT NULL GROUP BY 1)
SELECT c.Claim_ID, round(mean, 4) AS Type_Avg_Estimate, round(Estimated_Claim_Amount / mean, 8) AS Estimate_Relative_to_Type
FROM c LEFT JOIN m USING (Claim_Type)""")
def q_null_claim_types(spark, sf):
    """Claims and averages with NULL types: no average for them, no error, no extra rows."""
    df = prepared(spark, sf).withColumn("Claim_Type", F.when(F.col("Claim_ID") % 7 != 0, F.col("Claim_Type")))
    means = df.groupBy("Claim_Type").agg(F.avg("Estimated_Claim_Amount").alias("Type_Avg_Estimate"))  # has a NULL key
    out = estimate_features(df.drop("Type_Avg_Estimate"), type_means=means)
    return rnd(out.select("Claim_ID", "Type_Avg_Estimate", "Estimate_Relative_to_Type"), {"Type_Avg_Estimate": 4, "Estimate_Relative_to_Type": 8})


@register("monthly_exposure_malformed", """
m AS (SELECT CAST(date_trunc('month', Accident_Date) AS DATE) AS Month, sum(Ultimate_Claim_Amount) AS value
      FROM scored WHERE Claim_ID % 11 <> 0 GROUP BY 1)
SELECT strftime(Month, '%Y-%m-%d') AS Month, round(value, 2) AS value,
  round(avg(value) OVER (ORDER BY Month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving_avg FROM m""")
def q_monthly_exposure_malformed(spark, sf):
    """Claims whose date is malformed text have no month and enter no mean."""
    text = F.when(F.col("Claim_ID") % 11 != 0, F.col("Accident_Date").cast("string")).otherwise("not a date")
    df = parse_dates(scored(spark, sf).withColumn("Accident_Date", text), ["Accident_Date"])
    return iso(rnd(monthly_exposure(df), {"value": 2, "moving_avg": 2}), "Month")


@register("parse_date_formats", """
SELECT Claim_ID % 4 AS kind, CAST(count(*) AS BIGINT) AS claims,
  CAST(sum(CASE WHEN Claim_ID % 4 <> 3 THEN date_diff('day', DATE '1970-01-01', CAST(Accident_Date AS DATE)) ELSE 0 END) AS BIGINT) AS days,
  (SELECT CAST(count(*) AS BIGINT) FROM features WHERE Claim_ID % 4 = 3) AS lost
FROM features GROUP BY 1""")
def q_parse_date_formats(spark, sf):
    """Dates in ISO and two other formats, and text that is none of them, which is counted (F1)."""
    day, formats = F.col("Accident_Date").cast("date"), ["MM/dd/yyyy", "MMM d, yyyy"]
    kind = F.col("Claim_ID") % 4
    text = (F.when(kind == 0, day.cast("string")).when(kind == 1, F.date_format(day, formats[0]))
            .when(kind == 2, F.date_format(day, formats[1])).otherwise("soon"))
    df = prepared(spark, sf).select("Claim_ID", text.alias("Accident_Date"))
    lost = lost_dates(df, formats=formats).select(F.col("Accident_Date").alias("lost"))
    days = F.datediff(F.col("Accident_Date").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    out = (parse_dates(df, formats=formats).groupBy((F.col("Claim_ID") % 4).alias("kind"))
           .agg(F.count(F.lit(1)).alias("claims"), F.coalesce(F.sum(days), F.lit(0)).alias("days")))
    return out.crossJoin(lost)  # one row


@register("ale_all_features", """
r AS (SELECT Driver_Age, Estimated_Claim_Amount FROM features),
v AS (SELECT 'Driver_Age' AS feature, CAST(Driver_Age AS DOUBLE) AS x, Estimated_Claim_Amount AS z FROM r
      UNION ALL SELECT 'Estimated_Claim_Amount', Estimated_Claim_Amount, CAST(Driver_Age AS DOUBLE) FROM r),
w AS (SELECT feature, min(x) AS lo, (max(x) - min(x)) / 8 AS width FROM v GROUP BY feature),
d AS (SELECT v.feature, CAST(least(floor((x - lo) / width), 7) AS INT) AS bin, width * z / 1000 AS diff FROM v JOIN w USING (feature)),
p AS (SELECT feature, bin, count(*) AS n, avg(diff) AS effect FROM d GROUP BY 1, 2),
a AS (SELECT *, sum(effect) OVER (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc FROM p)
SELECT feature, bin, CAST(n AS BIGINT) AS n, round(effect, 4) AS effect,
  round(acc - sum(acc * n) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature), 4) AS ale FROM a""")
def q_ale_all_features(spark, sf):
    """ALE of an integer and a real feature of a model that multiplies them."""
    rows = prepared(spark, sf).select("Claim_ID", "Driver_Age", "Estimated_Claim_Amount")

    def product(d):
        return d.withColumn("prediction", F.col("Driver_Age") * F.col("Estimated_Claim_Amount") / 1000)

    out = X.ale_all(rows, product, ["Driver_Age", "Estimated_Claim_Amount"], bins=8, sample=None)
    return rnd(out.select("feature", "bin", "n", "effect", "ale"), {"effect": 4, "ale": 4})


# --------------------------------------------------------------------------- explanations of three interacting features
THREE = ("Driver_Age", "Vehicle_Age", "FNOL_Delay")
# Contributions are multiples of 0.01 / 32, which eight decimals show exactly.
_SAMPLES, _EXPLAINED, _BACKGROUND = 32, 3000, 100


def _product(d):
    """A model whose features interact: no feature's effect is the same in every order."""
    return d.withColumn("prediction", F.col("Driver_Age") * F.col("Vehicle_Age") / 10 + F.col("FNOL_Delay") * F.col("Driver_Age") / 100
                        + F.col("Vehicle_Age"))


def _three_sql() -> str:
    def model(values):
        a, v, d = values
        return f"(({a}) * ({v}) / 10.0E0 + ({d}) * ({a}) / 100.0E0 + ({v}))"

    def number(*parts):
        text = " || '-' || ".join(f"CAST({x} AS VARCHAR)" for x in parts)
        return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"

    parts = []
    for j, f in enumerate(THREE):
        def row(own):
            return [own if i == j else f"CASE WHEN r{i} < r{j} OR (r{i} = r{j} AND {i} < {j}) THEN x{i} ELSE b{i} END" for i in range(3)]
        parts.append(f"SELECT Claim_ID, '{f}' AS feature, sum({model(row(f'x{j}'))} - {model(row(f'b{j}'))}) / {_SAMPLES} AS contribution "
                     f"FROM p GROUP BY Claim_ID")
    xs = ", ".join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(THREE))
    bs = ", ".join(f"CAST({f} AS DOUBLE) AS b{i}" for i, f in enumerate(THREE))
    ranks = ", ".join(f"{number('rs.Claim_ID', 's', i, 43)} AS r{i}" for i in range(3))
    return f"""
bg AS (SELECT {bs} FROM split WHERE split = 'train' ORDER BY md5(CAST(Claim_ID AS VARCHAR) || '#42'), Claim_ID LIMIT {_BACKGROUND}),
bgi AS (SELECT *, row_number() OVER (ORDER BY b0, b1, b2) - 1 AS bidx FROM bg),
nb AS (SELECT count(*) AS n FROM bgi),
r AS (SELECT Claim_ID, {xs} FROM split WHERE split = 'test' ORDER BY md5(CAST(Claim_ID AS VARCHAR) || '#42'), Claim_ID LIMIT {_EXPLAINED}),
rs AS (SELECT r.*, t.s FROM r CROSS JOIN range({_SAMPLES}) t(s)),
p AS (SELECT rs.*, b0, b1, b2, {ranks} FROM rs CROSS JOIN nb JOIN bgi ON bgi.bidx = {number('rs.Claim_ID', 's', 42)} % nb.n),
c AS ({' UNION ALL '.join(parts)}),
i AS (SELECT feature, avg(abs(contribution)) AS importance FROM c GROUP BY feature ORDER BY importance DESC, feature LIMIT 2)"""


_THREE_SQL = _three_sql()


def _three(spark, sf):
    train, test = train_test_split(prepared(spark, sf))
    columns = [F.col("Claim_ID"), *[F.col(f).cast("double").alias(f) for f in THREE]]
    rows = sample_n(test, _EXPLAINED).select(*columns)
    return rows, X.shapley_sampling(rows, train.select(*columns), _product, THREE, samples=_SAMPLES, background_rows=_BACKGROUND)


@register("shapley_three_features", _THREE_SQL + """
SELECT Claim_ID, feature, round(contribution, 8) AS contribution FROM c""")
def q_shapley_three_features(spark, sf):
    """Sampled Shapley values of three interacting features: the order of the features matters."""
    return rnd(_three(spark, sf)[1], {"contribution": 8})


@register("importance_top_two", _THREE_SQL + """
SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INT) AS place, feature, round(importance, 6) AS importance FROM i""")
def q_importance_top_two(spark, sf):
    """The two most important of three features, in order."""
    top = X.global_importance(_three(spark, sf)[1], k=2).collect()
    out = spark.createDataFrame([(i + 1, r["feature"], r["importance"]) for i, r in enumerate(top)], "place int, feature string, importance double")
    return rnd(out, {"importance": 6})


@register("points_top_two", _THREE_SQL + f"""
SELECT c.Claim_ID, c.feature, round(contribution, 8) AS contribution,
  round(CASE c.feature {' '.join(f"WHEN '{f}' THEN x{j}" for j, f in enumerate(THREE))} END, 6) AS value
FROM c JOIN i ON i.feature = c.feature JOIN r ON r.Claim_ID = c.Claim_ID""")
def q_points_top_two(spark, sf):
    """Contribution and value of the two most important of three features."""
    rows, contributions = _three(spark, sf)
    out = X.contribution_points(contributions, rows, k=2).withColumn("value", F.col("value").cast("double"))
    return rnd(out, {"contribution": 8, "value": 6})


@register("waterfall_three_features", _THREE_SQL + """
, z AS (SELECT Claim_ID, feature, contribution, row_number() OVER (PARTITION BY Claim_ID ORDER BY round(abs(contribution), 9) DESC, feature) AS step
      FROM c WHERE abs(contribution) > 1e-9)
SELECT Claim_ID, CAST(step AS INT) AS step, feature, round(contribution, 8) AS contribution FROM z
UNION ALL
SELECT Claim_ID, CAST(count(*) + 1 AS INT), 'Prediction', round(sum(contribution), 8) FROM z GROUP BY Claim_ID""")
def q_waterfall_three_features(spark, sf):
    """Bars of three contributions per claim in order of size, then the total (K3)."""
    exact = _three(spark, sf)[1].where("abs(contribution) > 1e-9").withColumn("contribution", F.round("contribution", 9))
    out = X.contribution_waterfall(exact).withColumn("step", F.col("step").cast("int"))
    return rnd(out, {"contribution": 8})


# --------------------------------------------------------------------------- explanations with known errors, linear pipelines
_TOLERANCE, _FIRST, _MOST = 3.0, 8, 32


def _adaptive_sql() -> str:
    """Antithetic pairs of orders over three features; a claim stops at 8, 16 or 32 pairs."""
    def number(*parts):
        text = " || '-' || ".join(f"CAST({x} AS VARCHAR)" for x in parts)
        return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"

    def model(a, v, d):
        return f"(({a}) * ({v}) / 10.0E0 + ({d}) * ({a}) / 100.0E0 + ({v}))"

    def effect(j, back):
        """Model with feature j minus without: features before j (after j, backwards) have the claim's values."""
        def row(own):
            sign = "NOT " if back else ""
            return [own if i == j else f"CASE WHEN {sign}(t{i} < t{j} OR (t{i} = t{j} AND {i} < {j})) THEN x{i} ELSE b{i} END" for i in range(3)]
        return f"({model(*row(f'x{j}'))} - {model(*row(f'b{j}'))})"

    xs = ", ".join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(THREE))
    bs = ", ".join(f"CAST({f} AS DOUBLE) AS b{i}" for i, f in enumerate(THREE))
    tickets = ", ".join(f"{number('rs.Claim_ID', 's', i, 43)} AS t{i}" for i in range(3))
    effects = " UNION ALL ".join(f"SELECT Claim_ID, s, '{f}' AS feature, ({effect(j, False)} + {effect(j, True)}) / 2 AS v, {model('b0', 'b1', 'b2')} AS b "
                                 f"FROM p" for j, f in enumerate(THREE))
    return f"""
bgi AS (SELECT {bs}, row_number() OVER (ORDER BY md5(CAST(Claim_ID AS VARCHAR) || '#42'), Claim_ID) - 1 AS bidx FROM split WHERE split = 'train'),
nb AS (SELECT count(*) AS n FROM bgi),
r AS (SELECT Claim_ID, {xs} FROM split WHERE split = 'test' ORDER BY md5(CAST(Claim_ID AS VARCHAR) || '#42'), Claim_ID LIMIT 3000),
rs AS (SELECT r.*, t.s FROM r CROSS JOIN range({_MOST}) t(s)),
p AS (SELECT rs.*, b0, b1, b2, {tickets} FROM rs CROSS JOIN nb JOIN bgi ON bgi.bidx = {number('rs.Claim_ID', 's', 42)} % nb.n),
v AS ({effects}),
g AS (SELECT Claim_ID, feature, k, avg(v) AS c, sqrt(var_samp(v) / k) AS se, avg(b) AS base
      FROM v JOIN (SELECT unnest([8, 16, 32]) AS k) ON s < k GROUP BY Claim_ID, feature, k),
stop AS (SELECT Claim_ID, coalesce(min(k) FILTER (worst <= {_TOLERANCE}), {_MOST}) AS k FROM (
           SELECT Claim_ID, k, max(se) AS worst FROM g GROUP BY Claim_ID, k) GROUP BY Claim_ID)"""


@register("shapley_with_errors", _adaptive_sql() + """
SELECT g.Claim_ID, g.feature, CAST(g.k AS BIGINT) AS pairs, round(c, 8) AS contribution, round(se, 6) AS std_error, round(base, 8) AS base
FROM g JOIN stop USING (Claim_ID, k)""")
def q_shapley_with_errors(spark, sf):
    """Shapley values of 3,000 test claims against the whole training set, until the standard error is small or 32 pairs are used."""
    train, test = train_test_split(prepared(spark, sf))
    columns = [F.col("Claim_ID"), *[F.col(f).cast("double").alias(f) for f in THREE]]
    out = X.shapley_adaptive(sample_n(test, 3000).select(*columns), train.select(*columns), _product, THREE, _TOLERANCE,
                             first_pairs=_FIRST, most_pairs=_MOST)
    return rnd(out.drop("prediction"), {"contribution": 8, "std_error": 6, "base": 8})


_LINEAR = {"numeric": ["Estimated_Claim_Amount", "Driver_Age"], "categorical": ["Claim_Type"]}


@register("shapley_linear_pipeline", """
t AS (SELECT Claim_ID, split, ln(1 + Ultimate_Claim_Amount) AS y, Estimated_Claim_Amount AS x, CAST(Driver_Age AS DOUBLE) AS z, Claim_Type AS g FROM split),
gm AS (SELECT g, avg(x) AS mx, avg(z) AS mz, avg(y) AS my FROM t WHERE split = 'train' GROUP BY g),
n AS (SELECT sum((x - mx) * (x - mx)) AS xx, sum((x - mx) * (z - mz)) AS xz, sum((z - mz) * (z - mz)) AS zz,
             sum((x - mx) * (y - my)) AS xy, sum((z - mz) * (y - my)) AS zy FROM t JOIN gm USING (g) WHERE split = 'train'),
b AS (SELECT (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM n),
a AS (SELECT g, my - bx * mx - bz * mz AS level FROM gm CROSS JOIN b),
m AS (SELECT avg(x) AS ax, avg(z) AS az, avg(level) AS al FROM t JOIN a USING (g) WHERE split = 'train'),
c AS (SELECT Claim_ID, 'Estimated_Claim_Amount' AS feature, bx * (x - ax) AS contribution FROM t CROSS JOIN b CROSS JOIN m WHERE split = 'test'
      UNION ALL SELECT Claim_ID, 'Driver_Age', bz * (z - az) FROM t CROSS JOIN b CROSS JOIN m WHERE split = 'test'
      UNION ALL SELECT Claim_ID, 'Claim_Type', level - al FROM t JOIN a USING (g) CROSS JOIN m WHERE split = 'test')
SELECT Claim_ID, feature, round(contribution, 5) AS contribution FROM c""")
def q_shapley_linear_pipeline(spark, sf):
    """Exact contributions of two scaled numbers and a one-hot category through a fitted least-squares pipeline."""
    train, test = train_test_split(prepared(spark, sf))
    tm = ML.fit_model(train, "elastic_net", {"regParam": 0.0, "elasticNetParam": 0.0, "tol": 1e-13}, **_LINEAR)
    return rnd(X.shapley_linear_model(test, tm.model, train), {"contribution": 5})
