"""Portfolio analytics.

Every query is one (or a few) distributed aggregates over the scored claims
table with map-side partial aggregation; results are small (one row, one row
per month, one row per category).  Windows are only applied after
aggregation, where the input is already bounded by the number of groups.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight import config as K
from claimsight.functions import dates as D
from claimsight.functions import rules as R
from claimsight.functions.quantiles import approx_quantiles, exact_quantiles
from claimsight.operators import metrics as M
from claimsight.operators.joins import monthly_high_share

ULT = "Ultimate_Claim_Amount"
EST = "Estimated_Claim_Amount"


# --------------------------------------------------------------------------- G1-G3
def portfolio_kpis(df: DataFrame, amount: str = ULT, median_method: str = "exact") -> DataFrame:
    """Claims, total exposure, mean, median and max of ``amount`` (G1)."""
    q = (exact_quantiles if median_method == "exact" else approx_quantiles)(df, [amount], [0.5])
    med = q[amount][0.5]
    return df.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total_exposure"),
        F.avg(amount).alias("average_claim"),
        F.lit(med).cast("double").alias("median_claim"),
        F.max(amount).alias("max_claim"),
    )


def severity_distribution(df: DataFrame, amount: str = ULT) -> DataFrame:
    """Count of claims per severity level of ``amount``."""
    return df.groupBy(R.severity(amount).alias("Severity")).agg(F.count(F.lit(1)).alias("count"))


def dashboard_tiles(df: DataFrame, amount: str = ULT, high: float = K.HIGH_SEVERITY) -> DataFrame:
    """The four dashboard tiles in one pass over the table."""
    return df.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total_exposure"),
        F.avg(amount).alias("average_claim"),
        F.count_if(F.col(amount) >= high).alias("high_severity_count"),
    )


# --------------------------------------------------------------------------- G4-G7 + W2
def with_moving_average(series: DataFrame, order_col: str = "Month", value: str = "value",
                        rows: int = 3) -> DataFrame:
    """Trailing ``rows``-row mean, at least one row.

    ``series`` is already one row per month, so the single-partition window
    holds as many rows as there are months, not claims.
    """
    w = Window.orderBy(order_col).rowsBetween(-(rows - 1), 0)
    return series.withColumn("moving_avg", F.avg(value).over(w))


def _monthly(df: DataFrame, agg: Column) -> DataFrame:
    # A claim without a date has no month; a NULL month would sort first and enter the means.
    dated = df.where(F.col("Accident_Date").isNotNull())
    series = dated.groupBy(D.month_start("Accident_Date").alias("Month")).agg(agg.alias("value"))
    return with_moving_average(series)


def monthly_exposure(df: DataFrame, amount: str = ULT) -> DataFrame:
    """Sum of ``amount`` by accident month, with its 3-month mean."""
    return _monthly(df, F.sum(amount))


def monthly_volume(df: DataFrame, key: str = "Policy_ID") -> DataFrame:
    """Non-NULL policy ids by month."""
    return _monthly(df, F.count(key))


def monthly_high_severity_pct(df: DataFrame, threshold: float = K.MEDIUM_SEVERITY,
                              amount: str = ULT) -> DataFrame:
    """Percent of claims above ``threshold`` by month (G6, via J3)."""
    series = monthly_high_share(df.where(F.col("Accident_Date").isNotNull())
                                .withColumn("Month", D.month_start("Accident_Date")),
                                "Month", amount, threshold)
    return with_moving_average(series)


def monthly_mae(df: DataFrame, actual: str = ULT, prediction: str = "Predictions") -> DataFrame:
    """Mean absolute prediction error by month."""
    return _monthly(df, F.avg(F.abs(F.col(actual) - F.col(prediction))))


def monthly_metric(df: DataFrame, metric: str, threshold: float = K.MEDIUM_SEVERITY) -> DataFrame:
    """Dispatch of the dashboard metric selector; no metric gives G2."""
    if metric == "exposure":
        return monthly_exposure(df)
    if metric == "volume":
        return monthly_volume(df)
    if metric == "severity":
        return monthly_high_severity_pct(df, threshold)
    if metric == "efficiency":
        return monthly_mae(df)
    return severity_distribution(df)


# --------------------------------------------------------------------------- G8-G10
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per non-NULL value, largest first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)))


def claims_by_type(df: DataFrame) -> DataFrame:
    """G8."""
    return value_counts(df, "Claim_Type")


def batch_severity_counts(df: DataFrame) -> DataFrame:
    """Counts of predicted severity."""
    return value_counts(df, "Severity")


def amount_histogram(df: DataFrame, col: str = ULT, bins: int = 40) -> DataFrame:
    """Equal-width histogram between min and max, last bin closed.

    The range is one aggregate; the binning is a narrow projection followed by
    a ``groupBy`` with at most ``bins`` groups.
    """
    rng = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = rng["lo"], rng["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_start double, bin_end double, count bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (df.where(F.col(col).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumns({"bin_start": F.lit(lo) + F.col("bin") * F.lit(width),
                          "bin_end": F.lit(lo) + (F.col("bin") + 1) * F.lit(width)})
            .select("bin", "bin_start", "bin_end", "count"))


# --------------------------------------------------------------------------- G11-G13
def trend_volume(df: DataFrame) -> DataFrame:
    """By month: distinct policies and total amount; claims without a date have no month."""
    return (df.where(F.col("Accident_Date").isNotNull())
            .groupBy(D.month_start("Accident_Date").alias("Month"))
            .agg(F.count_distinct("Policy_ID").alias("Volume"), F.sum(ULT).alias("Total_Amount")))


_DIM_COLUMNS = {"claim_type": "Claim_Type", "weather": "Weather_Condition", "severity": "Severity"}


def analysis_by_dimension(df: DataFrame, dim: str) -> DataFrame:
    """Volume, total and average by a dimension (G12); ``Volume`` gives G11.

    Age dimensions are banded with left-closed intervals; NULL groups dropped.
    """
    if dim == "Volume":
        return trend_volume(df)
    if dim == "driver_age":
        key, kcol = "Driver_Age", R.driver_age_band("Driver_Age", right=False)
    elif dim == "vehicle_age":
        key, kcol = "Vehicle_Age", R.vehicle_age_band("Vehicle_Age", right=False)
    else:
        key = _DIM_COLUMNS.get(dim, dim)
        kcol = F.col(key)
    return (df.groupBy(kcol.alias(key)).agg(F.count("Policy_ID").alias("Volume"),
                                           F.sum(ULT).alias("Total_Amount"))
            .where(F.col(key).isNotNull())
            .withColumn("Avg_Amount", F.try_divide(F.col("Total_Amount"), F.col("Volume"))))


def reserve_adequacy(df: DataFrame, dim: str = "claim_type",
                     threshold: float = K.MEDIUM_SEVERITY) -> DataFrame:
    """Reserve adequacy by dimension (G13, with N1-N5).

    ``Volume`` groups by accident quarter; an unknown dimension falls back to
    claim type; age dimensions use right-closed bands.
    """
    if dim == "Volume":
        key, kcol = "Quarter_Year", D.quarter_label("Accident_Date")
    elif dim == "driver_age":
        key, kcol = "Driver_Age", R.driver_age_band("Driver_Age", right=True)
    elif dim == "vehicle_age":
        key, kcol = "Vehicle_Age", R.vehicle_age_band("Vehicle_Age", right=True)
    else:
        key = {"claim_type": "Claim_Type", "weather": "Weather_Condition",
               "severity": "Severity"}.get(dim, "Claim_Type")
        kcol = F.col(key)
    g = df.withColumns({
        "__gap": R.reserve_gap(), "__human": R.human_error(), "__model": R.model_error()})
    summary = (g.groupBy(kcol.alias(key)).agg(
        F.count_distinct("Policy_ID").alias("Total_Claims"),
        F.avg(ULT).alias("Avg_Ultimate"),
        F.avg("__gap").alias("Mean_Reserve_Gap"),
        F.avg("__human").alias("Avg_Human_Error"),
        F.avg("__model").alias("Avg_Model_Error"))
        .where(F.col(key).isNotNull()))
    return summary.withColumns({
        "Model_Lift_%": R.model_lift_pct("Avg_Human_Error", "Avg_Model_Error"),
        "Gap_Pct": R.gap_pct("Mean_Reserve_Gap", "Avg_Ultimate"),
        "Status": R.adequacy_status("Mean_Reserve_Gap", threshold),
    })


def adequacy_display(summary: DataFrame) -> DataFrame:
    """Text formatting of the adequacy table (N6); underscores become spaces."""
    gap = F.col("Mean_Reserve_Gap")
    out = summary.withColumns({
        "Mean_Reserve_Gap": F.concat(F.when(gap > 0, F.lit("🔴 £")).otherwise(F.lit("🟢 £")),
                                     F.format_number(gap, 0)),
        "Avg_Human_Error": R.money("Avg_Human_Error", 0),
        "Avg_Model_Error": R.money("Avg_Model_Error", 0),
        "Avg_Ultimate": R.money("Avg_Ultimate", 0),
        "Total_Claims": F.format_number(F.col("Total_Claims").cast("double"), 0),
        "Model_Lift_%": F.concat(F.col("`Model_Lift_%`").cast("string"), F.lit("%")),
        "Gap_Pct": F.concat(F.format_number("Gap_Pct", 2), F.lit("%")),
    })
    return out.select(*[F.col(f"`{c}`").alias(c.replace("_", " ")) for c in out.columns])


# --------------------------------------------------------------------------- G14-G18
def kpi_accuracy(df: DataFrame, actual: str = ULT, prediction: str = "Predictions") -> DataFrame:
    """R-squared of the predictions times 100."""
    return df.agg((M.r2(actual, prediction) * F.lit(100.0)).alias("prediction_accuracy_pct"))


def kpi_processing_days(df: DataFrame) -> DataFrame:
    """Mean whole days from accident to settlement."""
    return df.agg(F.avg(D.whole_days_between("Accident_Date", "Settlement_Date"))
                  .alias("avg_processing_days"))


def savings_projection(df: DataFrame, amount: str = ULT) -> DataFrame:
    """Reserve optimisation, fraud prevention, handling efficiency and total."""
    t = F.coalesce(F.sum(amount), F.lit(0.0))
    n = F.count(F.lit(1))
    ro = t * F.lit(K.RESERVE_OPTIMIZATION_RATE)
    fp = t * F.lit(K.FRAUD_PREVENTION_RATE)
    oe = n * F.lit(K.OPERATIONAL_SAVING_PER_CLAIM)
    return df.agg(t.alias("total_exposure"), ro.alias("reserve_optimization"),
                  fp.alias("fraud_prevention"), oe.alias("operational_efficiency"),
                  (ro + fp + oe).alias("total_savings"))


def detailed_savings(df: DataFrame, cap_cost: float = K.CAPITAL_COST_PCT,
                     labor_rate: float = K.LABOUR_RATE_PER_HOUR,
                     leakage_rate: float = K.LEAKAGE_RATE_PCT,
                     mins_saved: float = K.MINUTES_SAVED_PER_CLAIM,
                     late_hours: float = K.LATE_CLAIM_HOURS) -> DataFrame:
    """Capital release, leakage, automation and delay savings in one aggregate.

    Also the two totals the dashboard meant to show: total savings and the
    automation ROI against a monthly model cost.
    """
    ult, res, pred = F.col(ULT), F.col("Recommended_Reserve"), F.col("Predictions")
    cap = F.coalesce(F.sum(F.greatest(res - ult, F.lit(0.0))), F.lit(0.0)) * F.lit(cap_cost / 100.0)
    auto = F.count(F.lit(1)) * F.lit(mins_saved / 60.0 * labor_rate)
    human = F.coalesce(F.sum(F.abs(ult - res)), F.lit(0.0))
    model = F.coalesce(F.sum(F.abs(ult - pred)), F.lit(0.0))
    leak = F.when(human > model, (human - model) * F.lit(leakage_rate / 100.0)).otherwise(F.lit(0.0))
    delay = F.coalesce(F.sum(F.when(F.col("FNOL_Delay") > late_hours, ult)), F.lit(0.0)) \
        * F.lit(K.DELAY_MITIGATION_RATE)
    return (df.agg(cap.alias("cap_release"), leak.alias("leakage"), auto.alias("automation"),
                   delay.alias("delay_mitigation"))
            .withColumns({
                "total_savings": F.col("cap_release") + F.col("leakage") + F.col("automation")
                + F.col("delay_mitigation"),
                "automation_roi_pct": F.col("automation") / F.lit(K.MONTHLY_MODEL_COST) * F.lit(100.0)}))


def savings_summary(df: DataFrame, **kw) -> DataFrame:
    """G17 unpivoted to category, driver, impact, logic; total and ROI appended."""
    d = detailed_savings(df, **kw)

    def row(order, cat, driver, value_col, logic, fmt):
        v = F.col(value_col)
        return F.struct(F.lit(order).alias("row"), F.lit(cat).alias("Category"),
                        F.lit(driver).alias("Driver"), v.alias("value"), fmt(v).alias("Impact"),
                        F.lit(logic).alias("Logic"))

    money2 = lambda v: R.money(v, 2)
    rows = F.array(
        *[row(i + 1, cat, driver, column, logic, money2)
          for i, (cat, driver, column, logic) in enumerate(K.SAVINGS_ROWS)],
        row(5, "Total Savings", "All drivers", "total_savings", "Sum of the four categories",
            lambda v: R.money(v, 0)),
        row(6, "Automation ROI", "Severity Triage", "automation_roi_pct",
            "Automation savings / monthly model cost", R.percent),
    )
    return d.select(F.inline(rows))


# --------------------------------------------------------------------------- G19-G23
def feature_statistics(df: DataFrame, cols: Sequence[str] | None = None,
                       quantile_method: str = "exact") -> DataFrame:
    """Per numeric column: mean, median, std (n-1), min, max, q25, q75."""
    if cols is None:
        numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
        cols = [f.name for f in df.schema.fields if f.dataType.simpleString() in numeric
                or f.dataType.simpleString().startswith("decimal")]
    cols = list(cols)
    q = (exact_quantiles if quantile_method == "exact" else approx_quantiles)(df, cols, [0.25, 0.5, 0.75])
    stats = df.agg(*[F.struct(F.lit(c).alias("feature"),
                              F.avg(c).cast("double").alias("mean"),
                              F.stddev_samp(c).cast("double").alias("std"),
                              F.min(c).cast("double").alias("min"),
                              F.max(c).cast("double").alias("max")).alias(f"s{i}")
                     for i, c in enumerate(cols)])
    long = stats.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")) \
        .select("s.*")

    def qmap(p):
        pairs = []
        for c in cols:
            pairs += [F.lit(c), F.lit(q[c][p]).cast("double")]
        return F.element_at(F.create_map(*pairs), F.col("feature"))

    return long.select("feature", "mean", qmap(0.5).alias("median"), "std", "min", "max",
                       qmap(0.25).alias("q25"), qmap(0.75).alias("q75"))


def prediction_variance(preds: DataFrame, key: str = "Claim_ID", value: str = "prediction") -> DataFrame:
    """Across models per claim: mean, population std, CV % and confidence.

    Input is long (one row per claim and model).  Fewer than two predictions
    give zeros and ``Low`` confidence.
    """
    g = preds.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("m"),
                               F.stddev_pop(value).alias("s"))
    few = F.col("n") < 2
    cv = F.when(F.col("m") > 0, F.col("s") / F.col("m") * F.lit(100.0)).otherwise(F.lit(0.0))
    out = g.select(
        key, "n",
        F.when(few, F.lit(0.0)).otherwise(F.col("m")).alias("mean"),
        F.when(few, F.lit(0.0)).otherwise(F.col("s")).alias("std"),
        F.when(few, F.lit(0.0)).otherwise(cv).alias("cv"))
    return out.withColumn("confidence", F.when(few, "Low")
                          .when(F.col("cv") < K.CV_HIGH_CONFIDENCE, "High")
                          .when(F.col("cv") < K.CV_MEDIUM_CONFIDENCE, "Medium").otherwise("Low")).drop("n")


def prediction_variance_wide(df: DataFrame, cols: Sequence[str], key: str = "Claim_ID") -> DataFrame:
    """G20 when each model's prediction is a column of the same row: no shuffle.

    Mean and population std over the non-NULL predictions of the row, with
    higher-order array functions (JVM-side); same rules as the long form.
    """
    arr = F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    g = df.select(key, arr.alias("__p")).withColumn("n", F.size("__p"))
    g = g.withColumn("m", F.aggregate("__p", F.lit(0.0), lambda acc, x: acc + x) / F.col("n"))
    g = g.withColumn("s", F.sqrt(F.aggregate("__p", F.lit(0.0),
                                             lambda acc, x: acc + (x - F.col("m")) * (x - F.col("m")))
                                 / F.col("n")))
    few = F.col("n") < 2
    cv = F.when(F.col("m") > 0, F.col("s") / F.col("m") * F.lit(100.0)).otherwise(F.lit(0.0))
    out = g.select(key, "n", F.when(few, F.lit(0.0)).otherwise(F.col("m")).alias("mean"),
                   F.when(few, F.lit(0.0)).otherwise(F.col("s")).alias("std"),
                   F.when(few, F.lit(0.0)).otherwise(cv).alias("cv"))
    return out.withColumn("confidence", F.when(few, "Low")
                          .when(F.col("cv") < K.CV_HIGH_CONFIDENCE, "High")
                          .when(F.col("cv") < K.CV_MEDIUM_CONFIDENCE, "Medium").otherwise("Low")).drop("n")


def category_vocabulary(df: DataFrame, cols: Sequence[str] = K.CATEGORICAL_FEATURES) -> DataFrame:
    """Sorted distinct non-NULL values per categorical column and their encoded names."""
    cols = [c for c in cols if c in df.columns]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("e")).select("e.*").where(F.col("value").isNotNull()).distinct()
    return (long.withColumn("encoded_name", F.concat_ws("_", "feature", "value"))
            .orderBy("feature", "value"))


def hypothesis_uplift(df: DataFrame, amount: str = ULT) -> DataFrame:
    """Mean cost of flagged vs other claims for the four documented hypotheses."""
    tests = [
        ("fnol_delay_over_24h", F.col("FNOL_Delay") > 24),
        ("driver_under_25", F.col("Driver_Age") < 25),
        ("vehicle_over_10y", F.col("Vehicle_Age") > 10),
        ("adverse_weather", F.col("Weather_Condition").isin(*K.ADVERSE_WEATHER)),
    ]
    aggs = []
    for name, cond in tests:
        aggs += [F.avg(F.when(cond, F.col(amount))).alias(f"{name}__f"),
                 F.avg(F.when(~cond | cond.isNull(), F.col(amount))).alias(f"{name}__o"),
                 F.count_if(cond).alias(f"{name}__n")]
    wide = df.agg(*aggs)
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("hypothesis"), F.col(f"{name}__n").alias("flagged_claims"),
                 F.col(f"{name}__f").alias("mean_flagged"), F.col(f"{name}__o").alias("mean_other"))
        for name, _ in tests])))
    return long.withColumn("uplift_pct", (F.try_divide(F.col("mean_flagged"), F.col("mean_other"))
                                          - F.lit(1.0)) * F.lit(100.0))


def dashboard_alerts(df: DataFrame, amount: str = ULT,
                     elevated_average: float = K.MEDIUM_SEVERITY) -> DataFrame:
    """Alerts raised by the portfolio: critical claims, savings, elevated mean."""
    t = F.coalesce(F.sum(amount), F.lit(0.0))
    savings = t * F.lit(K.RESERVE_OPTIMIZATION_RATE + K.FRAUD_PREVENTION_RATE) \
        + F.count(F.lit(1)) * F.lit(K.OPERATIONAL_SAVING_PER_CLAIM)
    a = df.agg(F.count_if(R.severity(amount) == "Critical").alias("critical"),
               savings.alias("savings"), F.avg(amount).alias("avg_claim"))
    shown = {"critical": F.col("critical").cast("string"), "savings": R.money("savings"), "average": R.money("avg_claim")}

    def alert(name):
        kind, title, before, after = K.ALERT_TEXTS[name]
        return F.struct(F.lit(kind).alias("kind"), F.lit(title).alias("title"),
                        F.concat(F.lit(before), shown[name], F.lit(after)).alias("message"))

    crit, save, avg = alert("critical"), alert("savings"), alert("average")
    arr = F.array(F.when(F.col("critical") > 0, crit), F.when(F.col("savings") > 0, save),
                  F.when(F.col("avg_claim") > elevated_average, avg))
    return a.select(F.inline(F.filter(arr, lambda x: x.isNotNull())))
