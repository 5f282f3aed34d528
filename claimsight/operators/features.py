"""Cleaning and feature derivation.

Each function is ``DataFrame -> DataFrame``.  Statistics needed for imputation
(median, mean, mode) are computed by distributed aggregates and applied as
literals, so the per-row work is a single narrow projection.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight import config as K
from claimsight.functions import dates as D
from claimsight.functions import rules as R
from claimsight.functions.quantiles import approx_quantiles, exact_quantiles, mode_values
from claimsight.operators.joins import attach_group_mean, attach_lookup


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


# --------------------------------------------------------------------------- F1
def _parsed(c: str, formats: Sequence[str]):
    text = F.trim(F.col(c).cast("string"))
    tries = [D.parse_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)).cast(T.TimestampNTZType()) for f in formats]]
    return F.coalesce(*tries)


def parse_dates(df: DataFrame, cols: Sequence[str] = K.DATE_COLUMNS, formats: Sequence[str] = ()) -> DataFrame:
    """Date columns to ``timestamp_ntz``; unparseable text becomes NULL.

    ISO text is read first, then each of ``formats`` (Spark datetime patterns
    such as ``MM/dd/yyyy`` or ``MMM d, yyyy``) in order.  Those go through the
    session time zone, so a time that the zone skips moves by the gap.
    :func:`lost_dates` counts what becomes NULL.
    """
    repl = {}
    for c in _present(df, cols):
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.TimestampNTZType):
            continue
        if isinstance(dtype, (T.DateType, T.TimestampType)):
            repl[c] = F.col(c).cast(T.TimestampNTZType())
        else:
            repl[c] = _parsed(c, formats)
    return df.withColumns(repl) if repl else df


def lost_dates(df: DataFrame, cols: Sequence[str] = K.DATE_COLUMNS, formats: Sequence[str] = ()) -> DataFrame:
    """One row: per text date column, how many non-blank values :func:`parse_dates` makes NULL."""
    text = [c for c in _present(df, cols) if isinstance(df.schema[c].dataType, T.StringType)]
    return df.agg(*[F.count_if((F.trim(F.col(c)) != "") & _parsed(c, formats).isNull()).alias(c) for c in text])


# --------------------------------------------------------------------------- F2-F4
def impute_median(df: DataFrame, cols: Sequence[str] = K.NUMERIC_IMPUTE_COLUMNS,
                  method: str = "exact") -> DataFrame:
    """Fill NULLs with the column median (exact by default, or ``approx``)."""
    cols = _present(df, cols)
    if not cols:
        return df
    q = (exact_quantiles if method == "exact" else approx_quantiles)(df, cols, [0.5])
    repl = {c: F.coalesce(F.col(c), F.lit(q[c][0.5]).cast(df.schema[c].dataType))
            for c in cols if q[c][0.5] is not None}
    return df.withColumns(repl) if repl else df


def impute_mean(df: DataFrame, cols: Sequence[str] = K.NUMERIC_IMPUTE_COLUMNS) -> DataFrame:
    cols = _present(df, cols)
    if not cols:
        return df
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    repl = {c: F.coalesce(F.col(c), F.lit(means[c])) for c in cols if means[c] is not None}
    return df.withColumns(repl) if repl else df


def impute_mode(df: DataFrame, cols: Sequence[str] = K.CATEGORICAL_IMPUTE_COLUMNS) -> DataFrame:
    """Fill NULLs with the most frequent value (smallest value on ties)."""
    modes = mode_values(df, _present(df, cols))
    repl = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items() if m is not None}
    return df.withColumns(repl) if repl else df


def impute(df: DataFrame, numeric_strategy: str = "median", median_method: str = "exact") -> DataFrame:
    if numeric_strategy == "median":
        df = impute_median(df, method=median_method)
    elif numeric_strategy == "mean":
        df = impute_mean(df)
    return impute_mode(df)


# --------------------------------------------------------------------------- F5-F18
def fnol_delay(df: DataFrame) -> DataFrame:
    """Hours from accident to first notice of loss."""
    if {"FNOL_Date", "Accident_Date"} <= set(df.columns):
        return df.withColumn("FNOL_Delay", D.hours_between("Accident_Date", "FNOL_Date"))
    return df


def _years_floor(start: str, end: str):
    return F.floor(D.whole_days_between(start, end) / F.lit(365))


def ages(df: DataFrame) -> DataFrame:
    """Driver, licence and vehicle age in whole years at the accident."""
    cols = set(df.columns)
    repl = {}
    if {"Accident_Date", "Date_of_Birth"} <= cols:
        repl["Driver_Age"] = _years_floor("Date_of_Birth", "Accident_Date")
    if {"Accident_Date", "Full_License_Issue_Date"} <= cols:
        repl["License_Age"] = F.abs(_years_floor("Full_License_Issue_Date", "Accident_Date"))
    if {"Accident_Date", "Vehicle_Year"} <= cols:
        repl["Vehicle_Age"] = F.abs(F.year("Accident_Date") - F.col("Vehicle_Year")).cast("bigint")
    return df.withColumns(repl) if repl else df


def _flag(cond):
    # A NULL condition falls to otherwise, like a NaN comparison in pandas.
    return F.when(cond, "Yes").otherwise("No")


def flags(df: DataFrame, high_risk_min_age: int = K.HIGH_RISK_MIN_AGE,
          high_risk_max_age: int = K.HIGH_RISK_MAX_AGE,
          inexperienced_years: int = K.INEXPERIENCED_LICENCE_YEARS,
          old_vehicle_years: int = K.OLD_VEHICLE_YEARS,
          early_fnol_hours: float = K.EARLY_FNOL_HOURS) -> DataFrame:
    """Yes/No risk flags."""
    cols = set(df.columns)
    repl = {}
    if "Driver_Age" in cols:
        a = F.col("Driver_Age")
        repl["High_Risk_Driver"] = _flag((a < high_risk_min_age) | (a > high_risk_max_age))
    if "License_Age" in cols:
        repl["Inexperienced_Driver"] = _flag(F.col("License_Age") < inexperienced_years)
    if "Vehicle_Age" in cols:
        repl["Old_Vehicle"] = _flag(F.col("Vehicle_Age") > old_vehicle_years)
    if "FNOL_Delay" in cols:
        repl["Early_FNOL"] = _flag(F.col("FNOL_Delay") <= early_fnol_hours)
    return df.withColumns(repl) if repl else df


def estimate_features(df: DataFrame, type_means: DataFrame | None = None,
                      keep_means: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Ratio, bucket, type average, relative estimate and complexity.

    ``type_means`` (columns ``Claim_Type, Type_Avg_Estimate``) lets new claims
    be compared with a portfolio's averages (fixes the one-row form case);
    by default the averages come from ``df`` itself, and ``keep_means`` may
    write them for later plans.
    """
    if "Estimated_Claim_Amount" not in df.columns:
        return df
    est = F.col("Estimated_Claim_Amount")
    df = df.withColumns({
        "Estimate_to_Age_Ratio": est / (F.col("Vehicle_Age") + F.lit(1)),
        "Estimate_Bucket": R.estimate_bucket(est),
    })
    if type_means is None:
        df = attach_group_mean(df, "Claim_Type", "Estimated_Claim_Amount", "Type_Avg_Estimate", keep_means)
    else:
        df = attach_lookup(df, type_means, "Claim_Type", "Type_Avg_Estimate")
    return df.withColumns({
        "Estimate_Relative_to_Type": F.try_divide(est, F.col("Type_Avg_Estimate")),
        "Complexity_Score": _flag(F.col("Traffic_Condition").isin(*K.COMPLEX_TRAFFIC)
                                  & (F.col("Weather_Condition") == K.COMPLEX_WEATHER)),
    })


def settlement_delay(df: DataFrame) -> DataFrame:
    """Whole days from FNOL to settlement (F18, documented feature)."""
    return df.withColumn("Settlement_Delay", D.whole_days_between("FNOL_Date", "Settlement_Date"))


def derive_features(df: DataFrame, numeric_strategy: str = "median", median_method: str = "exact",
                    keep_means: Callable[[DataFrame], DataFrame] | None = None, **thresholds) -> DataFrame:
    """F1-F17 in the reference order: parse dates, impute, derive."""
    df = parse_dates(df)
    df = impute(df, numeric_strategy, median_method)
    df = fnol_delay(df)
    df = ages(df)
    df = flags(df, **thresholds)
    return estimate_features(df, keep_means=keep_means)


def feature_list(include_original: bool = False) -> list[str]:
    """Names of the derived columns."""
    names = list(K.DERIVED_FEATURES)
    if include_original:
        names += list(K.CATEGORICAL_FEATURES) + list(K.NUMERIC_FEATURES)
    return names


def upload_features(df: DataFrame, as_of: _dt.datetime | str) -> DataFrame:
    """Upload variant (F21): delay in hours; ages measured at ``as_of``.

    Driver and licence age are whole days / 365.25 (fractional years);
    vehicle age is ``year(as_of) - Vehicle_Year``.  ``as_of`` is a parameter so
    that results repeat (the reference uses the wall clock).
    """
    df = parse_dates(df)
    ts = F.lit(str(as_of)).cast(T.TimestampNTZType())
    cols = set(df.columns)
    repl = {}
    if {"Accident_Date", "FNOL_Date"} <= cols:
        repl["FNOL_Delay"] = D.hours_between("Accident_Date", "FNOL_Date")
    if "Date_of_Birth" in cols:
        repl["Driver_Age"] = D.whole_days_between(F.col("Date_of_Birth"), ts) / F.lit(365.25)
    if "Full_License_Issue_Date" in cols:
        repl["License_Age"] = D.whole_days_between(F.col("Full_License_Issue_Date"), ts) / F.lit(365.25)
    if "Vehicle_Year" in cols:
        repl["Vehicle_Age"] = (F.year(ts) - F.col("Vehicle_Year")).cast("bigint")
    return df.withColumns(repl) if repl else df
