"""Projections, filters and sampling."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight import config as K
from claimsight.functions import rules as R
from claimsight.operators.features import estimate_features, flags


def select_available(df: DataFrame, numeric: Sequence[str] = K.NUMERIC_FEATURES,
                     categorical: Sequence[str] = K.CATEGORICAL_FEATURES) -> DataFrame:
    """Configured features that exist, numeric first, in configured order."""
    cols = [c for c in list(numeric) + list(categorical) if c in df.columns]
    return df.select(*cols)


def drop_missing_target(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Rows whose target is present."""
    return df.na.drop(subset=[target])


def features_and_target(df: DataFrame, target: str = K.TARGET, label: str = "label") -> DataFrame:
    """Replace the target by ``label = log1p(target)`` (P3); missing target raises."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found in dataframe")
    return df.withColumn(label, F.log1p(F.col(target))).drop(target)


def _date_lit(d) -> Column:
    return F.lit(str(d)).cast("date")


def date_range(df: DataFrame, start, end, col: str = "Accident_Date") -> DataFrame:
    """Calendar-date filter, both ends inclusive.

    Written as the half-open timestamp range ``[start 00:00, end + 1 day
    00:00)`` -- the same rows as comparing ``to_date(col)``, but a plain
    comparison on the column reaches the Parquet scan as a pushed filter.
    """
    lo = _date_lit(start).cast(T.TimestampNTZType())
    hi = F.date_add(_date_lit(end), 1).cast(T.TimestampNTZType())
    return df.where((F.col(col) >= lo) & (F.col(col) < hi))


def date_range_ts(df: DataFrame, start, end, col: str = "Accident_Date") -> DataFrame:
    """Timestamp filter against midnight of both ends (P5): end-day rows after 00:00 drop out."""
    lo = F.lit(f"{start} 00:00:00").cast(T.TimestampNTZType())
    hi = F.lit(f"{end} 00:00:00").cast(T.TimestampNTZType())
    return df.where((F.col(col) >= lo) & (F.col(col) <= hi))


def high_severity(df: DataFrame, amount: str = K.TARGET, threshold: float = K.HIGH_SEVERITY) -> DataFrame:
    """P6."""
    return df.where(F.col(amount) >= threshold)


def late_claims(df: DataFrame, hours: float = K.LATE_CLAIM_HOURS) -> DataFrame:
    """P7."""
    return df.where(F.col("FNOL_Delay") > hours)


DISPLAY_COLUMNS = ("Claim_ID", "Policy_ID", "High_Risk_Driver", "Inexperienced_Driver",
                   "Estimated_Claim_Amount", "Ultimate_Claim_Amount", "Predictions",
                   "Severity", "Recommended_Reserve")
_MONEY_COLUMNS = ("Estimated_Claim_Amount", "Ultimate_Claim_Amount", "Predictions", "Recommended_Reserve")


def display_columns(df: DataFrame) -> DataFrame:
    """The nine result columns that exist, money as ``£`` text, NULL as empty."""
    cols = [c for c in DISPLAY_COLUMNS if c in df.columns]
    return df.select(*[F.coalesce(R.money(c), F.lit("")).alias(c) if c in _MONEY_COLUMNS else F.col(c)
                       for c in cols])


def scatter_points(df: DataFrame, x: str = "Estimated_Claim_Amount", y: str = K.TARGET) -> DataFrame:
    """Estimate/ultimate pairs plus the diagonal's end (larger of both maxima).

    The maximum is one aggregate, applied as a literal.
    """
    m = df.agg(F.greatest(F.max(x), F.max(y)).alias("m")).first()["m"]
    return df.select(F.col(x), F.col(y), F.lit(m).cast("double").alias("diagonal_max"))


def sample_n(df: DataFrame, n: int, seed: int = K.RANDOM_STATE, id_col: str = "Claim_ID") -> DataFrame:
    """n rows chosen by a seeded hash of the id (P10).

    Repeatable and planned as a per-partition top-n merged once
    (``TakeOrderedAndProject``); all rows when ``n`` exceeds them.
    """
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"#{seed}")))
    return df.withColumn("__k", key).orderBy("__k", id_col).limit(n).drop("__k")


def reference_rows(df: DataFrame, n: int = 1, id_col: str = "Claim_ID") -> DataFrame:
    """First ``n`` rows by id, used as templates."""
    return df.orderBy(id_col).limit(n)


FORM_COLUMNS = ("Estimated_Claim_Amount", "Driver_Age", "License_Age", "Vehicle_Age",
                "Claim_Type", "Weather_Condition", "Traffic_Condition", "FNOL_Delay")


def with_claim_inputs(df: DataFrame, overrides: DataFrame, type_means: DataFrame | None = None,
                      key: str = "Claim_ID", **thresholds) -> DataFrame:
    """What-if scoring input (P12): override form columns per claim, re-derive features.

    ``overrides`` holds ``key`` plus any of :data:`FORM_COLUMNS`; a NULL
    override keeps the stored value.  The type average comes from
    ``type_means`` (portfolio averages) so that a single claim is compared with
    the portfolio, not with itself.
    """
    ov_cols = [c for c in FORM_COLUMNS if c in overrides.columns]
    ov = overrides.select(key, *[F.col(c).alias(f"__ov_{c}") for c in ov_cols])
    joined = df.join(ov, key, "left")
    joined = joined.withColumns({c: F.coalesce(F.col(f"__ov_{c}"), F.col(c)).cast(df.schema[c].dataType)
                                 for c in ov_cols if c in df.columns})
    joined = joined.drop(*[f"__ov_{c}" for c in ov_cols])
    base = joined.drop("High_Risk_Driver", "Inexperienced_Driver", "Old_Vehicle", "Early_FNOL",
                       "Estimate_to_Age_Ratio", "Estimate_Bucket", "Type_Avg_Estimate",
                       "Estimate_Relative_to_Type", "Complexity_Score")
    return estimate_features(flags(base, **thresholds), type_means=type_means)
