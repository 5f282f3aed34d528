"""Business rules as Column expressions.

Each rule is a pure ``Column -> Column`` built from JVM functions, so it stays
inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimsight import config as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- C1-C4
def severity(amount, low: float = K.LOW_SEVERITY, medium: float = K.MEDIUM_SEVERITY,
             high: float = K.HIGH_SEVERITY) -> Column:
    """Low < low <= Medium < medium <= High < high <= Critical; NULL stays NULL."""
    a = _c(amount)
    return (F.when(a < low, "Low").when(a < medium, "Medium")
            .when(a < high, "High").when(a.isNotNull(), "Critical"))


def reserve(prediction, buffer_pct: float = K.RESERVE_BUFFER_PERCENTAGE) -> Column:
    """Recommended reserve: prediction plus the buffer."""
    return _c(prediction) * F.lit(1.0 + buffer_pct / 100.0)


def money(x, decimals: int = 2) -> Column:
    """``£1,234.56``."""
    return F.concat(F.lit("£"), F.format_number(_c(x), decimals))


def fixed(x, decimals: int) -> Column:
    """Fixed-point text without grouping, rounded half-even on the exact binary value.

    ``format_number`` rounds like Python's ``format``; ``format_string('%.1f')``
    would round half-up (0.25 -> 0.3 instead of 0.2).
    """
    return F.regexp_replace(F.format_number(_c(x), decimals), ",", "")


def percent(x) -> Column:
    """One decimal and a percent sign (C4)."""
    return F.concat(fixed(x, 1), F.lit("%"))


# --------------------------------------------------------------------------- C5-C7
def _insight(kind: str, title: str, message: Column, action: str, priority: str) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.lit(title).alias("title"),
                    message.alias("message"), F.lit(action).alias("action"),
                    F.lit(priority).alias("priority"))


def insights(prediction, delay_hours="FNOL_Delay", driver_age="Driver_Age",
             vehicle_age="Vehicle_Age", weather="Weather_Condition",
             delay_threshold: float = K.FNOL_DELAY_THRESHOLD_HOURS) -> Column:
    """Array of actionable alerts for one claim (C5); explode for a long table."""
    p, d, age = _c(prediction), _c(delay_hours), _c(driver_age)
    v, w = _c(vehicle_age), _c(weather)
    cases = {
        "high_value": (severity(p) == "Critical", money(p)), "late": (d > delay_threshold, fixed(d, 0)),
        "young": (age < 25, None), "senior": (age > 70, None),
        "old_vehicle": (v > 15, fixed(v.cast("double"), 0)), "weather": (w.isin(*K.ADVERSE_WEATHER), w),
    }
    candidates = []
    for name, (condition, shown) in cases.items():
        kind, title, before, after, action, priority = K.INSIGHT_TEXTS[name]
        message = F.lit(before) if shown is None else F.concat(F.lit(before), shown, F.lit(after))
        candidates.append(F.when(condition, _insight(kind, title, message, action, priority)))
    return F.filter(F.array(*candidates), lambda x: x.isNotNull())


def risk_factors(driver_age="Driver_Age", vehicle_age="Vehicle_Age", delay_hours="FNOL_Delay",
                 weather="Weather_Condition") -> Column:
    """Text labels describing the claim's risk profile."""
    age, v, d, w = _c(driver_age), _c(vehicle_age), _c(delay_hours), _c(weather)
    T = K.RISK_TEXTS
    items = [
        F.when(age < 25, T["young"]).when(age > 70, T["senior"]).otherwise(T["standard_age"]),
        F.when(v > 10, T["old_vehicle"]).otherwise(T["new_vehicle"]),
        F.when(d > 24, T["late"]).otherwise(T["timely"]),
        F.when(w.isin(*K.ADVERSE_WEATHER_LABELLED), T["weather"]),
    ]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def recommended_actions(sev) -> Column:
    """Three escalation steps for High/Critical claims, then three standard steps."""
    s = _c(sev)
    extra = F.when(s.isin("High", "Critical"), F.array(*[F.lit(a) for a in K.ESCALATION_STEPS])) \
        .otherwise(F.array().cast("array<string>"))
    return F.concat(extra, F.array(*[F.lit(a) for a in K.STANDARD_STEPS]))


# --------------------------------------------------------------------------- N1-N6
def band(x, edges: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """Label of the interval that holds ``x``; outside every interval gives NULL.

    ``right=False``: intervals are [a, b); ``right=True``: (a, b].
    """
    v = _c(x)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (v > lo) & (v <= hi) if right else (v >= lo) & (v < hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def driver_age_band(x, right: bool = False) -> Column:
    return band(x, K.DRIVER_AGE_EDGES, K.DRIVER_AGE_LABELS, right)


def vehicle_age_band(x, right: bool = False, labels: Sequence[str] | None = None) -> Column:
    if labels is None:
        labels = K.VEHICLE_AGE_LABELS_ADEQUACY if right else K.VEHICLE_AGE_LABELS_TREND
    return band(x, K.VEHICLE_AGE_EDGES, labels, right)


def estimate_bucket(x) -> Column:
    """Six right-closed bands starting above 0; <= 0 or NULL gives NULL."""
    return band(x, K.ESTIMATE_BUCKET_EDGES, K.ESTIMATE_BUCKET_LABELS, right=True)


def reserve_gap(ultimate="Ultimate_Claim_Amount", reserve_col="Recommended_Reserve") -> Column:
    return _c(ultimate) - _c(reserve_col)


def human_error(ultimate="Ultimate_Claim_Amount", estimate="Estimated_Claim_Amount") -> Column:
    return F.abs(_c(ultimate) - _c(estimate))


def model_error(ultimate="Ultimate_Claim_Amount", prediction="Predictions") -> Column:
    return F.abs(_c(ultimate) - _c(prediction))


def round_half_even(x, decimals: int = 2) -> Column:
    """NumPy-style rounding: scale, round half to even on the scaled double, unscale."""
    scale = float(10 ** decimals)
    return F.rint(_c(x) * scale) / F.lit(scale)


def model_lift_pct(human, model) -> Column:
    """(human - model) / human * 100 rounded to 2 decimals; zero human error gives NULL."""
    h, m = _c(human), _c(model)
    return round_half_even(F.try_divide(h - m, h) * F.lit(100.0), 2)


def gap_pct(gap, ultimate) -> Column:
    return F.try_divide(_c(gap), _c(ultimate)) * F.lit(100.0)


def adequacy_status(gap, threshold: float = 15000.0) -> Column:
    g = _c(gap)
    t = float(threshold)
    crit, under, surplus, adequate, pending = K.ADEQUACY_STATUS
    return (F.when(g > t, crit)
            .when((g > 0) & (g <= t), under)
            .when(g < -(t / 2.0), surplus)
            .when((g <= 0) & (g >= -(t / 2.0)), adequate)
            .otherwise(pending))


def expm1(x) -> Column:
    return F.expm1(_c(x))


def log1p(x) -> Column:
    return F.log1p(_c(x))
