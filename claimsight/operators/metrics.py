"""Regression metrics as single aggregates.

Every metric is one distributed ``agg`` over (label, prediction) columns with a
fixed-size buffer per task, so it scales with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPS = 2.220446049250313e-16  # float64 machine epsilon, the MAPE floor


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mse(y, p) -> Column:
    return F.avg(F.pow(_c(y) - _c(p), 2))


def mae(y, p) -> Column:
    return F.avg(F.abs(_c(y) - _c(p)))


def mape(y, p) -> Column:
    return F.avg(F.abs(_c(y) - _c(p)) / F.greatest(F.abs(_c(y)), F.lit(_EPS)))


def r2(y, p) -> Column:
    """1 - SS_res / SS_tot; a constant label gives 1 when predicted exactly, else 0."""
    y, p = _c(y), _c(p)
    ss_res = F.sum(F.pow(y - p, 2))
    ss_tot = F.var_pop(y) * F.count(y)
    return (F.when(ss_tot > 0, F.lit(1.0) - ss_res / ss_tot)
            .when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def rmsle(y, p) -> Column:
    """sqrt(mean((log1p(y) - log1p(p))^2))."""
    return F.sqrt(F.avg(F.pow(F.log1p(_c(y)) - F.log1p(_c(p)), 2)))


def smape(y, p) -> Column:
    """Mean 2|p-y|/(|y|+|p|) over non-zero denominators; 0 when none."""
    y, p = _c(y), _c(p)
    den = F.abs(y) + F.abs(p)
    return F.coalesce(F.avg(F.when(den != 0, F.lit(2.0) * F.abs(p - y) / den)), F.lit(0.0))


# --------------------------------------------------------------------------- M10
def fit_loglinear(df: DataFrame, x: str = "Estimated_Claim_Amount",
                  y: str = "Ultimate_Claim_Amount") -> tuple[float, float]:
    """log1p(y) = a + b * log1p(x) by least squares; returns (a, b).

    One aggregate (``regr_intercept``/``regr_slope``) -- a deterministic model
    whose scores an independent SQL engine can reproduce.
    """
    row = df.agg(F.regr_intercept(F.log1p(y), F.log1p(x)).alias("a"),
                 F.regr_slope(F.log1p(y), F.log1p(x)).alias("b")).first()
    return row["a"], row["b"]


def loglinear_predict(a: float, b: float, x: str = "Estimated_Claim_Amount") -> Column:
    """Prediction on the log scale."""
    return F.lit(a) + F.lit(b) * F.log1p(F.col(x))
