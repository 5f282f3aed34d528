"""Registered queries: one per operator of the inventory, each with its oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator over the whole
driver tables (claims from ``orders``, policies from ``customer``);
``ORACLE[name]`` is the same question in DuckDB SQL over the raw tables.
Floating results are rounded on both sides (2 decimals for money, 6 for
ratios) because sums in a different order differ in the last bits.  Dates are
returned as ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight.functions import dates as D
from claimsight.plans import oracle as O
from claimsight.operators.joins import merge_claims_policies
from claimsight.plans.scoring import prepared_claims, score_baseline
from claimsight.sources.tables import fixture_claims, fixture_policies

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Prepared and scored tables, and the folder of the processed one, per session and input.
_CACHE: dict[tuple, DataFrame | str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.sql(sql)
        return fn
    return deco


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared claims for ``sf_dir``; the plan (with its imputation literals) is reused per session."""
    k = _key(spark, sf_dir, "prepared")
    if k not in _CACHE:
        _CACHE[k] = prepared_claims(spark, sf_dir)
    return _CACHE[k]


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims joined to policies, before cleaning."""
    return merge_claims_policies(fixture_claims(spark, sf_dir), fixture_policies(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _key(spark, sf_dir, "scored")
    if k not in _CACHE:
        _CACHE[k] = score_baseline(prepared(spark, sf_dir))
    return _CACHE[k]


def half_up(x, d: int):
    """floor(x * 10^d + 0.5) / 10^d in double arithmetic (same as the oracle's rounding)."""
    m = float(10 ** d)
    return (F.floor(x.cast("double") * F.lit(m) + F.lit(0.5)).cast("double") / F.lit(m))


def rnd(df: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """Round the named double columns (``decimals`` per column) for stable comparison."""
    return df.withColumns({c: half_up(F.col(f"`{c}`"), d) for c, d in decimals.items()})


def iso(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: D.iso_date(c) for c in cols})


def ts_text(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss`` text."""
    # A cast is zone-free; date_format would go through the session time zone.
    return df.withColumns({c: F.col(c).cast("timestamp_ntz").cast("string") for c in cols})


# Import the query modules so that they register themselves.
from claimsight.plans import queries_core  # noqa: E402,F401
from claimsight.plans import queries_features  # noqa: E402,F401
from claimsight.plans import queries_analytics  # noqa: E402,F401
from claimsight.plans import queries_models  # noqa: E402,F401
from claimsight.plans import queries_io  # noqa: E402,F401
from claimsight.plans import queries_checks  # noqa: E402,F401
from claimsight.plans import queries_scale  # noqa: E402,F401
