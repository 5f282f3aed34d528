"""Prepared and scored claim tables -- the inputs of every portfolio query.

``prepared_claims``: claims joined to policies, cleaned and featurised (the
data-preparation entry).  ``scored_claims``: prepared claims plus
``Predictions``, ``Severity`` and ``Recommended_Reserve`` (the dashboard's
start-up view, S8).  By default scores come from the log-linear baseline (M10)
so that every downstream query has a deterministic prediction column; any
fitted MLlib model can be applied with :func:`claimsight.operators.ml.score`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight.functions import rules as R
from claimsight.operators.features import derive_features
from claimsight.operators.joins import merge_claims_policies
from claimsight.operators.metrics import fit_loglinear, loglinear_predict
from claimsight.operators.split import is_test
from claimsight.session import shared_path
from claimsight.sources.tables import fixture_claims, fixture_policies


def prepared_claims(spark: SparkSession, sf_dir: str, median_method: str = "exact",
                    write_join: bool = True, **thresholds) -> DataFrame:
    """Claims joined to policies, cleaned and featurised.

    With ``write_join`` the joined table is written once to the shared
    checkpoint folder: the imputation statistics then scan only the columns
    they need from Parquet instead of recomputing the shuffle join per
    statistic, and a lost executor recomputes from the written table.  The
    averages per claim type (one row per type) are written too.
    """
    merged = merge_claims_policies(fixture_claims(spark, sf_dir), fixture_policies(spark, sf_dir))
    keep_means = None
    if write_join:
        merged = materialize(spark, merged, f"joined/{uuid.uuid4().hex}")

        def keep_means(means: DataFrame) -> DataFrame:
            return materialize(spark, means, f"type_means/{uuid.uuid4().hex}")

    return derive_features(merged, median_method=median_method, keep_means=keep_means, **thresholds)


def enrich_predictions(df: DataFrame, prediction: str = "Predictions") -> DataFrame:
    """Add Severity and Recommended_Reserve from a prediction column."""
    return df.withColumns({"Severity": R.severity(prediction),
                           "Recommended_Reserve": R.reserve(prediction)})


def score_baseline(prepared: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """Fit M10 on the training split (default) and score every row."""
    if train is None:
        train = prepared.where(~is_test())
    a, b = fit_loglinear(train)
    scored = prepared.withColumn("Predictions", F.expm1(loglinear_predict(a, b)))
    return enrich_predictions(scored)


def scored_claims(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return score_baseline(prepared_claims(spark, sf_dir, **kw))


def dashboard_chart(scored: DataFrame, start, end, metric: str = "exposure",
                    threshold: float = 15000.0) -> DataFrame:
    """The dashboard's chart data (entry 3).

    The memoised batch view keeps claims whose accident *date* is in range
    (P4); the chart then compares *timestamps* with both ends at midnight
    (P5) and computes the selected monthly metric with its 3-month mean
    (G4-G7, W2), or the severity counts when no metric is selected (G2).
    """
    from claimsight.operators.filters import date_range, date_range_ts
    from claimsight.operators.portfolio import monthly_metric
    batch = date_range(scored, start, end)
    return monthly_metric(date_range_ts(batch, start, end), metric, threshold)


#: Most rows of a file of a written intermediate table, and of one that models are fitted on (a forest works for a millisecond on a row).
_FILE_ROWS = 100_000
VECTOR_FILE_ROWS = 20_000


def materialize(spark: SparkSession, df: DataFrame, name: str, file_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage (so a lost executor recomputes from the written table,
    not from the raw scan) and lets several queries reuse one preparation.
    A file has at most ``file_rows`` (``_FILE_ROWS``) rows: a scan packs files by size, so a table of
    few bytes and much work per row is still dealt over all cores.
    """
    path = shared_path(spark, name)
    df.write.mode("overwrite").option("maxRecordsPerFile", file_rows or _FILE_ROWS).parquet(path)
    return spark.read.parquet(path)
