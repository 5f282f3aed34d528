"""Data-preparation and training entries, composed from the operators.

``prepare_data``: read claims and policies, join, pass the quality gate,
clean and featurise, write a versioned Parquet artifact (entry 1).
``train_and_promote``: split, fit the enabled models (optionally tuned), rank
by R2, save every model and promote the best (entry 2).
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from claimsight import config as K
from claimsight.operators import ml as ML
from claimsight.operators.features import derive_features, estimate_features, flags, upload_features
from claimsight.operators.joins import merge_claims_policies
from claimsight.operators.quality import validate
from claimsight.operators.split import train_test_split, with_split
from claimsight.plans.scoring import materialize
from claimsight.sources import artifacts as A
from claimsight.sources.files import read_claims, read_policies, read_upload


def prepare_frames(claims: DataFrame, policies: DataFrame, missing_threshold: float = 0.1,
                   median_method: str = "exact") -> tuple[DataFrame, dict]:
    """Join (written once), validate (raises on critical missing values) and derive features."""
    merged = materialize(claims.sparkSession, merge_claims_policies(claims, policies), f"joined/{uuid.uuid4().hex}")
    report = validate(merged, missing_threshold)
    return derive_features(merged, median_method=median_method), report


def prepare_data(spark: SparkSession, claims_path: str, policies_path: str, out_base: str,
                 missing_threshold: float = 0.1) -> str:
    """Entry 1; returns the written version."""
    df, report = prepare_frames(read_claims(spark, claims_path), read_policies(spark, policies_path),
                                missing_threshold)
    return A.write_processed(df, out_base, lineage={"claims": claims_path, "policies": policies_path,
                                                    "validation_passed": report["passed"]})


def persist_split(df: DataFrame, path: str, fraction: float = K.TEST_SIZE, seed: int = K.RANDOM_STATE) -> DataFrame:
    """Split deterministically and write both parts in one partitioned table (M1 + S5), with a metadata row.

    The row (``<path>/_meta``) tells rows and schema of both parts, and how they were made.
    """
    spark = df.sparkSession
    A.write_split(with_split(df, fraction=fraction, seed=seed), path)
    train, test = (A.read_split(spark, path, part) for part in ("train", "test"))
    made = {"split_method": "md5 of the claim id below a threshold", "test_fraction": fraction, "seed": seed, "target": K.TARGET,
            "preprocessing": "parse dates, impute, derive features"}
    A.dataset_metadata(train, "split", lineage=made, test=test).write.mode("append").parquet(f"{path}/_meta")
    return spark.read.parquet(path)


def train_and_promote(spark: SparkSession, processed: DataFrame, models_base: str,
                      enabled: Sequence[str] = tuple(ML.BUILDERS), params: dict[str, dict] | None = None,
                      tune_grids: dict[str, dict] | None = None, **features) -> DataFrame:
    """Entry 2: fit (or tune) each enabled model, save all, promote the best by R2.

    ``features`` (``numeric``, ``categorical``) as in :func:`claimsight.operators.ml.fit_model`.
    Returns the ranked metrics table.
    """
    train, test = train_test_split(processed)
    trained = []
    for name in enabled:
        if tune_grids and name in tune_grids:
            tm, _ = ML.tune(train, name, tune_grids[name], **features)
        else:
            tm = ML.fit_model(train, name, (params or {}).get(name), **features)
        tm.metrics = ML.run_metrics(ML.evaluate_model(test, tm.model))
        A.save_model(spark, tm.model, models_base, name, tm.params, tm.metrics)
        trained.append(tm)
    ranked = ML.compare_models(ML.metrics_table(spark, trained))
    best = ranked.first()
    if best is not None:
        winner = next(t for t in trained if t.name == best["model"])
        A.promote(spark, winner.model, models_base, winner.name, "r2", best["r2"])
    return ranked


def score_upload(spark: SparkSession, path: str, models_base: str, model: str, as_of: str,
                 type_means: DataFrame | None = None) -> DataFrame:
    """Batch upload scoring: read and check the upload, derive its features, load the model, predict, enrich.

    ``type_means`` (``Claim_Type, Type_Avg_Estimate``) are the portfolio's averages.
    """
    df = estimate_features(flags(upload_features(read_upload(spark, path), as_of)), type_means=type_means)
    return ML.score(df, A.load_model(spark, models_base, model))
