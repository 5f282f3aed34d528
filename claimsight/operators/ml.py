"""Claim-cost models with Spark MLlib.

Preprocessing is a fitted ``PipelineModel``: a ``SQLTransformer`` carrying the
train-set statistics (median imputation and standardisation of numeric
features, mode imputation of categorical ones) followed by ``StringIndexer``,
``OneHotEncoder`` and ``VectorAssembler``.  Statistics are distributed
aggregates (exact medians via histogram refinement); the model then trains on
the executors.  The label is ``log1p(Ultimate_Claim_Amount)`` -- applied once.
"""

from __future__ import annotations

import itertools
import uuid
import warnings
from dataclasses import dataclass, field
from typing import Any, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight import config as K
from claimsight.functions.quantiles import exact_quantiles, mode_values
from claimsight.operators import metrics as M
from claimsight.plans.scoring import VECTOR_FILE_ROWS, enrich_predictions, materialize

LABEL = "label"


# --------------------------------------------------------------------------- M2, M3, M4
def numeric_statistics(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """Per column: (median, mean, population std) of the median-imputed train values.

    A column without any value imputes and standardises to 0.
    """
    cols = list(cols)
    if not cols:
        return {}
    med = exact_quantiles(train, cols, [0.5])
    med = {c: {0.5: 0.0 if med[c][0.5] is None else med[c][0.5]} for c in cols}
    filled = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c][0.5])).alias(c) for c in cols])
    row = filled.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (med[c][0.5], row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(cols)}


def numeric_expressions(stats: dict[str, tuple[float, float, float]]) -> list[str]:
    """SQL expressions of the fitted numeric branch; a zero std scales by 1."""
    out = []
    for c, (med, mean, std) in stats.items():
        scale = std if std else 1.0
        out.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {med!r}) - {mean!r}) / {scale!r} AS `__num_{c}`")
    return out


def fit_feature_pipeline(train: DataFrame, numeric: Sequence[str] = K.NUMERIC_FEATURES,
                         categorical: Sequence[str] = K.CATEGORICAL_FEATURES) -> PipelineModel:
    """Fit the preprocessing on the training rows (M4); output column ``features``."""
    numeric = [c for c in numeric if c in train.columns]
    categorical = [c for c in categorical if c in train.columns]
    stats = numeric_statistics(train, numeric)
    modes = mode_values(train, categorical)
    exprs = numeric_expressions(stats)
    for c in categorical:
        fill = "NULL" if modes[c] is None else "'" + str(modes[c]).replace("'", "''") + "'"
        exprs.append(f"coalesce(CAST(`{c}` AS STRING), {fill}) AS `__cat_{c}`")
    sql = "SELECT *, " + ", ".join(exprs) + " FROM __THIS__"
    stages = [SQLTransformer(statement=sql)]
    if categorical:
        stages.append(StringIndexer(inputCols=[f"__cat_{c}" for c in categorical],
                                    outputCols=[f"__idx_{c}" for c in categorical],
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        # dropLast drops the extra "unseen" slot: every known level keeps a
        # column and an unseen level becomes the zero vector.
        stages.append(OneHotEncoder(inputCols=[f"__idx_{c}" for c in categorical],
                                    outputCols=[f"__ohe_{c}" for c in categorical], dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"__num_{c}" for c in numeric] + [f"__ohe_{c}" for c in categorical],
                                  outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def feature_names(transformed: DataFrame, col: str = "features") -> list[str]:
    """Slot names from the vector's ML attribute metadata (fixes name/slot drift)."""
    attrs = transformed.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    names = [n for _, n in sorted(slots)]
    return [n.replace("__num_", "").replace("__ohe___cat_", "").replace("__ohe_", "") for n in names]


# --------------------------------------------------------------------------- M5-M8
def elastic_net(regParam: float = 1.0, elasticNetParam: float = 0.5, maxIter: int = 1000,
                tol: float = 1e-4) -> LinearRegression:
    """Elastic net (M5); defaults of the reference's builder."""
    return LinearRegression(featuresCol="features", labelCol=LABEL, regParam=regParam,
                            elasticNetParam=elasticNetParam, maxIter=maxIter, tol=tol, standardization=False)


#: MLlib grows trees no deeper.
MOST_DEPTH = 30


def random_forest(numTrees: int = 100, maxDepth: int = 10, minInstancesPerNode: int = 1,
                  seed: int = K.RANDOM_STATE, bootstrap: bool = True) -> RandomForestRegressor:
    """Random forest (M6): every feature considered at each split, like the reference.

    A ``maxDepth`` over MLlib's limit of 30 raises.
    """
    if maxDepth > MOST_DEPTH:
        raise ValueError(f"maxDepth {maxDepth} is beyond MLlib's limit of {MOST_DEPTH}")
    return RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=numTrees,
                                 maxDepth=maxDepth, minInstancesPerNode=minInstancesPerNode,
                                 featureSubsetStrategy="all", seed=seed, bootstrap=bootstrap)


def gradient_boosting(maxIter: int = 100, stepSize: float = 0.1, maxDepth: int = 3,
                      seed: int = K.RANDOM_STATE) -> GBTRegressor:
    """Gradient-boosted trees (M7)."""
    return GBTRegressor(featuresCol="features", labelCol=LABEL, maxIter=maxIter, stepSize=stepSize,
                        maxDepth=maxDepth, seed=seed)


def hist_boosting(maxBins: int = 256, maxIter: int = 500, stepSize: float = 0.1, maxDepth: int = 6,
                  seed: int = K.RANDOM_STATE) -> GBTRegressor:
    """Histogram boosting (M8): MLlib trees already bin features; ``maxBins`` is the histogram size."""
    return GBTRegressor(featuresCol="features", labelCol=LABEL, maxIter=maxIter, stepSize=stepSize,
                        maxDepth=maxDepth, maxBins=maxBins, seed=seed)


BUILDERS = {"elastic_net": elastic_net, "random_forest": random_forest,
            "gradient_boosting": gradient_boosting, "hist_boosting": hist_boosting}
GRIDS = {"elastic_net": K.ELASTIC_NET_GRID, "random_forest": K.RANDOM_FOREST_GRID,
         "gradient_boosting": K.GRADIENT_BOOSTING_GRID, "hist_boosting": K.HIST_BOOSTING_GRID}


# --------------------------------------------------------------------------- training
@dataclass
class TrainedModel:
    name: str
    model: PipelineModel
    params: dict[str, Any]
    metrics: dict[str, float] = field(default_factory=dict)


def with_label(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    return df.where(F.col(target).isNotNull()).withColumn(LABEL, F.log1p(F.col(target)))


def training_rows(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], **more: Column) -> DataFrame:
    """Features, label and ``more`` columns of the labelled rows, written once.

    Preprocessing takes some ten passes, each over few columns: they read these instead of deriving all features anew.
    """
    used = [c for c in (*numeric, *categorical) if c in train.columns]
    plain = {c: F.col(f"`{c}`").cast("string") for c in used if isinstance(train.schema[c].dataType, T.NullType)}  # files have no void columns
    rows = with_label(train).select(*dict.fromkeys([*used, LABEL]), *[v.alias(n) for n, v in more.items()]).withColumns(plain)
    return materialize(train.sparkSession, rows, f"training/{uuid.uuid4().hex}")


def training_vectors(train: DataFrame, numeric: Sequence[str] = K.NUMERIC_FEATURES,
                     categorical: Sequence[str] = K.CATEGORICAL_FEATURES) -> tuple[PipelineModel, DataFrame]:
    """Fitted preprocessing, and ``features`` and ``label`` of the labelled rows, written once for any number of estimators."""
    labelled = training_rows(train, numeric, categorical)
    prep = fit_feature_pipeline(labelled, numeric, categorical)
    vec = materialize(train.sparkSession, prep.transform(labelled).select("features", LABEL), f"training/{uuid.uuid4().hex}", VECTOR_FILE_ROWS)
    return prep, vec


def fit_model(train: DataFrame, name: str, params: dict[str, Any] | None = None,
              numeric: Sequence[str] = K.NUMERIC_FEATURES,
              categorical: Sequence[str] = K.CATEGORICAL_FEATURES,
              vectors: tuple[PipelineModel, DataFrame] | None = None) -> TrainedModel:
    """Preprocessing + one estimator, fitted on the labelled training rows; ``vectors`` of :func:`training_vectors` are used if given."""
    params = dict(params or {})
    prep, vec = vectors or training_vectors(train, numeric, categorical)
    return TrainedModel(name, PipelineModel(stages=[prep, BUILDERS[name](**params).fit(vec)]), params)


def score_models(df: DataFrame, models: dict[str, PipelineModel], id_col: str = "Claim_ID") -> DataFrame:
    """``id``, ``predictions``: the amounts that several fitted models predict for each claim, in the order of ``models``.

    One scan without a shuffle: every different preprocessing (:func:`train_all` fits a single one) is applied once and dropped
    again when the models behind it have scored.
    """
    shared: dict[str, tuple[PipelineModel, list[str]]] = {}
    for name, model in models.items():
        shared.setdefault(model.stages[0].uid, (model.stages[0], []))[1].append(name)
    place = {name: f"__p{i}" for i, name in enumerate(models)}
    out, held = df, list(df.columns)
    for prep, names in shared.values():
        out = prep.transform(out)
        for name in names:
            for stage in models[name].stages[1:]:
                out = stage.copy({stage.predictionCol: place[name]}).transform(out)
            held.append(place[name])
        out = out.select(*[F.col(f"`{c}`") for c in held])
    return out.select(id_col, F.array(*[F.expm1(place[n]) for n in models]).alias("predictions"))


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Predict, back-transform once and enrich (M9): Predictions, Severity, Recommended_Reserve."""
    out = model.transform(df).withColumn("Predictions", F.expm1(F.col("prediction")))
    keep = [c for c in out.columns if not c.startswith("__") and c not in ("features",)]
    return enrich_predictions(out.select(*keep))


def evaluate_model(test: DataFrame, model: PipelineModel, target: str = K.TARGET) -> dict[str, float]:
    """Test-split metrics on the log scale and the currency scale."""
    p = model.transform(with_label(test, target))
    row = p.agg(
        M.r2(LABEL, "prediction").alias("r2_log"),
        F.sqrt(M.mse(LABEL, "prediction")).alias("rmse_log"),
        M.mae(LABEL, "prediction").alias("mae_log"),
        M.r2(target, F.expm1("prediction")).alias("r2"),
        F.sqrt(M.mse(target, F.expm1("prediction"))).alias("rmse"),
        M.mae(target, F.expm1("prediction")).alias("mae"),
        M.mape(target, F.expm1("prediction")).alias("mape"),
        M.rmsle(target, F.expm1("prediction")).alias("rmsle"),
        M.smape(target, F.expm1("prediction")).alias("smape"),
        F.count(F.lit(1)).alias("n")).first()
    return row.asDict()


def model_report(test: DataFrame, model: PipelineModel) -> DataFrame:
    """R2, RMSLE, MAE and MAPE % on the test split, one row."""
    m = evaluate_model(test, model)
    return test.sparkSession.createDataFrame(
        [(m["r2"], m["rmsle"], m["mae"], m["mape"] * 100.0)],
        "r2 double, rmsle double, mae double, mape_pct double")


# --------------------------------------------------------------------------- M11
def tune(train: DataFrame, name: str, grid: dict[str, list] | None = None, folds: int = K.CV_FOLDS,
         parallelism: int = 4, numeric: Sequence[str] = K.NUMERIC_FEATURES,
         categorical: Sequence[str] = K.CATEGORICAL_FEATURES,
         train_scores: bool = False) -> tuple[TrainedModel, DataFrame]:
    """Exhaustive grid search with k-fold CV, refit on the best RMSLE.

    Folds come from an MD5 of the claim id (deterministic, no shuffle, the same
    in any SQL engine).  The assembled training vectors are written once and
    shared by every fold and grid point; :mod:`claimsight.operators.tuning` says how few fits the grid takes.
    Returns the refit model and, per grid
    point, the mean over folds of RMSLE and SMAPE on the held-out fold
    (``cv_rmsle``, ``cv_smape``) and, with ``train_scores``, on the other folds
    (``train_rmsle``, ``train_smape``).  RMSE of the log1p label *is* the RMSLE
    of the amounts.
    """
    from claimsight.operators import tuning
    grid = grid if grid is not None else GRIDS[name]
    labelled = training_rows(train, numeric, categorical, __fold=cv_fold(folds))
    prep = fit_feature_pipeline(labelled, numeric, categorical)
    vec, points, sums = tuning.search(labelled, prep, name, BUILDERS[name], grid, folds, F.col("__fold"), parallelism)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # a fold without rows gives no score
        held, used = (np.nanmean([s.measures(side) for s in sums], axis=0) for side in ("held", "used"))
    best_params = points[int(np.nanargmin(held[:, 0]))] if points else {}
    best = BUILDERS[name](**best_params).fit(vec)
    clean = lambda v: None if np.isnan(v) else float(v)
    rows = [({k: str(v) for k, v in p.items()}, *map(clean, h), *(map(clean, u) if train_scores else (None, None)))
            for p, h, u in zip(points, held, used)]
    table = train.sparkSession.createDataFrame(
        rows, "params map<string,string>, cv_rmsle double, cv_smape double, train_rmsle double, train_smape double")
    return TrainedModel(name, PipelineModel(stages=[prep, best]), best_params), table


def cv_fold(folds: int, id_col: str = "Claim_ID"):
    """Fold of a claim: an MD5-derived integer modulo ``folds``."""
    digits = F.substring(F.md5(F.concat(F.col(id_col).cast("string"), F.lit("#fold"))), 1, 15)
    return (F.conv(digits, 16, 10).cast("long") % folds).cast("int")


def grid_size(name: str) -> int:
    return len(list(itertools.product(*GRIDS[name].values())))


# --------------------------------------------------------------------------- M16-M19
#: Columns of the run table: errors of the log1p label, then errors of the amounts in currency.
RUN_METRICS = ("mse_log", "rmse_log", "mae_log", "r2_log", "mse", "rmse", "mae", "mape", "r2", "rmsle", "smape")


def run_metrics(m: dict) -> dict[str, float | None]:
    """Metrics of one evaluated model with the squared errors of both scales."""
    out = dict(m)
    for scale in ("", "_log"):
        rmse = m.get(f"rmse{scale}")
        out[f"mse{scale}"] = None if rmse is None else rmse ** 2
    return out


def metrics_table(spark: SparkSession, models: Sequence[TrainedModel]) -> DataFrame:
    """One row per model; a name ending in ``_log`` is on the label's scale, the others on the amounts'."""
    rows = [(m.name, {k: str(v) for k, v in m.params.items()}, *[m.metrics.get(c) for c in RUN_METRICS]) for m in models]
    return spark.createDataFrame(rows, "model string, params map<string,string>, "
                                       + ", ".join(f"{c} double" for c in RUN_METRICS))


def compare_models(metrics: DataFrame) -> DataFrame:
    """Runs ordered by R2, best first."""
    return metrics.orderBy(F.desc_nulls_last("r2"), "model")


def best_model(metrics: DataFrame) -> str | None:
    row = compare_models(metrics).select("model").first()
    return None if row is None else row["model"]


def train_all(train: DataFrame, test: DataFrame, enabled: Sequence[str] = tuple(BUILDERS),
              params: dict[str, dict] | None = None, **features) -> list[TrainedModel]:
    """Fit every enabled model on shared preprocessing and evaluate it on the test split (M18); ``features`` as in :func:`fit_model`.

    Several models are evaluated on written columns of the labelled test rows, so that their features are derived once.
    """
    params = params or {}
    out = []
    vectors = training_vectors(train, **features)
    if len(enabled) > 1:
        used = {"numeric": K.NUMERIC_FEATURES, "categorical": K.CATEGORICAL_FEATURES} | features
        kept = {} if K.TARGET in (*used["numeric"], *used["categorical"]) else {K.TARGET: F.col(K.TARGET)}
        test = training_rows(test, used["numeric"], used["categorical"], **kept)
    for name in enabled:
        tm = fit_model(train, name, params.get(name), vectors=vectors)
        tm.metrics = run_metrics(evaluate_model(test, tm.model))
        out.append(tm)
    return out


def retrain(df: DataFrame, enabled: Sequence[str] = tuple(BUILDERS), params: dict[str, dict] | None = None,
            fraction: float = K.TEST_SIZE, seed: int = K.RANDOM_STATE,
            **features) -> tuple[list[TrainedModel], DataFrame]:
    """Refit on new labelled claims: split, train all, compare."""
    from claimsight.operators.split import train_test_split
    train, test = train_test_split(df, fraction=fraction, seed=seed)
    models = train_all(train, test, enabled, params, **features)
    return models, compare_models(metrics_table(df.sparkSession, models))
