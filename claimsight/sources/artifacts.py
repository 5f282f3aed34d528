"""Versioned datasets, split persistence, metadata and the model registry
(S3-S5, S8, A1-A3, M17).

Artifacts are Parquet tables under a base folder:

* ``<base>/data/version=<v>/`` -- one dataset version (partition pruning by path)
* ``<base>/_meta/`` -- one metadata row per written version (a small table)
* ``<models>/<name>/<version>/`` -- saved ``PipelineModel`` plus
  ``<models>/_registry/`` rows with parameters and metrics.

Folders starting with ``_`` are skipped by Spark's file listing, so metadata
never mixes into data scans.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _version() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


# --------------------------------------------------------------------------- A3
def schema_fingerprint(df: DataFrame) -> dict[str, Any]:
    """MD5 of Spark's own schema, names and types in column order, and the column count (A3).

    Metadata only: no Spark job runs.  Another order of columns is another schema.
    """
    ordered = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return {"schema_hash": hashlib.md5(ordered.encode()).hexdigest(), "n_columns": len(df.columns)}


# --------------------------------------------------------------------------- A1
META_SCHEMA = ("stage string, version string, created_at string, n_rows bigint, n_columns int, "
               "schema_hash string, numeric_columns int, text_columns int, time_columns int, "
               "train_rows bigint, test_rows bigint, train_hash string, test_hash string, "
               "schema_consistent boolean, columns array<string>, info map<string,string>, "
               "nulls map<string,bigint>, first_time string, last_time string")

_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def dataset_metadata(df: DataFrame, stage: str = "processed", version: str | None = None,
                     lineage: dict[str, str] | None = None, test: DataFrame | None = None,
                     observed: dict[str, Any] | None = None) -> DataFrame:
    """One-row metadata table (A1).

    Columns, their kinds (numeric, text, date or time) and the schema hash
    describe ``df``.  A ``processed`` dataset adds its rows; a ``split`` has
    ``df`` as the training part and ``test`` as the other, and adds the rows and
    schema hash of both and whether the schemas agree.  ``lineage`` (for a split
    also its method, parameters and target) is kept as text in ``info``.  Row
    counts are the only jobs, and none at all with the ``observed`` metrics of a write (:func:`written_metrics`), which
    also give the NULLs of every column and the time range.
    """
    if stage not in ("processed", "split"):
        raise ValueError(f"no metadata is defined for stage {stage!r}")
    if stage == "split" and test is None:
        raise ValueError("the metadata of a split needs its test part")
    own = schema_fingerprint(df)
    kinds = [f.dataType for f in df.schema.fields]
    row = {"stage": stage, "version": version or _version(),
           "created_at": _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds"),
           "n_columns": own["n_columns"], "schema_hash": own["schema_hash"],
           "numeric_columns": sum(isinstance(k, _NUMERIC) for k in kinds),
           "text_columns": sum(isinstance(k, T.StringType) for k in kinds),
           "time_columns": sum(isinstance(k, _TIME) for k in kinds),
           "columns": list(df.columns), "info": {k: str(v) for k, v in (lineage or {}).items()}}
    if stage == "processed":
        row["n_rows"] = df.count() if observed is None else observed["n_rows"]
        if observed is not None:
            row |= {"nulls": {c: observed[f"null_{i}"] for i, c in enumerate(df.columns)},
                    "first_time": observed.get("first"), "last_time": observed.get("last")}
    else:
        other = schema_fingerprint(test)["schema_hash"]
        row |= {"train_rows": df.count(), "test_rows": test.count(), "train_hash": own["schema_hash"],
                "test_hash": other, "schema_consistent": other == own["schema_hash"]}
    names = [part.split()[0] for part in META_SCHEMA.split(", ")]
    return df.sparkSession.createDataFrame([tuple(row.get(n) for n in names)], META_SCHEMA)


# --------------------------------------------------------------------------- S3, S4, A2
def written_metrics(df: DataFrame, time: str = "Accident_Date") -> list[Column]:
    """Rows, NULLs per column and the range of ``time`` (if there is such a column), to be observed while a table is written."""
    out = [F.count(F.lit(1)).alias("n_rows")]
    out += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)]
    if time in df.columns:
        out += [F.min(time).cast("string").alias("first"), F.max(time).cast("string").alias("last")]
    return out


def write_processed(df: DataFrame, base: str, version: str | None = None,
                    lineage: dict[str, str] | None = None) -> str:
    """Write one dataset version plus its metadata row (S3); returns the version.

    The metrics of the metadata row are gathered by the tasks that write the data; nothing is scanned or computed again.
    """
    version = version or _version()
    seen = Observation()
    df.observe(seen, *written_metrics(df)).write.mode("overwrite").parquet(f"{base}/data/version={version}")
    meta = dataset_metadata(df, "processed", version, lineage, observed=seen.get)
    meta.write.mode("append").parquet(f"{base}/_meta")
    return version


def read_metadata(spark: SparkSession, base: str) -> DataFrame:
    """All metadata rows of an artifact (A2)."""
    return spark.read.parquet(f"{base}/_meta")


def latest_version(spark: SparkSession, base: str) -> str:
    row = read_metadata(spark, base).agg(F.max("version").alias("v")).first()
    if row is None or row["v"] is None:
        raise FileNotFoundError(f"no versions under {base}")
    return row["v"]


def read_processed(spark: SparkSession, base: str, version: str | None = None) -> DataFrame:
    """Read one version (default: the latest) of a processed dataset."""
    try:
        v = version or latest_version(spark, base)
        return spark.read.parquet(f"{base}/data/version={v}")
    except Exception as e:  # noqa: BLE001 - surface a clear error for a missing artifact
        if isinstance(e, FileNotFoundError):
            raise
        raise FileNotFoundError(f"processed data not found under {base}: {e}") from e


# --------------------------------------------------------------------------- S5
def write_split(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Persist train and test rows as one table partitioned by ``split``."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, part: str | None = None, split_col: str = "split") -> DataFrame:
    """Reload the split table; ``part`` filters on the partition column (pruned at listing)."""
    df = spark.read.parquet(path)
    return df.where(F.col(split_col) == part) if part else df


# --------------------------------------------------------------------------- M17
REGISTRY_SCHEMA = ("name string, version string, path string, params map<string,string>, "
                   "metrics map<string,double>, saved_at string, kind string")


def save_model(spark: SparkSession, model: PipelineModel, base: str, name: str,
               params: dict | None = None, metrics: dict | None = None,
               version: str | None = None, kind: str = "model") -> str:
    """Save a fitted pipeline under ``<base>/<name>/<version>`` and register it."""
    version = version or _version()
    path = f"{base}/{name}/{version}"
    model.write().overwrite().save(path)
    row = (name, version, path, {k: str(v) for k, v in (params or {}).items()},
           {k: float(v) for k, v in (metrics or {}).items() if v is not None},
           _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds"), kind)
    spark.createDataFrame([row], REGISTRY_SCHEMA).write.mode("append").parquet(f"{base}/_registry")
    return version


def list_models(spark: SparkSession, base: str) -> DataFrame:
    """Registered models, metadata entries hidden, newest first."""
    reg = spark.read.parquet(f"{base}/_registry")
    return (reg.where((F.col("kind") == "model") & ~F.col("name").contains("metadata"))
            .orderBy(F.desc("version")))


def load_model(spark: SparkSession, base: str, name: str, version: str | None = None) -> PipelineModel:
    reg = spark.read.parquet(f"{base}/_registry").where(F.col("name") == name)
    if version is None:
        row = reg.orderBy(F.desc("version")).select("path").first()
    else:
        row = reg.where(F.col("version") == version).select("path").first()
    if row is None:
        raise FileNotFoundError(f"model {name} not found in {base}")
    return PipelineModel.load(row["path"])


def promote(spark: SparkSession, model: PipelineModel, base: str, source_name: str,
            metric: str, value: float, alias: str = "promoted") -> str:
    """Save the winner under a stable alias with a promotion record."""
    return save_model(spark, model, base, alias, params={"source": source_name, "selection_metric": metric},
                      metrics={metric: value})
