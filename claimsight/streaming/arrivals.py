"""Scoring claims as files arrive (ST1).

A stateless Structured Streaming query: CSV files dropped into a folder are
parsed, featurised (upload variant, ages at a fixed ``as_of``), compared
with the portfolio's per-type averages (a stream-static equi-join, broadcast only if Spark
measures the averages as small), scored and appended to a Parquet sink.  The checkpoint
makes it exactly-once across restarts; ``availableNow`` processes what is there
and stops, so it can also run as a scheduled batch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimsight.operators.features import estimate_features, flags, upload_features
from claimsight.sources.files import csv_stream, typed_or_rejected

Scorer = Callable[[DataFrame], DataFrame]


def arrivals_stream(spark: SparkSession, in_dir: str, schema: T.StructType, as_of: str,
                    type_means: DataFrame | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """The featurised arrivals as a streaming DataFrame.

    Files whose header differs from ``schema`` in names or order stop the
    stream.  A row with a malformed date or number is set aside: ``Rejected``
    lists its bad columns (NULL for good rows).
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.readStream.schema(text).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = upload_features(typed_or_rejected(reader.csv(in_dir), schema), as_of)
    df = flags(df)
    if type_means is not None and "Estimated_Claim_Amount" in df.columns:
        df = estimate_features(df, type_means=type_means)
    return df


def score_arrivals(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: T.StructType,
                   scorer: Scorer, as_of: str, type_means: DataFrame | None = None,
                   available_now: bool = True) -> StreamingQuery:
    """Start the scoring stream; ``scorer`` adds ``prediction`` on the log scale.

    Rejected rows reach the sink without a prediction.
    """
    from claimsight.functions import rules as R
    df = scorer(arrivals_stream(spark, in_dir, schema, as_of, type_means))
    df = df.withColumn("Predictions", F.when(F.col("Rejected").isNull(), F.expm1(F.col("prediction"))))
    df = df.withColumns({"Severity": R.severity("Predictions"), "Recommended_Reserve": R.reserve("Predictions")})
    keep = [c for c in df.columns if not c.startswith("__") and c != "features"]
    writer = (df.select(*keep).writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def monthly_exposure_stream(spark: SparkSession, in_dir: str, snapshot_path: str, checkpoint: str,
                            schema: T.StructType, amount: str = "Ultimate_Claim_Amount",
                            available_now: bool = True) -> StreamingQuery:
    """Monthly exposure kept current as claim files arrive (the dashboard's refresh).

    A stateful streaming aggregation in ``complete`` mode: the state holds one
    row per accident month -- bounded by the calendar, not by the claims -- so
    no watermark is needed and no late claim is ever dropped.  Each epoch
    writes a version of its own (the same one if an epoch is replayed), so a
    failed write never touches the version before it; :func:`read_snapshot`
    gives the newest complete one.  The 3-month mean is applied to it in batch.

    Columns are found by header name.  Claims with a malformed date or amount are in no sum and no claim
    count: the row without a month has their number (``rejected``).
    """
    from claimsight.functions.dates import month_start
    raw = typed_or_rejected(csv_stream(spark, in_dir, schema.names), schema)
    good = F.col("Rejected").isNull()
    agg = raw.groupBy(F.when(good, month_start("Accident_Date")).alias("Month")).agg(
        F.sum(F.when(good, F.col(amount))).alias("value"), F.count_if(good).alias("claims"), F.count_if(~good).alias("rejected"))

    def write_snapshot(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite").parquet(f"{snapshot_path}/version={epoch_id}")

    writer = (agg.writeStream.outputMode("complete").foreachBatch(write_snapshot)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_snapshot(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """The newest complete snapshot; without any, no rows.

    A version whose write failed holds no data files, so its rows can't be the newest.
    """
    fields = T.StructType([T.StructField("Month", T.DateType()), T.StructField("value", T.DoubleType()),
                           T.StructField("claims", T.LongType()), T.StructField("rejected", T.LongType()), T.StructField("epoch", T.LongType()),
                           T.StructField("version", T.LongType())])
    try:
        every = spark.read.schema(fields).parquet(snapshot_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields).drop("epoch", "version")
    newest = every.agg(F.max("version")).first()[0]  # from the folder names
    return every.where(F.col("version") == newest).drop("epoch", "version")


EXPOSURE_SCHEMA = T.StructType([
    T.StructField("Claim_ID", T.StringType()), T.StructField("Accident_Date", T.StringType()),
    T.StructField("Ultimate_Claim_Amount", T.DoubleType()),
])

UPLOAD_SCHEMA = T.StructType([
    T.StructField("Claim_ID", T.StringType()), T.StructField("Policy_ID", T.StringType()),
    T.StructField("Accident_Date", T.StringType()), T.StructField("FNOL_Date", T.StringType()),
    T.StructField("Settlement_Date", T.StringType()),
    T.StructField("Estimated_Claim_Amount", T.DoubleType()),
    T.StructField("Driver_Age", T.DoubleType()), T.StructField("License_Age", T.DoubleType()),
    T.StructField("Vehicle_Age", T.DoubleType()), T.StructField("Claim_Type", T.StringType()),
    T.StructField("Traffic_Condition", T.StringType()), T.StructField("Weather_Condition", T.StringType()),
    T.StructField("Vehicle_Type", T.StringType()),
])
UPLOAD_COLUMNS = tuple(f.name for f in UPLOAD_SCHEMA.fields)
