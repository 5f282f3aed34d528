"""Batches that count once (S7): a history table whose writes are keyed by a batch id.

Every attempt to write a batch has a folder of its own, and a commit record is written after the data.  Readers see
only committed attempts, of each batch the first one.  So a job that is run again, or that died half way and is
repeated, adds nothing twice and leaves nothing half-written to be read.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT_SCHEMA = "batch string, attempt string, committed_at timestamp_ntz"


def _folder(path: str, batch_id: str, attempt: str) -> str:
    # The prefix keeps Spark from reading an id as a date or a number.
    return f"{path}/data/batch=b-{quote(batch_id, safe='')}/attempt=a-{attempt}"


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The commit records that count: the first of each batch."""
    try:
        every = spark.read.schema(COMMIT_SCHEMA).parquet(f"{path}/_commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return every.groupBy("batch").agg(F.min(F.struct("committed_at", "attempt")).alias("c")).select("batch", "c.attempt", "c.committed_at")


def append_batch(df: DataFrame, path: str, batch_id: str) -> bool:
    """Write ``df`` as batch ``batch_id`` with a ``scored_at`` timestamp, unless that batch is committed; whether it was written."""
    spark = df.sparkSession
    if not committed(spark, path).where(F.col("batch") == batch_id).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    df.withColumns({"batch_id": F.lit(batch_id), "scored_at": F.localtimestamp()}).write.parquet(_folder(path, batch_id, attempt))
    commit(spark, path, batch_id, attempt)
    return True


def commit(spark: SparkSession, path: str, batch_id: str, attempt: str) -> None:
    row = spark.createDataFrame([(batch_id, attempt)], "batch string, attempt string").withColumn("committed_at", F.localtimestamp())
    row.coalesce(1).write.mode("append").parquet(f"{path}/_commits")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all committed batches, each once.  Folders of other attempts are pruned by their names."""
    mine = committed(spark, path).select(F.concat(F.lit("a-"), "attempt").alias("attempt"))  # one row per batch
    return spark.read.parquet(f"{path}/data").join(mine, "attempt", "left_semi").drop("batch", "attempt")
