"""Data quality checks (Q1-Q6) as distributed aggregates."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight import config as K
from claimsight.functions import rules as R


class ValidationError(RuntimeError):
    """Raised when the quality gate fails; carries the report."""

    def __init__(self, message: str, report: dict):
        super().__init__(message)
        self.report = report


def missing_report(df: DataFrame, threshold: float = K.MISSING_THRESHOLD) -> DataFrame:
    """NULL count and percent per column; ``critical`` when percent > threshold*100 (Q1).

    One aggregate over all columns, then unpivoted to one row per column.
    """
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    long = wide.select("__n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(cols)])))
    pct = F.try_divide(F.col("missing") * F.lit(100.0), F.col("__n"))
    return long.select("column", "missing", pct.alias("missing_pct"),
                       (pct > F.lit(threshold * 100.0)).alias("critical"))


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical group: count and percent (Q2); NULLs compare equal.

    Rows are counted by a 128-bit hash of all columns first, so only two longs
    and a mask of NULLs are shuffled; full rows are compared only where a hash
    occurs more than once.  A hot group costs one partial row per task.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    # Hash functions skip NULLs, so where they are is part of the key.
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    keyed = df.select(F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b"),
                               nulls.alias("n")).alias("__key"), *cols)
    counts = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__c"))
    total = counts.agg(F.coalesce(F.sum("__c"), F.lit(0)).cast("bigint").alias("rows"))
    again = keyed.join(counts.where("__c > 1").select("__key"), "__key", "left_semi").drop("__key")
    groups = again.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    beyond = groups.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    return (beyond.crossJoin(total)  # one row each
            .withColumn("duplicate_pct", F.try_divide(F.col("duplicates") * F.lit(100.0), F.col("rows"))))


def type_report(df: DataFrame, with_counts: bool = True) -> DataFrame:
    """Column name and type (Q3), with the non-NULL count of each column.

    Without counts this is schema metadata only (no job); with counts it is
    one aggregate over all columns, unpivoted to one row per column.
    """
    fields = df.schema.fields
    if not with_counts:
        spark: SparkSession = df.sparkSession
        return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields],
                                     "column string, dtype string")
    wide = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"c{i}").alias("non_null")) for i, f in enumerate(fields)])))


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns (Q6)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))


def quality_gate(df: DataFrame, threshold: float = K.MISSING_THRESHOLD) -> DataFrame:
    """The gate of the preparation as one row (Q4): rows, columns, missing cells, columns that miss
    more than ``threshold`` of their values, duplicate rows, and whether the table passes (no such column)."""
    miss = missing_report(df, threshold).agg(
        F.sum("missing").alias("missing_cells"),
        F.array_sort(F.collect_list(F.when(F.col("critical"), F.col("column")))).alias("critical_columns"))
    return (duplicate_report(df).crossJoin(miss)  # one row each; the list is bounded by the schema
            .select(F.col("rows").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), "missing_cells",
                    "critical_columns", F.col("duplicates").alias("duplicate_rows"), "duplicate_pct",
                    (F.size("critical_columns") == 0).alias("passed")))


def validate(df: DataFrame, threshold: float = K.MISSING_THRESHOLD) -> dict:
    """:func:`quality_gate` as a dict; raises :class:`ValidationError` when the table does not pass."""
    report = quality_gate(df, threshold).first().asDict()
    if not report["passed"]:
        raise ValidationError("Critical missing values detected: " + ", ".join(report["critical_columns"]), report)
    return report


def validate_upload(df: DataFrame, required: Sequence[str] = K.UPLOAD_REQUIRED_COLUMNS,
                    null_pct_limit: float = K.UPLOAD_NULL_PCT_LIMIT) -> DataFrame:
    """Upload checks as one row: ``is_valid`` and the list of messages (Q5)."""
    missing_cols = [c for c in required if c not in df.columns]
    present = [c for c in required if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(F.col(c).isNull()).alias(f"n{i}")
                                                for i, c in enumerate(present)]
    a = df.agg(*aggs)
    msgs = []
    if missing_cols:
        msgs.append(F.lit("Missing required columns: " + ", ".join(missing_cols)))
    msgs.append(F.when(F.col("__n") == 0, F.lit("Uploaded file contains no data")))
    for i, c in enumerate(present):
        pct = F.col(f"n{i}") * F.lit(100.0) / F.col("__n")
        msgs.append(F.when((F.col("__n") > 0) & (F.col(f"n{i}") > 0) & (pct > null_pct_limit),
                           F.concat(F.lit(f"{c} has "), R.fixed(pct, 1),
                                    F.lit(f"% missing values (threshold: {null_pct_limit:g}%)"))))
    errors = F.filter(F.array(*msgs), lambda x: x.isNotNull())
    return a.select((F.size(errors) == 0).alias("is_valid"), errors.alias("errors"))
