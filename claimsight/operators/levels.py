"""Category levels as tables, for columns with more levels than a driver should hold.

The levels of a column are counted once and written with their rank by frequency.  Values meet their slot in an
equi-join, whatever the number of levels: the commonest ``most_levels`` have slots of their own, all others (also values
that were never seen) share ``buckets`` slots by hash, or have none.  The driver gets one number per column.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsight.functions.quantiles import mode_values
from claimsight.operators.ordering import numbered
from claimsight.session import shared_path


def level_table(df: DataFrame, column: str) -> DataFrame:
    """``level, n, rank`` of a column's values, written; rank 0 is the commonest, ties by the level.  NULL is no level."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counts, -F.col("n"), "level", "levels").select("level", "n", F.col("__number").alias("rank"))


def bucket(value: Column, buckets: int) -> Column:
    """The same in any engine with MD5: its first 15 hex digits modulo ``buckets``."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 15), 16, 10).cast("long") % buckets


def with_slot(df: DataFrame, column: str, levels: DataFrame, most_levels: int, buckets: int, out: str = "slot") -> DataFrame:
    """``df`` with the slot of ``column``: its rank below ``most_levels``, else ``most_levels`` plus a hash bucket (NULL without buckets, or for NULL)."""
    own = levels.where(F.col("rank") < most_levels).select(F.col("level").alias("__level"), F.col("rank").alias("__rank"))
    value = F.col(column).cast("string")
    rest = F.lit(most_levels) + bucket(value, buckets) if buckets else F.lit(None)
    return (df.join(own, value == F.col("__level"), "left")
            .withColumn(out, F.coalesce(F.col("__rank"), F.when(value.isNotNull(), rest)).cast("long")).drop("__level", "__rank"))


def fit_level_pipeline(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], most_levels: int = 10_000,
                       buckets: int = 1024) -> PipelineModel:
    """Preprocessing like M4 whose categories are level tables: sparse ``features`` of the scaled numbers and the slots.

    The tables are written in the shared folder and named in the fitted stages, so a saved pipeline is good as long as they are.
    Missing values take the mode.  A slot per column is set aside for values that have none; the encoder drops it.
    """
    from claimsight.operators.ml import numeric_expressions, numeric_statistics
    spark = train.sparkSession
    modes = mode_values(train, list(categorical))
    exprs = numeric_expressions(numeric_statistics(train, list(numeric)))
    joins, sizes = [], []
    for i, c in enumerate(categorical):
        levels = level_table(train, c).where(F.col("rank") < most_levels).select(F.col("level").alias("__level"), F.col("rank").alias("__rank"))
        path = shared_path(spark, f"levels/{uuid.uuid4().hex}")
        levels.write.parquet(path)
        known = spark.read.parquet(path).count()
        sizes.append(known + buckets)
        fill = "NULL" if modes[c] is None else "'" + str(modes[c]).replace("\\", "\\\\").replace("'", "\\'") + "'"
        value = f"coalesce(CAST(t.`{c}` AS STRING), {fill})"
        joins.append(f"LEFT JOIN parquet.`{path}` l{i} ON l{i}.__level = {value}")
        rest = f"{known} + CAST(conv(substring(md5({value}), 1, 15), 16, 10) AS BIGINT) % {buckets}" if buckets else str(known)
        exprs.append(f"CAST(coalesce(l{i}.__rank, {rest}, {known + buckets}) AS DOUBLE) AS `__slot_{c}`")
    stages = [SQLTransformer(statement=f"SELECT t.*, {', '.join(exprs)} FROM __THIS__ t {' '.join(joins)}")]
    if categorical:
        slots = [f"__slot_{c}" for c in categorical]
        last = spark.createDataFrame([tuple(float(n - 1) for n in sizes)], ", ".join(f"`{s}` double" for s in slots))
        stages.append(OneHotEncoder(inputCols=slots, outputCols=[f"__ohe_{c}" for c in categorical], handleInvalid="keep", dropLast=True).fit(last))
    stages.append(VectorAssembler(inputCols=[f"__num_{c}" for c in numeric] + [f"__ohe_{c}" for c in categorical], outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)
