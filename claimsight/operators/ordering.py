"""Row numbers and order statistics of text keys over whole tables, without a global sort in one task."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight.plans.scoring import materialize


def numbered(df: DataFrame, key: Column, id_col: str, name: str) -> DataFrame:
    """``df`` written once, with ``__number`` 0, 1, ... in the order of ``key``, then ``id_col``.

    Range partitions are sorted on their own; a row's number is its place in its partition plus the rows of the partitions
    before it, of which there is one count per partition.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("__key", key).repartitionByRange(n, "__key", id_col).sortWithinPartitions("__key", id_col)
    # The id of a row is its partition, shifted by 33 bits, plus its place.
    w = materialize(spark, ranged.withColumn("__place", F.monotonically_increasing_id()).drop("__key"), f"{name}/{uuid.uuid4().hex}")
    w = w.withColumn("__pid", F.shiftright("__place", 33)).withColumn("__place", F.col("__place").bitwiseAND((1 << 33) - 1))
    counts = w.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__pid", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return w.join(before, "__pid").withColumn("__number", F.col("__place") + F.col("__before")).drop("__pid", "__place", "__before")


#: Digits by which a pass narrows the search, so at most 16 ** 4 counts reach the driver.
_DIGITS = 4


def smallest_hex(df: DataFrame, key: Column, k: int, final_rows: int = 10_000) -> str:
    """The least ``t`` such that at least ``k`` rows have ``key`` <= ``t``; ``key`` is text of hex digits, all of one length.

    Each pass counts the rows by the next four digits of the keys that begin with the digits found so far (one partial
    aggregate); the last one looks at the few different keys that are left.  '' for ``k`` below 1.
    """
    if k < 1:
        return ""
    keys = df.select(key.alias("key"))
    prefix, left = "", k
    while True:
        inside = keys.where(F.col("key").startswith(prefix))
        rows = sorted(inside.groupBy(F.substring("key", len(prefix) + 1, _DIGITS).alias("d")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect())
        for r in rows:
            if left <= r["n"]:
                break
            left -= r["n"]
        else:
            raise ValueError(f"fewer than {k} rows")
        prefix += r["d"]
        if r["low"] == r["high"]:
            return r["low"]
        if r["n"] <= final_rows:
            found = keys.where(F.col("key").startswith(prefix)).groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()
            for key_, n in sorted(tuple(x) for x in found):
                if left <= n:
                    return key_
                left -= n
