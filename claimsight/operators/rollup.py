"""Day-level rollup of the scored claims: dashboards for any date range without reading the claims.

:func:`build` writes four small or narrow tables once; :class:`Rollup` answers from them.

* ``days``: one row per day with states that add up: counts, sums, maximum, claims over each threshold, absolute
  errors, and a sketch of the policies.
* ``histogram``: claims per day and amount bucket (the buckets grow by a sixteenth of a power of two).  For any range
  it says which bucket holds the median, and how many claims lie below it.
* ``values``: amount, day and number of claims, in the order of buckets; the exact median reads the rows of one or two
  buckets (row groups of the others are skipped by their statistics).
* ``policies``: the different policies of each day in the order of months, with the number of each month in ``months``.  Whole months of a range
  have their exact distinct count ready; only its first and last month, if cut, are counted from the pairs.

Dates are inclusive on both ends, as in P4.  Without a range claims without a date count too, but they are in no month.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight import config as K
from claimsight.functions import dates as D
from claimsight.operators.portfolio import ULT, with_moving_average

_CELLS = 4096


def amount_bucket(amount: Column) -> Column:
    """Monotone in the amount; 16 buckets per power of two.  NULL for NULL and NaN."""
    size = F.floor(F.log2(1 + F.abs(amount)) * 16).cast("int")
    return F.when(amount.isNotNull() & ~F.isnan(amount), F.when(amount >= 0, size).otherwise(-1 - size))


def build(scored: DataFrame, base: str, thresholds: Sequence[float] = (K.MEDIUM_SEVERITY, K.HIGH_SEVERITY), amount: str = ULT,
          prediction: str = "Predictions", key: str = "Policy_ID", date: str = "Accident_Date") -> None:
    """Write the rollup of ``scored`` under ``base``.  Every table is one aggregate with map-side partial sums."""
    own = scored.select(F.col(date).cast("date").alias("day"), F.col(amount).cast("double").alias("amount"), F.col(key).alias("policy"),
                        F.abs(F.col(amount) - F.col(prediction)).alias("error"))
    month = D.month_start("day").cast("date").alias("month")
    over = [F.count_if(F.col("amount") > t).alias(f"over_{i}") for i, t in enumerate(thresholds)]
    from_ = [F.count_if(F.col("amount") >= t).alias(f"from_{i}") for i, t in enumerate(thresholds)]
    days = own.groupBy("day").agg(F.count(F.lit(1)).alias("claims"), F.count("amount").alias("amounts"), F.sum("amount").alias("total"),
                                  F.max("amount").alias("highest"), *over, *from_, F.count("policy").alias("with_policy"), F.sum("error").alias("error"),
                                  F.count("error").alias("errors"), F.hll_sketch_agg(F.col("policy").cast("string")).alias("sketch"))
    days.withColumn("thresholds", F.lit([float(t) for t in thresholds])).write.mode("overwrite").parquet(f"{base}/days")
    counts = own.groupBy("day", amount_bucket(F.col("amount")).alias("bucket"), "amount").agg(F.count(F.lit(1)).alias("n")).where("bucket is not null")
    (counts.repartitionByRange(F.col("bucket"), F.col("amount")).sortWithinPartitions("bucket", "amount")
     .write.mode("overwrite").parquet(f"{base}/values"))
    spark = scored.sparkSession
    values = spark.read.parquet(f"{base}/values")
    values.groupBy("day", "bucket").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{base}/histogram")
    pairs = own.where("day is not null and policy is not null").select(month, "day", "policy").distinct()
    (pairs.repartitionByRange(F.col("month"), F.col("policy")).sortWithinPartitions("month", "policy")
     .write.mode("overwrite").parquet(f"{base}/policies"))
    spark.read.parquet(f"{base}/policies").groupBy("month").agg(F.count_distinct("policy").alias("policies")).write.mode("overwrite").parquet(f"{base}/months")


@dataclass
class Rollup:
    spark: SparkSession
    base: str

    def _table(self, name: str, start=None, end=None) -> DataFrame:
        df = self.spark.read.parquet(f"{self.base}/{name}")
        if start is not None:
            df = df.where(F.col("day") >= F.lit(start).cast("date"))
        if end is not None:
            df = df.where(F.col("day") <= F.lit(end).cast("date"))
        return df

    def _threshold(self, value: float) -> int:
        known = self.spark.read.parquet(f"{self.base}/days").select("thresholds").first()
        if known is None or float(value) not in known["thresholds"]:
            raise ValueError(f"the rollup was built without the threshold {value}")
        return known["thresholds"].index(float(value))

    def kpis(self, start=None, end=None) -> DataFrame:
        """G1: claims, total, mean, exact median and maximum."""
        median = self.median(start, end)
        return self._table("days", start, end).agg(
            F.coalesce(F.sum("claims"), F.lit(0)).alias("total_claims"), F.coalesce(F.sum("total"), F.lit(0.0)).alias("total_exposure"),
            (F.sum("total") / F.sum("amounts")).alias("average_claim"), F.lit(median).cast("double").alias("median_claim"), F.max("highest").alias("max_claim"))

    def tiles(self, start=None, end=None, high: float = K.HIGH_SEVERITY) -> DataFrame:
        """G3."""
        i = self._threshold(high)
        return self._table("days", start, end).agg(
            F.coalesce(F.sum("claims"), F.lit(0)).alias("total_claims"), F.coalesce(F.sum("total"), F.lit(0.0)).alias("total_exposure"),
            (F.sum("total") / F.sum("amounts")).alias("average_claim"), F.coalesce(F.sum(f"from_{i}"), F.lit(0)).alias("high_severity_count"))

    def monthly(self, metric: str, start=None, end=None, threshold: float = K.MEDIUM_SEVERITY) -> DataFrame:
        """G4-G7 with the 3-month mean: ``exposure``, ``volume``, ``severity`` (share above ``threshold``) or ``efficiency``."""
        days = self._table("days", start, end).where("day is not null")
        value = {"exposure": lambda: F.sum("total"), "volume": lambda: F.sum("with_policy"), "efficiency": lambda: F.sum("error") / F.sum("errors"),
                 "severity": lambda: F.lit(100.0) * F.sum(f"over_{self._threshold(threshold)}") / F.sum("claims")}
        if metric not in value:
            raise ValueError(f"no metric {metric!r}")
        return with_moving_average(days.groupBy(D.month_start("day").alias("Month")).agg(value[metric]().alias("value")))

    def trend(self, start=None, end=None) -> DataFrame:
        """Exact distinct policies and total per month."""
        days = self._table("days", start, end).where("day is not null")
        totals = days.groupBy(D.month_start("day").cast("date").alias("month")).agg(F.sum("total").alias("Total_Amount"))
        months = self.spark.read.parquet(f"{self.base}/months")
        cut = _cut_months(start, end)
        if cut:
            pairs = self._table("policies", start, end).where(F.col("month").isin(cut))
            months = months.where(~F.col("month").isin(cut)).union(pairs.groupBy("month").agg(F.count_distinct("policy").alias("policies")))
        return totals.join(months, "month", "left").select(F.col("month").alias("Month"), F.coalesce("policies", F.lit(0)).alias("Volume"), "Total_Amount")

    def policies(self, start=None, end=None) -> int:
        """About how many different policies have claims in the range, from the daily sketches alone."""
        days = self._table("days", start, end)
        return days.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n")).first()["n"] or 0

    def median(self, start=None, end=None) -> float | None:
        """Exact median of the amounts, linear between the middle two."""
        counts = sorted((r["bucket"], r["n"]) for r in self._table("histogram", start, end).groupBy("bucket").agg(F.sum("n").alias("n")).collect())
        n = sum(c for _, c in counts)
        if not n:
            return None
        found = []
        for rank in sorted({(n - 1) // 2, n // 2}):
            left = rank
            for bucket, c in counts:
                if left < c:
                    break
                left -= c
            found.append(_weighted_rank(self._table("values", start, end).where(F.col("bucket") == bucket), left))
        return sum(found) / len(found)


def _cut_months(start, end) -> list[dt.date]:
    """First days of the months that the range holds in part (or in whole, if they are its first or last)."""
    days = [dt.date.fromisoformat(str(d)[:10]) for d in (start, end) if d is not None]
    return sorted({d.replace(day=1) for d in days})


def _weighted_rank(values: DataFrame, rank: int, final_rows: int = 20_000) -> float:
    """The ``amount`` at a 0-based rank where each row counts ``n`` times, narrowing an even grid until few rows are left."""
    while True:
        r = values.agg(F.min("amount").alias("lo"), F.max("amount").alias("hi"), F.count(F.lit(1)).alias("rows")).first()
        if r["lo"] == r["hi"]:
            return r["lo"]
        few = r["rows"] <= final_rows
        width = (r["hi"] - r["lo"]) / _CELLS
        cell = F.col("amount") if few or not width else F.least(F.floor((F.col("amount") - F.lit(r["lo"])) / F.lit(width)), F.lit(_CELLS - 1))
        counts = sorted((x["cell"], x["n"]) for x in values.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).collect())
        for at, n in counts:
            if rank < n:
                break
            rank -= n
        if few or not width:
            return at
        values = values.where(cell == at)
