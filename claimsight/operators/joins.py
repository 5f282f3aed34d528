"""Joins (J1-J3).  No side is hinted: Catalyst and AQE broadcast what they measure to be small."""

from __future__ import annotations

import functools
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_claims_policies(claims: DataFrame, policies: DataFrame,
                          on: Sequence[str] = ("Policy_ID", "Customer_ID"),
                          null_safe: bool = True, suffixes=("_x", "_y"),
                          most_null_pairs: int | None = None) -> DataFrame:
    """Inner equi-join of claims and policies.

    Duplicate policies multiply claims; with ``null_safe`` NULL keys match NULL
    keys (the pandas ``merge`` behaviour).  Non-key columns present on both
    sides get ``suffixes``.  The join strategy is left to Catalyst/AQE: a
    sort-merge join with skew splitting for a hot key, or a broadcast when AQE
    measures the policy side as small.  n claims and m policies without any key
    make n x m rows; with ``most_null_pairs`` both are counted first and more
    pairs raise.
    """
    on = list(on)
    if null_safe and most_null_pairs is not None:
        blank = " AND ".join(f"`{k}` IS NULL" for k in on)
        n, m = claims.where(blank).count(), policies.where(blank).count()
        if n * m > most_null_pairs:
            raise ValueError(f"{n} claims and {m} policies without {', '.join(on)} would make {n * m} rows")
    clash = (set(claims.columns) & set(policies.columns)) - set(on)
    left = claims.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c)
                           for c in claims.columns])
    right = policies.select(*[F.col(c).alias(f"__r_{c}") if c in on else
                              (F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c))
                              for c in policies.columns])
    cond = None
    for k in on:
        eq = left[k].eqNullSafe(right[f"__r_{k}"]) if null_safe else (left[k] == right[f"__r_{k}"])
        cond = eq if cond is None else cond & eq
    joined = left.join(right, cond, "inner")
    return joined.drop(*[f"__r_{k}" for k in on])


def null_key_rows(claims: DataFrame, policies: DataFrame, on: Sequence[str] = ("Policy_ID", "Customer_ID")) -> tuple[int, int]:
    """Rows of both sides with a NULL in some key, and so the pairs that pandas-like matching may make of them."""
    blank = F.expr(" OR ".join(f"`{k}` IS NULL" for k in on))
    return claims.where(blank).count(), policies.where(blank).count()


def merge_skewed(claims: DataFrame, policies: DataFrame, on: Sequence[str] = ("Policy_ID", "Customer_ID"),
                 nulls: str = "match", heavy_rows: int = 1_000_000, suffixes=("_x", "_y")) -> DataFrame:
    """J1 for keys that hold a large share of the claims.

    One aggregate finds the keys with more than ``heavy_rows`` claims (there are fewer than claims / ``heavy_rows`` of them).  Their claims
    are dealt by a hash of the whole row over as many slices as give each ``heavy_rows``, and only the policies with such
    a key are copied to every slice, so no task gets a whole heavy key and the other policies move once.

    ``nulls`` is the policy for NULL keys: ``match`` (NULL equals NULL, as in pandas; n x m rows, dealt over slices like any heavy key),
    ``refuse`` (raises if both sides have such rows, naming their numbers before anything is joined) or ``apart`` (such claims are left
    out of the result; :func:`null_key_rows` counts them).
    """
    if nulls not in ("match", "refuse", "apart"):
        raise ValueError(f"no policy {nulls!r} for NULL keys")
    from claimsight.plans.scoring import materialize
    on, spark = list(on), claims.sparkSession
    if nulls == "refuse":
        n, m = null_key_rows(claims, policies, on)
        if n and m:
            raise ValueError(f"{n} claims and {m} policies have a NULL in {', '.join(on)}")
    heavy = (claims.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > heavy_rows)
             .select(*on, F.ceil(F.col("__n") / F.lit(heavy_rows)).cast("int").alias("__slices")))
    heavy = materialize(spark, heavy, f"heavy_keys/{uuid.uuid4().hex}")

    def sliced(df: DataFrame) -> DataFrame:
        keys = heavy.select(*[F.col(k).alias(f"__h_{k}") for k in on], "__slices")
        same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__h_{k}")) for k in on])
        return df.join(keys, same, "left").drop(*[f"__h_{k}" for k in on])

    slice_ = F.when(F.col("__slices").isNull(), 0).otherwise(F.pmod(F.xxhash64(*claims.columns), F.col("__slices")).cast("int"))
    left = sliced(claims).withColumn("__slice", slice_).drop("__slices")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__slices"), F.lit(1)) - 1))
    right = sliced(policies).withColumn("__slice", copies).drop("__slices")
    return merge_claims_policies(left, right, [*on, "__slice"], null_safe=nulls != "apart", suffixes=suffixes).drop("__slice")


def attach_group_mean(df: DataFrame, key: str, value: str, out: str,
                      keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Group-transform mean (J2/W1): each row gets the mean of ``value`` over its ``key``.

    Rows whose key is NULL get NULL (NULL keys form no group).  Written as a
    partial aggregate instead of ``avg().over(partitionBy(key))``: a window
    over a low-cardinality key would pull every row of a key into one sorted
    task, while the aggregate shuffles one partial row per key and task.
    ``keep`` may write the means (one row per key) so that later plans read
    them instead of aggregating again.
    """
    means = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.avg(value).alias(out))
    means = keep(means) if keep else means
    return df.drop(out).join(means, F.col(key) == F.col("__key"), "left").drop("__key")


def attach_lookup(df: DataFrame, table: DataFrame, key: str, out: str) -> DataFrame:
    """Attach ``table[out]`` by ``key`` with one equi-join, whatever the size of ``table``.

    Rows with a NULL key get NULL, NULL keys of ``table`` match nothing, and of
    several rows with one key the largest value counts.
    """
    unique = (table.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key"))
              .agg(F.max(out).alias(out)))
    return df.drop(out).join(unique, F.col(key) == F.col("__key"), "left").drop("__key")


def monthly_high_share(df: DataFrame, month_col: str, amount: str, threshold: float) -> DataFrame:
    """Share (%) of claims above ``threshold`` per month, in one pass.

    The reference divides two separately grouped series aligned on month, a
    missing month giving 0; a conditional count over one grouping is the same.
    """
    return df.groupBy(month_col).agg(
        (F.lit(100.0) * F.count_if(F.col(amount) > threshold) / F.count(F.lit(1))).alias("value"))
