"""Deterministic train/test split (M1).

A row is in the test set when the MD5 of ``<id>-<seed>`` falls below
``fraction`` of the 128-bit range.  The decision is per row, needs no
shuffle, repeats exactly after a lost executor recomputes a partition, and is
reproducible in any SQL engine with ``md5``.  The test share is close to, not
exactly, ``fraction``.

:func:`with_exact_split` takes the rows with the smallest hashes instead, exactly
``ceil(fraction * rows)`` of them: the hash at that rank is selected in a few counting passes, then the decision is per row again.
Other rows that come or go move the limit only a little, so nearly all rows stay on their side.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsight import config as K


def md5_threshold(fraction: float) -> str:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    value = min(int(fraction * (1 << 128)), (1 << 128) - 1)
    return f"{value:032x}"


def is_test(id_col: str = "Claim_ID", fraction: float = K.TEST_SIZE, seed: int = K.RANDOM_STATE) -> Column:
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    return key < F.lit(md5_threshold(fraction))


def with_split(df: DataFrame, id_col: str = "Claim_ID", fraction: float = K.TEST_SIZE,
               seed: int = K.RANDOM_STATE) -> DataFrame:
    return df.withColumn("split", F.when(is_test(id_col, fraction, seed), "test").otherwise("train"))


def train_test_split(df: DataFrame, id_col: str = "Claim_ID", fraction: float = K.TEST_SIZE,
                     seed: int = K.RANDOM_STATE) -> tuple[DataFrame, DataFrame]:
    t = is_test(id_col, fraction, seed)
    return df.where(~t), df.where(t)


def with_exact_split(df: DataFrame, id_col: str = "Claim_ID", fraction: float = K.TEST_SIZE, seed: int = K.RANDOM_STATE) -> DataFrame:
    """``df`` with ``split``: ``test`` for exactly ``ceil(fraction * rows)`` rows, ``train`` for the others.

    Rows of one id stay together, so a repeated id at the limit may add its other rows to the test part.  Rows
    without an id are placed by a hash of all their columns.
    """
    from claimsight.operators.ordering import smallest_hex
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    own = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    key = F.coalesce(own, F.md5(F.concat(F.xxhash64(*df.columns).cast("string"), F.lit(f"-{seed}"))))
    limit = smallest_hex(df, key, math.ceil(Fraction(str(fraction)) * df.count()))
    return df.withColumn("split", F.when(key <= limit, "test").otherwise("train"))


def exact_train_test_split(df: DataFrame, id_col: str = "Claim_ID", fraction: float = K.TEST_SIZE,
                           seed: int = K.RANDOM_STATE) -> tuple[DataFrame, DataFrame]:
    both = with_exact_split(df, id_col, fraction, seed)
    return both.where("split = 'train'").drop("split"), both.where("split = 'test'").drop("split")
