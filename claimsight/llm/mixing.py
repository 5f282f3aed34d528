"""Mixing sources to target weights (operator 6), with DataFrame functions only.

Temperature mixing: with token shares p of the sources, the weights are p**a, normalised.  The
exponent a in [0, 1] is found by bisection (many points at a time): the largest one whose weights
reach ``target_entropy`` (as a share of the largest possible entropy), raised if needed so that no
source is repeated more than ``max_repeats`` times within the budget; a = 1 keeps the shares.

The weights are realised as budgeted block permutations.  A source's documents are dealt into
blocks of about ``block_docs`` by a hash; every epoch of a source visits its blocks in an order of
its own, and documents inside a block in hash order.  A source's schedule is cut where its token
budget, weight x total budget, is used up: a copy is taken when the tokens before it are fewer
than the budget, so a source misses its budget by less than one document.

A null source is a source of its own.  A source without tokens has weight 0 and no copies.  No
task holds a source: windows run over one block's documents, or over the blocks of a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight.llm.common import written

#: Points per round and rounds of the bisection: the exponent is found to 16**-9.
POINTS, ROUNDS = 16, 9


def word_count(text: str | Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"[^\x20\x09-\x0D]+")),
                      F.lit(0)).cast("long")


def hash60(*parts: Column) -> Column:
    """60-bit number from the MD5 of the parts joined by ``:`` (the same in any SQL engine)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("long")


def _largest_exponent(shares: DataFrame, meets: Column) -> float:
    """Largest a in [0, 1] with ``meets``; it must hold from 0 up to some point. 0 if it never holds.

    ``meets`` may use ``z`` = sum of p**a, ``s`` = sum of p**a ln p, and ``low`` = sum-free maximum of p**(a-1).
    """
    low, high = 0.0, 1.0
    points = [1.0]
    for turn in range(ROUNDS + 1):
        tried = F.explode(F.array(*[F.lit(x) for x in points])).alias("a")
        rows = (shares.select("p", tried).groupBy("a").agg(
                    F.sum(F.pow("p", "a")).alias("z"), F.sum(F.pow("p", "a") * F.log("p")).alias("s"),
                    F.max(F.pow("p", F.col("a") - 1)).alias("most"))
                .select("a", meets.alias("ok")).collect())  # one row per point
        ok = sorted(r["a"] for r in rows if r["ok"])
        if turn == 0 and (ok or not rows):
            return 1.0
        low = ok[-1] if ok else low
        high = min([x for x in points if x > low], default=high)
        points = [low + (high - low) * k / POINTS for k in range(1, POINTS)]
    return low


def source_weights(sized: DataFrame, source: str = "source", tokens: str = "n_tokens", target_entropy: float | None = None,
                   max_repeats: float | None = None, budget: int | None = None) -> DataFrame:
    """``source``, ``docs``, ``total`` (tokens), ``weight``, ``budget`` (tokens wanted), one row per source."""
    totals = written(sized.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.coalesce(F.col(tokens), F.lit(0))).cast("long").alias("total")), "totals")
    n, total = totals.where("total > 0").agg(F.count(F.lit(1)), F.sum("total")).first()
    budget = int(total or 0) if budget is None else budget
    shares = totals.where("total > 0").select((F.col("total") / F.lit(float(total or 1))).alias("p"))
    a = 1.0
    if target_entropy is not None and n and n > 1:
        # entropy = ln z - a s / z; it falls as a grows
        entropy = F.log("z") - F.col("a") * F.col("s") / F.col("z")
        a = _largest_exponent(shares, entropy >= F.lit(target_entropy * math.log(n)))
    if max_repeats is not None and n:
        # repeats of a source = p**(a-1) / z * budget / total; the largest falls as a grows to 1
        b = F.lit(budget / total)
        too_many = F.col("most") / F.col("z") * b > F.lit(float(max_repeats))
        a = max(a, _largest_exponent(shares, too_many)) if budget / total <= max_repeats else 1.0
    power = F.when(F.col("total") > 0, F.pow(F.col("total") / F.lit(float(total or 1)), F.lit(a))).otherwise(0.0)
    z = totals.agg(F.sum(power)).first()[0] or 1.0
    return totals.withColumn("weight", power / F.lit(z)).withColumn(
        "budget", F.floor(F.col("weight") * F.lit(float(budget))).cast("long"))


def _blocked(sized: DataFrame, weights: DataFrame, id: str, source: str, block_docs: int, seed: str) -> DataFrame:
    """``sized`` with ``__ticket`` and ``__block``, and the source's row of ``weights`` as ``__w``."""
    w = weights.select(F.col("source").alias("__source"), F.struct("docs", "total", "weight", "budget").alias("__w"))
    ticket = hash60(F.lit(seed), F.col(id))
    return (sized.withColumn("__ticket", ticket).join(w, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
            .withColumn("__block", F.col("__ticket") % F.ceil(F.col("__w.docs") / F.lit(block_docs)).cast("long")))


def block_order(sized: DataFrame, weights: DataFrame, id: str = "doc_id", source: str = "source", tokens: str = "n_tokens",
                block_docs: int = 4096, seed: str = "mix") -> DataFrame:
    """``source``, ``block``, ``epoch``, ``before``: tokens of the source's schedule ahead of each visit of a block."""
    blocks = (_blocked(sized, weights, id, source, block_docs, seed)
              .groupBy(F.col(source).alias("source"), F.col("__block").alias("block"))
              .agg(F.sum(F.coalesce(F.col(tokens), F.lit(0))).alias("size"), F.first("__w").alias("w"))
              .where("w.total > 0 and w.budget > 0"))
    epochs = F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("w.budget") - 1) / F.col("w.total")).cast("long"))).alias("epoch")
    visits = blocks.select("source", "block", "size", "w", epochs)
    order = Window.partitionBy("source", "epoch").orderBy(
        F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch").cast("string"), F.col("source"), F.col("block").cast("string"))), "block"
    ).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("epoch") * F.col("w.total") + F.coalesce(F.sum("size").over(order), F.lit(0))
    return visits.select("source", "block", "epoch", before.alias("before"), F.col("w.budget").alias("budget")).where("before < budget")


def realise(sized: DataFrame, weights: DataFrame, blocks: DataFrame, keep: list[str], id: str = "doc_id",
            source: str = "source", tokens: str = "n_tokens", block_docs: int = 4096, seed: str = "mix",
            schedule: bool = True) -> DataFrame:
    """The mixture: columns ``keep`` of every copy taken; with ``schedule`` also ``epoch``, ``block``,
    ``tokens_before`` (in the source's schedule) and ``progress`` (share of the source's budget used before;
    sorting by it interleaves the sources in proportion)."""
    own = _blocked(sized, weights, id, source, block_docs, seed)
    inside = (Window.partitionBy(F.col(source), F.col("__block")).orderBy("__ticket", F.col(id))
              .rowsBetween(Window.unboundedPreceding, -1))
    own = own.withColumn("__inside", F.coalesce(F.sum(F.coalesce(F.col(tokens), F.lit(0))).over(inside), F.lit(0)))
    b = blocks.select(*[F.col(c).alias(f"__of_{c}") for c in ("source", "block", "epoch", "before", "budget")])
    at = F.col("__of_before") + F.col("__inside")
    taken = (own.join(b, F.col(source).eqNullSafe(F.col("__of_source")) & (F.col("__block") == F.col("__of_block")))
             .where(at < F.col("__of_budget")))
    if not schedule:
        return taken.select(*keep)
    return taken.select(*keep, F.col("__of_epoch").cast("int").alias("epoch"), F.col("__block").alias("block"),
                        at.alias("tokens_before"), (at / F.col("__of_budget")).alias("progress"))
