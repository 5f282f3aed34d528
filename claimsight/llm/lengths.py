"""Token counts by an exact length histogram (operator 7).

Documents are aggregated by encoded length; suffix sums over the histogram then answer, for any
context limit L: how many documents are longer, how many tokens all documents have, how many are
left when each is truncated to L, and the quantile that L is.  Nothing is estimated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Distinct lengths per block of the two-level suffix sums.
BLOCK = 1024


def histogram(counts: DataFrame, length: str = "n_tokens") -> DataFrame:
    """``n_tokens``, ``n_docs``: one row per distinct length. Null lengths are left out."""
    return (counts.where(F.col(length).isNotNull())
            .groupBy(F.col(length).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs")))


def with_suffix_sums(hist: DataFrame) -> DataFrame:
    """Per distinct length L, taken as a context limit:

    ``n_docs`` of that length, ``docs_at_most`` and ``docs_longer``, ``total_tokens`` of all
    documents, ``tokens_at_most`` in documents of at most L, ``truncated_tokens`` = sum of
    min(length, L), ``lost_tokens``, and ``quantile`` = share of documents of at most L.

    Two levels: sums per block of 1,024 lengths, then prefix sums over the few blocks and inside
    each block, so no task holds the whole histogram.  An empty histogram gives no rows.
    """
    hist = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("bt"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("bd").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("bt").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("bd").over(every).alias("all_docs"), F.sum("bt").over(every).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    return (hist.withColumns({
                "d": F.sum("n_docs").over(inside),
                "t": F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside)})
            .join(blocks, "block")
            .select(F.col("n_tokens").alias("context_limit"), "n_docs",
                    (F.col("docs_before") + F.col("d")).alias("docs_at_most"),
                    (F.col("all_docs") - F.col("docs_before") - F.col("d")).alias("docs_longer"),
                    "total_tokens",
                    (F.col("tokens_before") + F.col("t")).alias("tokens_at_most"), "all_docs")
            .select("context_limit", "n_docs", "docs_at_most", "docs_longer", "total_tokens", "tokens_at_most",
                    (F.col("tokens_at_most") + F.col("docs_longer") * F.col("context_limit")).alias("truncated_tokens"),
                    (F.col("total_tokens") - F.col("tokens_at_most")
                     - F.col("docs_longer") * F.col("context_limit")).alias("lost_tokens"),
                    (F.col("docs_at_most") / F.col("all_docs")).alias("quantile")))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Totals for the given context limits (a few), whether or not a document has that length."""
    spark = hist.sparkSession
    wanted = F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("context_limit")
    return (hist.select("n_tokens", "n_docs", wanted).groupBy("context_limit").agg(
        F.sum("n_docs").alias("n_docs"),
        F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_longer"),
        F.sum(F.col("n_docs") * F.col("n_tokens")).alias("total_tokens"),
        F.sum(F.col("n_docs") * F.least("n_tokens", F.col("context_limit").cast("long"))).alias("truncated_tokens")))
