"""Contiguous shards of equal byte size from global prefix sums (operator 12).

Documents are ordered by id and get the number of bytes before them in the whole corpus.  That number comes in two
parts: a running sum inside each range partition, and the totals of the partitions before it, of
which there is one row per partition.  The corpus is cut at equal byte targets; a document belongs to the
shard in whose span the middle of its bytes lies.  So shards are contiguous, and the size of each is
within the largest document of the target.

Only ids, sizes and checksums are shuffled, never texts.  No group is kept whole: equal texts may lie in
different shards, and a shard may be empty if documents are larger than the target.

* Null text counts as empty.  Rows with a null id come first.
* Rows of one id are ordered by size, checksum and place in the input, which also splits a repeated id (or many null ids) over range partitions.
* An empty table gives no rows.  Other columns, whatever their names, have no effect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimsight.llm import common as C


def sized(docs: DataFrame, id: str, text: str, extra: int) -> DataFrame:
    """``id``, ``size`` (UTF-8 bytes plus ``extra``), ``crc`` and ``place`` (of the row in the input)."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(F.col(id).alias("id"), (F.octet_length(data).cast("long") + extra).alias("size"), F.crc32(data).alias("crc"),
                       F.monotonically_increasing_id().alias("place"))


def _running(rows: DataFrame, order: list[str]) -> DataFrame:
    """Range partitions in ``order``, with bytes and rows before each row of its partition and the partition's number."""
    ranged = (rows.repartitionByRange(C.shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
              .withColumn("pid", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField("bytes_in", T.LongType()), T.StructField("rows_in", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = 0, 0
        for batch in batches:
            size = C.column(batch, "size").to_numpy()
            ends = held + np.cumsum(size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - size), pa.array(np.arange(n, n + len(size)))], names=schema.names)
            held, n = held + int(size.sum()), n + len(size)

    return ranged.mapInArrow(run, schema)


def prefix_sums(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``size``) plus ``bytes_before``, ``rows_before`` and ``total`` of the whole table in ``order``."""
    running = C.written(_running(rows, order), "running-sizes")
    totals = running.groupBy("pid").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    every = Window.orderBy("pid")  # one row per range partition
    below = every.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("pid", F.coalesce(F.sum("b").over(below), F.lit(0)).alias("b_off"),
                            F.coalesce(F.sum("n").over(below), F.lit(0)).alias("n_off"),
                            F.sum("b").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    offsets = C.written(offsets, "offsets")
    return running.join(offsets, "pid").select(
        *rows.columns, (F.col("bytes_in") + F.col("b_off")).alias("bytes_before"), (F.col("rows_in") + F.col("n_off")).alias("rows_before"), "total")


def shards(docs: DataFrame, n: int, id: str = "doc_id", text: str = "text", extra: int = 16) -> DataFrame:
    """``id`` (under its own name), ``size``, ``crc``, ``shard`` (0 to ``n`` - 1) and ``slot`` (place in the shard, from 0)."""
    placed = prefix_sums(C.written(sized(docs, id, text, extra), "sizes"), ["id", "size", "crc", "place"])
    shard = F.expr(f"least({n - 1}L, {n}L * (2 * bytes_before + size) div greatest(2 * total, 1L))").cast("int")
    placed = C.written(placed.select("id", "size", "crc", "rows_before", shard.alias("shard")), "placed")
    firsts = C.written(placed.groupBy("shard").agg(F.min("rows_before").alias("first")), "first-rows")  # at most n rows
    return placed.join(firsts, "shard").select(
        F.col("id").alias(id), "size", "crc", "shard", (F.col("rows_before") - F.col("first")).alias("slot"))
