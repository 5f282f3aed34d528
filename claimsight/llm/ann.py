"""Nearest neighbours by collision counting (operator 2), largest inner product first.

The inner product becomes a distance by one added coordinate, sqrt(M**2 - |x|**2) with M the
largest norm, so that all stored vectors have norm M; a query gets 0 there and is scaled to norm M.
Each of ``projections`` random lines gives one sorted array of projected values.  A query looks at
a window centred on its own projection in every array; virtual rehashing widens all windows by
``WIDEN`` until enough vectors lie in at least ``threshold`` of them.  Those vectors are verified with the
exact inner product on the original vectors.

Vectors are dealt into blocks and queries into groups, by hash; each pair of a block and a group is
one task that indexes its block, and the best of each block are merged per query.  Every vector is
in the index and every query meets every block.  Vectors with the same collision count pass
together, so equal vectors are verified together and ties go to the smaller id.

Vectors of different lengths have no inner product: each length is an index of its own, and a query's candidates are
the vectors of its length.  Vectors that are null, zero, or hold null or non-finite components take no part.  Rows without an
id take no part either.  Every group of queries gets a copy of every block, so the shuffle grows with blocks times groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsight.llm import common as C

#: Share of an array that the first windows hold on average, and the factor by which a round widens them.
START_SHARE, WIDEN = 0.54, 1.1
#: Vectors verified per query and block at least, besides the share.
LEAST_VERIFIED = 200
#: Vectors per block and queries per group.
BLOCK_ROWS, GROUP_ROWS = 4096, 1024


def lines(dim: int, projections: int) -> np.ndarray:
    """Random directions, the same in every task."""
    return np.random.default_rng(20240501).standard_normal((dim, projections))


class Index:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top_norm: float, projections: int) -> None:
        order = np.argsort(ids)
        self.ids, self.vectors, self.top_norm = ids[order], vectors[order], top_norm
        rest = np.sqrt(np.maximum(top_norm ** 2 - (self.vectors ** 2).sum(axis=1), 0))
        self.lines = lines(vectors.shape[1] + 1, projections)
        values = np.hstack([self.vectors, rest[:, None]]) @ self.lines
        order = np.argsort(values, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(values.T, order, axis=1)
        kind = np.uint16 if len(self.ids) < 1 << 16 else np.uint32
        self.place = np.empty(order.shape, kind)  # of each vector in each sorted array
        np.put_along_axis(self.place, order, np.arange(len(self.ids), dtype=kind)[None, :], axis=1)

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int, threshold: int,
               verify_share: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query: ids and exact scores of its best ``k`` verified vectors, the query's own id left out."""
        n = len(self.ids)
        scaled = queries * (self.top_norm / np.linalg.norm(queries, axis=1))[:, None]
        centres = scaled @ self.lines[:-1]
        wanted = min(n, k + 1 + max(LEAST_VERIFIED, int(np.ceil(verify_share * n))))
        thin = self.sorted[:, ::max(1, n // 64)]
        half = np.array([np.quantile(abs(thin - c[:, None])[::4], START_SHARE) for c in centres])
        kind = self.place.dtype
        offset, inside = np.empty_like(self.place), np.empty(self.place.shape, bool)
        out: list[tuple[np.ndarray, np.ndarray]] = [None] * len(queries)
        open_ = np.arange(len(queries))
        while len(open_):  # every round widens the windows of the queries that have too few vectors
            c, h = centres[open_].T, half[open_]
            lo = np.array([s.searchsorted(x - h, "left") for s, x in zip(self.sorted, c)]).T
            hi = np.array([s.searchsorted(x + h, "right") for s, x in zip(self.sorted, c)]).T
            more = []
            for i, a, z in zip(open_, lo, hi):
                # Inside a window: the place lies between its borders (one unsigned comparison).
                np.subtract(self.place, a[:, None].astype(kind), out=offset)
                np.less(offset, (z - a)[:, None].astype(kind), out=inside)
                found = np.flatnonzero(np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8) >= threshold)
                if len(found) < wanted and (z - a).min() < n:
                    more.append(i)
                    continue
                found = found[self.ids[found] != query_ids[i]]
                scores = self.vectors[found] @ queries[i]
                best = np.lexsort((self.ids[found], -scores))[:k]
                out[i] = (self.ids[found[best]], scores[best])
            open_ = np.array(more, int)
            half[open_] = np.maximum(half[open_] * WIDEN, 1e-9 * self.top_norm)
        return out


def search(vectors: DataFrame, is_query: str, k: int, id: str, vector: str, projections: int = 160,
           threshold: int = 96, verify_share: float = 0.15, block_rows: int = BLOCK_ROWS,
           group_rows: int = GROUP_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` largest inner products found for
    every row where the SQL condition ``is_query`` holds; candidates are all rows but the query's own."""
    if not 0 < threshold <= projections <= 255:
        raise ValueError("needs 0 < threshold <= projections <= 255")
    own = vectors.where(F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("id"), F.expr(f"coalesce({is_query}, false)").alias("q"),
        F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    own = own.where(F.col("v").isNotNull() & finite).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    own = own.where("norm2 > 0")
    # A row per vector length, each an index of its own: length, blocks, groups of queries, largest norm.
    lengths = own.groupBy(F.size("v").alias("d")).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)), F.lit(1)).cast("long").alias("blocks"),
        F.greatest(F.ceil(F.count_if("q") / F.lit(group_rows)), F.lit(1)).cast("long").alias("groups"), F.sqrt(F.max("norm2")).alias("top"))
    own = own.withColumn("d", F.size("v")).join(C.written(lengths, "vector-lengths"), "d")
    schema = "query_id long, vec_id long, score double"
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    stored = own.select("d", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), each("groups").alias("grp"), "id", "v", "top")
    asked = own.where("q").select(F.col("d").alias("qd"), each("blocks").alias("qblock"), F.pmod(F.xxhash64("id", F.lit(7)), F.col("groups")).alias("qgrp"),
                                  F.col("id").alias("qid"), F.col("v").alias("qv"))

    def matrix(t: pa.Table, v: str) -> np.ndarray:
        return C.column(t, v).flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)

    def run(block: pa.Table, group: pa.Table) -> pa.Table:
        q, v, s = [], [], []
        if len(block) and len(group):
            index = Index(C.column(block, "id").to_numpy(), matrix(block, "v"), C.column(block, "top")[0].as_py(), projections)
            qids = C.column(group, "qid").to_numpy()
            for qid, (ids, scores) in zip(qids, index.search(matrix(group, "qv"), qids, k, threshold, verify_share)):
                q.append(np.full(len(ids), qid))
                v.append(ids)
                s.append(scores)
        join = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t)
        return pa.table({"query_id": join(q, pa.int64()), "vec_id": join(v, pa.int64()), "score": join(s, pa.float64())})

    found = stored.groupBy("d", "block", "grp").cogroup(asked.groupBy("qd", "qblock", "qgrp")).applyInArrow(run, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
