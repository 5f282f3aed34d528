"""Product codes of vectors, their nearest entries found with LAESA pivots (operator 11).

Components become integers ``floor(scale * x)`` and a vector is cut into equal consecutive parts.  Each
part position has a codebook, refined by rounds of exact integer k-means.  The nearest entry is found by
LAESA: the distances of every part to a few fixed pivots are computed once and kept with the vector.
In a round only the distances from pivots to entries are new; their differences bound each
distance from below, entries are tried in the order of that bound, and those whose bound is above the best
distance so far are never evaluated.  Bounds are lowered by more than their rounding error, so the result is the exact
nearest entry, ties to the lower index.

A round sends one row of sums per task, part, entry and position; the driver gets the codebooks only
(``entries`` times the vector length), which are all that tasks are sent.

* Vectors that are null, or hold null, NaN or infinite components, are left out.
* Codebooks start with the vectors of the smallest ids (repeated ids: in the order of their components).
  Rows with a null id are coded but never start a codebook.  With fewer vectors there are fewer entries.
* Vectors of different lengths have codebooks of their own.  A length that the number of parts does not divide
  is filled up with zeros at the end.
* Components must be below 2**29 after scaling, so that squared distances stay exact; others raise.
* Empty tables give empty results.  Other columns, whatever their names, have no effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimsight.llm import common as C

#: Largest absolute integer component: eight squared differences of parts of any usual width stay below 2**63.
LARGEST = 1 << 29
#: Integers of vectors worked on at a time.
BLOCK = 1 << 18
#: Relative slack of the bounds, far above the rounding of single-precision pivot distances.
SLACK = 1e-6


@dataclass
class Books:
    """Codebooks and pivots of one vector length: ``entries`` is parts x entries x width."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: str) -> Column:
    """Whether the vector and all its components are there and finite."""
    v = F.col(vector).cast("array<double>")
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def integers(x: np.ndarray, scale: int, parts: int) -> np.ndarray:
    """Rows of doubles as rows x parts x width integers."""
    big = np.floor(x * scale)
    if big.size and np.abs(big).max() >= LARGEST:
        raise ValueError(f"vector components must be below {LARGEST / scale} in size")
    fill = -x.shape[1] % parts
    return np.pad(big.astype(np.int64), ((0, 0), (0, fill))).reshape(len(x), parts, -1)


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` entries per part that lie far from each other: each the farthest from those chosen before."""
    out = []
    for book in entries:
        at = [0]
        far = np.square(book - book[0]).sum(axis=1)
        while len(at) < min(n, len(book)):
            at.append(int(far.argmax()))
            far = np.minimum(far, np.square(book - book[at[-1]]).sum(axis=1))
        out.append(book[at])
    return np.stack(out)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of every part to every pivot of its position: rows x parts x pivots."""
    return np.stack([np.sqrt(np.square(x - pivots[None, :, p]).sum(axis=2)) for p in range(pivots.shape[1])], axis=2).astype(np.float32)


def nearest(x: np.ndarray, to_pivots: np.ndarray, books: Books) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry and squared distance of every part, and how many distances were evaluated."""
    n, parts, _ = x.shape
    at, error, evaluated = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64), 0
    for m in range(parts):
        book = books.entries[m]
        entry = np.sqrt(np.square(books.pivots[m][:, None] - book[None]).sum(axis=2))
        mine = to_pivots[:, m].astype(np.float64)[:, :, None]
        bound = (np.abs(mine - entry) - SLACK * (mine + entry)).max(axis=1)
        order = np.argsort(bound, axis=1, kind="stable")
        bound = np.sort(np.square(np.maximum(bound, 0)) * (1 - SLACK), axis=1)
        best, which = np.full(n, np.iinfo(np.int64).max), np.full(n, len(book))
        rows = np.arange(n)
        for j in range(len(book)):
            rows = rows[bound[rows, j] <= best[rows]]
            if not len(rows):
                break
            c = order[rows, j]
            d = np.square(x[rows, m] - book[c]).sum(axis=1)
            evaluated += len(rows)
            better = (d < best[rows]) | ((d == best[rows]) & (c < which[rows]))
            best[rows[better]], which[rows[better]] = d[better], c[better]
        at[:, m], error[:, m] = which, best
    return at, error, evaluated


def _blocks(batch: pa.RecordBatch, values: str) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Rows of one vector length ``__d``, few enough at a time: length, rows, list column ``values`` as a matrix."""
    sizes = C.column(batch, "__d").to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, BLOCK // max(int(size), 1))
        for i in range(0, len(rows), step):
            some = batch.take(pa.array(rows[i:i + step]))
            flat = C.column(some, values).flatten().to_numpy(zero_copy_only=False)
            yield int(size), some, flat.reshape(len(some), len(flat) // len(some))


def seeds(vectors: DataFrame, id: str, vector: str, entries: int, scale: int, parts: int) -> dict[int, np.ndarray]:
    """First codebooks: parts of the vectors with the smallest ids, per vector length."""
    own = vectors.where(usable(vector)).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rank = F.row_number().over(Window.partitionBy(F.size("v")).orderBy("id", "v"))
    first = own.where("id is not null").withColumn("k", rank).where(F.col("k") <= entries)
    by: dict[int, list] = {}
    for r in sorted(first.collect(), key=lambda r: r["k"]):
        by.setdefault(len(r["v"]), []).append(r["v"])
    return {d: integers(np.array(v, float).reshape(len(v), d), scale, parts).transpose(1, 0, 2) for d, v in by.items()}


def _prepared(vectors: DataFrame, id: str, vector: str, keep: list[str], books: dict[int, Books], scale: int, parts: int) -> DataFrame:
    """``id``, the columns ``keep``, ``x`` (integers) and ``p`` (distances to the pivots), of vectors that have a codebook."""
    own = vectors.where(usable(vector) & F.size(vector).isin(list(books))).select(
        F.col(id).alias("__id"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(keep)],
        F.size(vector).alias("__d"), F.col(vector).cast("array<double>").alias("__v"))
    schema = T.StructType(own.schema.fields[:-1] + [T.StructField("__x", T.ArrayType(T.IntegerType())),
                                                    T.StructField("__p", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, v in _blocks(batch, "__v"):
                x = integers(v, scale, parts)
                p = pivot_distances(x, books[size].pivots)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), a[0].size).cast(pa.list_(t))
                         if a[0].size else pa.array([[]] * len(a), pa.list_(t))
                         for a, t in ((x.astype(np.int32), pa.int32()), (p, pa.float32()))]
                yield pa.RecordBatch.from_arrays([C.column(rows, c) for c in schema.names[:-2]] + lists, names=schema.names)

    return own.mapInArrow(run, schema)


def _parts(rows: pa.RecordBatch, x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    p = C.column(rows, "__p").flatten().to_numpy(zero_copy_only=False)
    return x.astype(np.int64).reshape(len(x), parts, -1), p.reshape(len(x), parts, -1)


def _sums(prepared: DataFrame, books: dict[int, Books], parts: int) -> dict[tuple[int, int, int], tuple[int, np.ndarray]]:
    """Count and sum of the parts next to every entry, by vector length, part and entry; entries in use only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for size, rows, flat in _blocks(batch, "__x"):
                x, p = _parts(rows, flat, parts)
                at, _, _ = nearest(x, p, books[size])
                _, k, width = books[size].entries.shape
                n, s = held.setdefault(size, (np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)))
                for m in range(parts):
                    one = (at[:, m][None] == np.arange(k)[:, None]).astype(np.int64)
                    n[m] += one.sum(axis=1)
                    s[m] += one @ x[:, m]
        for size, (n, s) in held.items():
            for m, e in zip(*np.nonzero(n)):
                values = np.concatenate(([n[m, e]], s[m, e]))
                w = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(w, v), pa.int32()) for v in (size, m, e)] + [pa.array(np.arange(w), pa.int32()), pa.array(values)],
                    names=["size", "part", "entry", "at", "v"])

    long = prepared.select("__d", "__x", "__p").mapInArrow(run, "size int, part int, entry int, at int, v long")
    rows = (long.groupBy("size", "part", "entry", "at").agg(F.sum("v").alias("v"))
            .groupBy("size", "part", "entry").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("v")).collect())
    return {(r["size"], r["part"], r["entry"]): (r["v"][0]["v"], np.array([x["v"] for x in r["v"][1:]], np.int64)) for r in rows}


def encode(vectors: DataFrame, id: str, vector: str, keep: list[str] | None = None, parts: int = 8, entries: int = 16,
           rounds: int = 6, scale: int = 4096, pivots: int = 4) -> tuple[DataFrame, dict[int, Books]]:
    """Codes of all usable vectors and the final codebooks, by vector length.

    The DataFrame has ``id`` and ``keep`` under their own names, ``size`` (length, the key of the codebooks),
    ``codes`` (one index per part), ``error`` (squared distance to the entries, summed over the parts).
    """
    keep = keep or []
    first = seeds(vectors, id, vector, entries, scale, parts)
    books = {d: Books(e, choose_pivots(e, pivots)) for d, e in first.items()}
    prepared = C.written(_prepared(vectors, id, vector, keep, books, scale, parts), "vector-parts")
    for _ in range(rounds if books else 0):
        new = {d: b.entries.copy() for d, b in books.items()}
        for (d, m, e), (n, s) in _sums(prepared, books, parts).items():
            new[d][m, e] = s // n
        books = {d: Books(new[d], b.pivots) for d, b in books.items()}
    schema = T.StructType(prepared.schema.fields[:-2] + [
        T.StructField("__codes", T.ArrayType(T.IntegerType())), T.StructField("__error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, flat in _blocks(batch, "__x"):
                x, p = _parts(rows, flat, parts)
                at, error, _ = nearest(x, p, books[size])
                codes = pa.FixedSizeListArray.from_arrays(pa.array(at.astype(np.int32).ravel()), parts).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [C.column(rows, c) for c in schema.names[:-2]] + [codes, pa.array(error.sum(axis=1))], names=schema.names)

    coded = prepared.mapInArrow(run, schema)
    return coded.toDF(id, *keep, "size", "codes", "error"), books
