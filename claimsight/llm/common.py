"""Shared helpers: table access, written intermediates, and word hashing over Arrow text columns.

The hashing helpers work on whole Arrow batches at once: the UTF-8 bytes of a batch are one
numpy array, words are runs of bytes other than space and 0x09-0x0D, and hashes are 64-bit
polynomials (Rabin-Karp) evaluated with wrapping uint64 arithmetic.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from claimsight.session import shared_path

#: Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text hashed at a time, which bounds the power tables.
HASH_BLOCK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads the files instead of recomputing.
    """
    spark = df.sparkSession
    path = shared_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    c = batch.column(name)
    if isinstance(c, pa.ChunkedArray):
        c = c.combine_chunks()
        c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    return c


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``most_bytes`` of ``text`` (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(column(batch, text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at, n = 0, len(batch)
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column end to end, and the offsets of its rows. Null counts as empty."""
    arr = pc.fill_null(texts, "").cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def find_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, per row, the index of its first word."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(n + 1, bool)  # True where a row begins (or the buffer ends)
    cut[off] = True
    starts = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (cut[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return starts, ends, np.searchsorted(starts, off)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = len(_POWERS.get("up", ()))
    if have < n:
        size = max(n, HASH_BLOCK + 1)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-xor-multiply), so that all bits of a hash are usable."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, from prefix sums of ``byte * BASE**position``."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        s0 = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, s0 + HASH_BLOCK, side="right")))
        span = data[s0:ends[to - 1]].astype(np.uint64) + np.uint64(1)
        up, down = _powers(len(span) + 1)
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(span * up[:len(span)], dtype=np.uint64)))
        s, e = starts[at:to] - s0, ends[at:to] - s0
        out[at:to] = (prefix[e] - prefix[s]) * down[s]
        at = to
    return mixed(out)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hash of every ``k`` consecutive items: sum of ``h[i+j] * BASE**(k-1-j)``, by doubling."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    if k == 1:
        return h.copy()
    m = k // 2
    half = rolling(h, m)
    n = len(h) - 2 * m + 1
    out = half[:n] * np.uint64(pow(BASE, m, 1 << 64)) + half[m:m + n]
    if k % 2:
        out = out[:n - 1] * np.uint64(BASE) + h[2 * m:2 * m + n - 1]
    return out


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Mixed hashes of every ``k``-word window inside one row, and the word index where each starts."""
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row_end = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(row_end - np.arange(len(h)) >= k)
    return mixed(rolling(h, k)[at]), at
