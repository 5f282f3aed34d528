"""Removal of repeated word windows (operator 9).

A window is ``width`` consecutive words (``[^\\x20\\x09-\\x0D]+``) of one document.  Every word
covered by a window whose word sequence also starts anywhere else, in another document or in the
same one, is removed; windows are judged on the input.

Every window gets a 64-bit Rabin-Karp hash.  One Spark query does the whole job:

1. documents are dealt into chunks of bounded size by a hash of the row;
2. each chunk sends its distinct window hashes, sorted and cut by hash range, as packed rows (a
   passage that a third of all rows share is sent once per chunk, so no hash range is hot);
3. each hash range finds the hashes that more than one chunk sent and returns them to those chunks;
4. each chunk meets its documents again (the same exchange, reused), adds the hashes repeated
   inside the chunk, merges overlapping repeated windows into maximal intervals and cuts them.

Two different windows count as equal only when their 64-bit hashes collide: about n**2 / 2**65 of
n windows.  Null text has no words.  Documents with fewer words than ``width`` lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.llm import common as C

#: Text bytes per chunk, aimed at; one row is never cut.
CHUNK_BYTES = 16 << 20


def pack(keys: np.ndarray) -> bytes:
    """Sorted distinct hashes as the first one, then differences in as few bytes each as the largest needs."""
    if len(keys) == 0:
        return b""
    gaps = np.diff(keys)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([width]) + keys[:1].tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    width = blob[0]
    small = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(small), 8), np.uint8)
    gaps[:, :width] = small
    first = np.frombuffer(blob, np.uint64, 1, offset=1)
    return np.cumsum(np.concatenate((first, gaps.reshape(-1).view(np.uint64))), dtype=np.uint64)


def found_in(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if len(sorted_keys) == 0:
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


class _Slice:
    """Words and window hashes of a few documents."""

    def __init__(self, texts: pa.Array, width: int) -> None:
        self.data, self.off = C.text_bytes(texts)
        self.starts, self.ends, self.first = C.find_words(self.data, self.off)
        self.h, self.at = C.windows(C.word_hashes(self.data, self.starts, self.ends), self.first, width)


def _parsed(texts: pa.Array, width: int) -> list[_Slice]:
    batch = pa.RecordBatch.from_arrays([texts], names=["t"])
    return [_Slice(C.column(b, "t"), width) for b in C.slices([batch], "t", 1 << 20)]


def cut(s: _Slice, repeated: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words and removed words per document, and the kept words joined by one space."""
    edge = np.zeros(len(s.starts) + 1, np.int64)
    hit = s.at[found_in(s.h, repeated)]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    gone = np.cumsum(edge[:-1]) > 0
    n_words = np.diff(s.first)
    before = np.concatenate(([0], np.cumsum(gone)))
    n_removed = before[s.first[1:]] - before[s.first[:-1]]
    row = np.repeat(np.arange(len(n_words)), n_words)
    starts, ends, row = s.starts[~gone], s.ends[~gone], row[~gone]
    mark = np.zeros(len(s.data) + 1, np.int8)
    mark[starts] += 1
    mark[ends] -= 1
    keep = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    data = s.data.copy()
    more = ends[:-1][row[1:] == row[:-1]] if len(row) else ends  # a kept word follows in the same document
    keep[more] = True
    data[more] = 32
    sizes = np.concatenate(([0], np.cumsum(keep)))[s.off]
    text = pa.Array.from_buffers(pa.large_string(), len(n_words),
                                 [None, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(data[keep].tobytes())])
    return n_words, n_removed, text.cast(pa.string())


def remove_repeated(docs: DataFrame, keep: list[str], width: int, text: str = "text", rejoin: bool = True,
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus ``n_words``, ``n_removed`` (long) and ``kept_text`` (the kept
    words joined by one space), one row per input row.  ``keep`` must not hold these names.

    Without ``rejoin`` a text that loses nothing stays as it is (null too).
    """
    spark = docs.sparkSession
    least = 2 * C.shuffle_partitions(spark)
    size = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(least, -(-size // chunk_bytes))
    ranges = n
    kept = [F.col(c) for c in keep]
    chunked = docs.select(F.pmod(F.xxhash64(*kept, F.col(text)), F.lit(n)).cast("int").alias("__chunk"),
                          *kept, F.col(text).alias("__text"))
    step = -(-(1 << 64) // ranges)
    limits = np.array([k * step for k in range(1, ranges)], np.uint64)

    def send(group: pa.Table) -> pa.Table:
        parsed = _parsed(C.column(group, "__text"), width)
        keys = np.unique(np.concatenate([s.h for s in parsed])) if parsed else np.zeros(0, np.uint64)
        at = np.concatenate(([0], np.searchsorted(keys, limits), [len(keys)]))
        some = np.flatnonzero(np.diff(at))
        chunk = C.column(group, "__chunk")[0].as_py() if len(group) else 0
        return pa.table({"__range": pa.array(some, pa.int32()), "__chunk": pa.array([chunk] * len(some), pa.int32()),
                         "keys": pa.array([pack(keys[at[i]:at[i + 1]]) for i in some], pa.binary())})

    def match(group: pa.Table) -> pa.Table:
        sent = [unpack(b.as_py()) for b in C.column(group, "keys")]
        every = np.sort(np.concatenate(sent))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        back = [(c.as_py(), pack(k[found_in(k, twice)])) for c, k in zip(C.column(group, "__chunk"), sent)]
        back = [(c, b) for c, b in back if b]
        return pa.table({"__chunk": pa.array([c for c, _ in back], pa.int32()),
                         "keys": pa.array([b for _, b in back], pa.binary())})

    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType())])

    def remove(group: pa.Table, hits: pa.Table) -> pa.Table:
        parsed = _parsed(C.column(group, "__text"), width) if len(group) else []
        own = np.sort(np.concatenate([s.h for s in parsed])) if parsed else np.zeros(0, np.uint64)
        repeated = [own[1:][own[1:] == own[:-1]]] + [unpack(b.as_py()) for b in C.column(hits, "keys")]
        repeated = np.unique(np.concatenate(repeated))
        done = [cut(s, repeated, width) for s in parsed]
        join = lambda i, kind: pa.concat_arrays([pa.array(d[i], kind) if i < 2 else d[i] for d in done]) \
            if done else pa.array([], kind)
        removed, texts = join(1, pa.int64()), join(2, pa.string())
        if not rejoin:
            texts = pc.if_else(pc.equal(removed, 0), C.column(group, "__text"), texts)
        out = [C.column(group, c) for c in keep] + [join(0, pa.int64()), removed, texts]
        return pa.table(out, names=schema.names)

    sent = chunked.groupBy("__chunk").applyInArrow(send, "__range int, __chunk int, keys binary")
    hits = sent.groupBy("__range").applyInArrow(match, "__chunk int, keys binary")
    return chunked.groupBy("__chunk").cogroup(hits.groupBy("__chunk")).applyInArrow(remove, schema)
