"""Byte-level BPE encoding and decoding with tiktoken and a local rank file (operator 5).

Each match of the splitting pattern is encoded separately, without special tokens, exactly as
``Encoding.encode_ordinary`` does on the whole text.  Long texts are first cut where a match of
the pattern is sure to end, so that pieces stay short; a long text without any such place (one run of letters, say) is
one piece, whose memory grows with its length:

* before a space that follows a letter, digit or punctuation mark and precedes one: no match of
  the pattern crosses that point, whatever stands before it;
* around a long run of white space: the pattern takes all of the run but its last character as
  one match (the whole run at the end of the text), so that match is encoded by itself.

Null text counts as empty: no ids, and empty bytes when decoded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.llm.common import column, slices

#: Characters from which a text is cut into parts before encoding.
PART_CHARS = 1 << 16
#: White-space runs from this length are encoded by themselves.
LONG_RUN = 512

_RUN = regex.compile(r"\p{White_Space}{%d,}" % LONG_RUN)
_SAFE = regex.compile(r"[\p{L}\p{N}\p{P}](?= [\p{L}\p{N}\p{P}])")


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read once on the driver (a fixed vocabulary of about 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=4)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def safe_parts(text: str, most: int = PART_CHARS) -> Iterator[tuple[str, bool]]:
    """Parts of ``text`` that can be encoded one by one; True marks a part that is one match of the pattern."""
    if len(text) <= most:
        if len(text) < LONG_RUN or not _RUN.search(text):
            yield text, False
            return
    at = 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from _cut(text, at, run.start(), most)
        yield text[run.start():end], True
        at = end
    yield from _cut(text, at, len(text), most)


def _cut(text: str, at: int, end: int, most: int) -> Iterator[tuple[str, bool]]:
    while end - at > most:
        safe = _SAFE.search(text, at + most - 1, end)
        if safe is None:
            break
        yield text[at:safe.end()], False
        at = safe.end()
    if at < end:
        yield text[at:end], False


def encode_text(enc: tiktoken.Encoding, text: str | None) -> list[int]:
    ids: list[int] = []
    for part, one in safe_parts(text or ""):
        ids += enc._encode_single_piece(part) if one else enc.encode_ordinary(part)
    return ids


def encode_decode(docs: DataFrame, rank_path: str, pattern: str, keep: list[str], text: str = "text",
                  decode: bool = True) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus ``n_tokens`` (long), ``ids`` (array of int) and, if
    ``decode``, ``decoded`` (binary): the bytes that the ids stand for.

    ``keep`` must not hold these names.  Row-wise: no shuffle; empty input gives no rows.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()),
                          T.StructField("ids", T.ArrayType(T.IntegerType()))]
                          + [T.StructField("decoded", T.BinaryType())] * decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value, pattern)
        for batch in slices(batches, "__text", 2 << 20):
            ids = [encode_text(enc, t.as_py()) for t in column(batch, "__text")]
            out = [column(batch, c) for c in keep]
            out += [pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))]
            if decode:
                out.append(pa.array([enc.decode_bytes(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def count_tokens(docs: DataFrame, rank_path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` plus ``n_tokens`` (long): the encoded length of each whole text."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value, pattern)
        for batch in slices(batches, "__text", 2 << 20):
            n = [len(encode_text(enc, t.as_py())) for t in column(batch, "__text")]
            yield pa.RecordBatch.from_arrays([column(batch, c) for c in keep] + [pa.array(n, pa.int64())],
                                             names=schema.names)

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
