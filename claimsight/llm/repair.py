"""Repair of damaged conversations at least cost (operator 13).

A conversation's rows are edited until the initials of their roles read ``(s?(ua)+)?``.  Keep costs
nothing, Rerole (to user or assistant) 3, Delete 4, Insert (an empty user or assistant row, anywhere) 3; a
truncated row that is not deleted costs 3 more; blank and duplicate rows must be deleted.  Of the cheapest edit
lists the ASCII-least one is emitted.

The dynamic program runs over four states (nothing yet, after system, after user, after assistant).
Backwards, only the cost vectors at every square root of the rows are stored; walking forward, the vectors of one block
are recomputed from the checkpoint at its end and the least tight edit is taken at every step.

Rows are range-partitioned by conversation and order, so a conversation of any length is split over tasks.
Those that lie inside one partition and one block of rows (nearly all) are solved where they are read.  The others
are kept as blocks of rows; each block is summed up as a 4 x 4 min-plus matrix, the vectors at the ends of the blocks follow from a
stream over matrices, blocks are then walked on their own for every state they may begin in, and
a last stream per conversation joins the pieces.  Only that stream, which an SHA-256 of the whole text
forces to be sequential, has a conversation in one task; it holds one block at a time.

* Rows are taken by turn, nulls first, then by role, MD5 of the text, and place in the input.
* A blank row has nothing but ``[\\x20\\x09-\\x0D]``; a duplicate has the role and text of an earlier row; a truncated one ends
  (but for blanks) with neither of ``.!?``.  The first that holds counts.
* Null role or text counts as empty.  Rows with a null conversation form one conversation.  An empty role has no initial.
* Rows that are not ``present`` only make sure that their conversation has a result: zeros, empty edits.
* Empty tables give empty results.  Other columns, whatever their names, have no effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.llm import common as C

RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, repaired string")
#: A block ends at this many rows or, with the row that passes it, at this much text.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. An inserted or reroled row leads to ...
STEP = (2, 2, 3, 2)
#: ... and a kept one, by its initial, to one of these.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLE = {2: "user", 3: "assistant"}
#: Cost of the rows to insert after the last one; states 0 and 3 may end.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, ...]


def initial(role: str) -> str:
    return role[:1]


def fault(role: str, text: str, seen: set[tuple[str, str]] | None, again: bool = False) -> str:
    """``b`` (blank), ``d`` (duplicate: in ``seen`` or known to come ``again``), ``t`` (truncated) or ``-``."""
    solid = text.rstrip(WHITE)
    if not solid:
        return "b"
    if again or seen is not None and (role, text) in seen:
        return "d"
    if seen is not None:
        seen.add((role, text))
    return "-" if solid[-1] in ".!?" else "t"


def before(row: str, after: Vector) -> Vector:
    """Least costs from each state before a row (its initial, if any, and fault), given those after it."""
    what = row[-1]
    least = [DELETE + v for v in after]
    if what not in "bd":
        more = TRUNCATED if what == "t" else 0
        for s in range(4):
            to = KEPT[s].get(row[:-1])
            kept = NEVER if to is None else KEEP + more + after[to]
            least[s] = min(least[s], kept, REROLE + more + after[STEP[s]])
    return tuple(min(least[s], INSERT + least[STEP[s]], 2 * INSERT + least[STEP[STEP[s]]]) for s in range(4))


def walk(rows: list[str], end: Vector, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits of ``rows`` from ``state`` and the state they lead to.

    ``end`` holds the costs after the rows; ``last`` tells whether the conversation ends there.  Vectors are stored at
    every square root of the rows only and recomputed block by block.
    """
    n = len(rows)
    step = isqrt(n) + 1
    stored, v = {}, end
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i == n - 1:
            stored[i // step] = v
        v = before(rows[i], v)
    out = []
    for block in range(-(-n // step)):
        some = rows[block * step:(block + 1) * step]
        vectors = [stored[block]]
        for row in reversed(some):
            vectors.append(before(row, vectors[-1]))
        vectors.reverse()
        i = 0
        while i < len(some):
            row, now, after = some[i], vectors[i], vectors[i + 1]
            left, to = now[state], KEPT[state].get(row[:-1])
            more = TRUNCATED if row[-1] == "t" else 0
            if left == DELETE + after[state]:
                out.append("D")
                i += 1
            elif left == INSERT + now[STEP[state]]:
                out.append("I")
                state = STEP[state]
            elif to is not None and row[-1] not in "bd" and left == KEEP + more + after[to]:
                out.append("K")
                state, i = to, i + 1
            else:
                out.append("R")
                state, i = STEP[state], i + 1
    while last and END[state]:
        out.append("I")
        state = STEP[state]
    return "".join(out), state


def matrix(rows: list[str]) -> list[Vector]:
    """Min-plus matrix of a block: costs from each state before it to each state after it."""
    columns = []
    for s in range(4):
        v: Vector = tuple(0 if k == s else NEVER for k in range(4))
        for row in reversed(rows):
            v = before(row, v)
        columns.append(v)
    return [tuple(c[s] for c in columns) for s in range(4)]


def lines(edits: str, rows: Iterable[tuple[str, str]], state: int) -> tuple[list[str], int]:
    """Repaired ``role:text`` lines and the state after them."""
    rows, out = iter(rows), []
    for e in edits:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        state = KEPT[state][initial(role)] if e == "K" else STEP[state]
        out.append(f"{role if e == 'K' else ROLE[state]}:{text}")
    return out, state


@dataclass
class Whole:
    """What is gathered of one conversation, block by block."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    previous: str | None = None
    cost: int = 0
    state: int = 0
    audit: list[str] = field(default_factory=list)
    digest: "hashlib._Hash" = field(default_factory=hashlib.sha256)
    kept: list[str] = field(default_factory=list)
    some: bool = False

    def faults(self, rows: list[str]) -> None:
        for row in rows:
            self.blank += row[-1] == "b"
            self.duplicate += row[-1] == "d"
            self.truncated += row[-1] == "t"
            if self.previous is not None and self.previous + row[:-1] not in LEGAL:
                self.illegal += 1
            self.previous = row[:-1]

    def times(self, turns: Iterable[int | None]) -> None:
        for t in turns:  # ascending
            if t is not None and t != self.high:
                self.turns, self.high = self.turns + 1, t
                self.low = t if self.low is None else self.low

    def edits(self, edits: str, rows: list[str], content: Iterable[tuple[str, str]], text: bool) -> None:
        self.audit.append(edits)
        faults = iter(rows)
        for e in edits:
            self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[e]
            if e != "I" and next(faults)[-1] == "t" and e != "D":
                self.cost += TRUNCATED
        out, self.state = lines(edits, content, self.state)
        if out:
            part = "\n".join(out)
            self.digest.update((("\n" if self.some else "") + part).encode())
            self.some = True
            if text:
                self.kept.append(part)

    def result(self, text: bool) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit),
                self.digest.hexdigest(), "\n".join(self.kept) if text else None)


def solve(rows: list[tuple[int | None, str, str]], text: bool = False) -> tuple:
    """Results (the columns of ``RESULT``) of one conversation that fits in memory: rows of turn, role, text in order."""
    seen: set[tuple[str, str]] = set()
    short = [initial(role) + fault(role, t, seen) for _, role, t in rows]
    whole = Whole()
    whole.faults(short)
    whole.times(turn for turn, _, _ in rows)
    whole.edits(walk(short, END, 0, True)[0], short, ((role, t) for _, role, t in rows), text)
    return whole.result(text)


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``rows`` with faults set by ``crc32(conv:turn) % 20``; nulls (but of ``conv`` and ``turn`` themselves) become one space.

    0: the row goes (``present`` is false), 1: empty text, 2: no ``.!?`` in the text, 3: the row comes twice, 4: role user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    new_text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(blank(text), ".!?", "")).otherwise(blank(text))
    out = rows.select(F.col(conv), F.col(turn), F.when(kind == 4, F.lit("user")).otherwise(blank(role)).alias(role),
                      new_text.alias(text), (kind != 0).alias("present"), F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("__copies"))
    return out.select(conv, turn, role, text, "present", F.explode("__copies").alias("__copy")).drop("__copy")


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    own = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(present, F.lit(False)).alias("present"))
    # The place splits rows that are alike in everything else over range partitions.
    own = own.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary")))).withColumn("place", F.monotonically_increasing_id())
    order = ["conv", "turn", "role", "key", "place"]
    return (own.repartitionByRange(C.shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
            .select("conv", "turn", "role", "text", "present", F.spark_partition_id().alias("pid")))


ROWS = "array<struct<turn:long,role:string,text:string>>"
_ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_RESULT_TYPES = [pa.int64()] * 6 + [pa.string()] * 3


def _first_pass(ordered: DataFrame, text: bool, block_rows: int, block_bytes: int) -> DataFrame:
    """Results of conversations that lie inside one partition and block; blocks of ``rows`` of all others."""
    schema = T.StructType([ordered.schema["conv"], *T.StructType.fromDDL(f"pid int, block int, rows {ROWS}, {RESULT}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type = None
        done: list[tuple] = []
        pid = block = 0
        held: list[tuple] = []
        size, first, whole, name = 0, True, True, None  # whole: begins inside this partition and has no block behind it

        def close(ends: bool) -> None:
            nonlocal block, held, size
            if ends and whole:
                done.append((name, None, None, None, *solve(held, text)))
            else:
                done.append((name, pid, block, [dict(zip(("turn", "role", "text"), r)) for r in held], *[None] * 9))
                block += 1
            held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if done:
                cols = list(zip(*done))
                types = [conv_type, pa.int32(), pa.int32(), pa.list_(_ROW), *_RESULT_TYPES]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.names)
                done.clear()

        for batch in C.slices(batches, "text", 2 << 20):
            conv_type = batch.schema.field("conv").type
            for conv, turn, role, t, there, pid in zip(*(C.column(batch, c).to_pylist() for c in ("conv", "turn", "role", "text", "present", "pid"))):
                if first or conv != name:
                    if not first:
                        close(True)
                    whole, name, first = not first, conv, False
                if there:
                    held.append((turn, role, t))
                    size += len(t)
                    if len(held) >= block_rows or size >= block_bytes:
                        close(False)
                        whole = False
            yield from flush()
        if not first:
            close(False)
            yield from flush()

    return ordered.mapInArrow(run, schema)


def _repeats(blocks: DataFrame) -> DataFrame:
    """``pid``, ``block``, ``again``: places of rows whose role and text occur earlier in their conversation."""
    each = blocks.select("conv", "pid", "block", F.posexplode("rows").alias("at", "r"))
    each = each.select("conv", F.struct("pid", "block", "at").alias("where"),
                       F.concat(F.md5(F.col("r.role").cast("binary")), F.md5(F.col("r.text").cast("binary"))).alias("key"))
    first = each.groupBy("conv", "key").agg(F.min("where").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("conv").alias("of"), F.col("key").alias("same"), "first")
    later = each.join(first, F.col("conv").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same"))).where("where > first")
    return later.groupBy("where.pid", "where.block").agg(F.collect_list("where.at").alias("again"))  # at most one block's rows


def _short_rows(rows: pa.Array, again: pa.Array) -> Iterator[list[str]]:
    for some, places in zip(rows.to_pylist(), again.to_pylist()):
        twice = set(places or ())
        yield [initial(r["role"]) + fault(r["role"], r["text"], None, i in twice) for i, r in enumerate(some)]


def _matrices(blocks: DataFrame) -> DataFrame:
    """``conv``, ``pid``, ``block``, ``short`` (initial and fault of each row), ``m`` (min-plus matrix)."""
    schema = T.StructType([blocks.schema["conv"], *T.StructType.fromDDL("pid int, block int, short array<string>, m array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                short = next(_short_rows(C.column(one, "rows"), C.column(one, "again")))
                m = [v for row in matrix(short) for v in row]
                yield pa.RecordBatch.from_arrays([*(C.column(one, c) for c in ("conv", "pid", "block")),
                                                  pa.array([short], pa.list_(pa.string())), pa.array([m], pa.list_(pa.int64()))], names=schema.names)

    return blocks.select("conv", "pid", "block", "rows", "again").mapInArrow(run, schema)


def _ends(matrices: DataFrame) -> DataFrame:
    """Adds ``end`` (costs after the block) and ``last`` (whether it is its conversation's last): a stream, last block first."""
    ordered = matrices.repartition("conv").sortWithinPartitions("conv", F.desc("pid"), F.desc("block"))
    schema = T.StructType([*matrices.schema.fields, *T.StructType.fromDDL("end array<long>, last boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, v = None, True, END
        for batch in batches:
            ends, lasts = [], []
            for conv, m in zip(C.column(batch, "conv").to_pylist(), C.column(batch, "m").to_pylist()):
                new = first or conv != name
                if new:
                    name, first, v = conv, False, END
                ends.append(list(v))
                lasts.append(new)
                v = tuple(min(m[4 * s + k] + v[k] for k in range(4)) for s in range(4))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.list_(pa.int64())), pa.array(lasts)], names=schema.names)

    return ordered.mapInArrow(run, schema)


def _walks(ended: DataFrame) -> DataFrame:
    """``pid``, ``block``, ``short``, ``audits``: the edits of each block for each state that it may begin in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [[walk(short, tuple(end), s, last)[0] for s in range(4)]
                     for short, end, last in zip(*(C.column(batch, c).to_pylist() for c in ("short", "end", "last")))]
            yield pa.RecordBatch.from_arrays([*(C.column(batch, c) for c in ("pid", "block", "short")), pa.array(every, pa.list_(pa.string()))],
                                             names=["pid", "block", "short", "audits"])

    return ended.select("pid", "block", "short", "end", "last").mapInArrow(run, "pid int, block int, short array<string>, audits array<string>")


def _last_pass(blocks: DataFrame, walks: DataFrame, text: bool) -> DataFrame:
    """Results of the conversations in ``blocks``: a stream over each one's blocks in order."""
    ordered = blocks.join(walks, ["pid", "block"]).repartition("conv").sortWithinPartitions("conv", "pid", "block")
    schema = T.StructType([blocks.schema["conv"], *T.StructType.fromDDL(RESULT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, whole, conv_type = None, None, None

        def flush() -> pa.RecordBatch:
            cols = [(name,), *((v,) for v in whole.result(text))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [conv_type, *_RESULT_TYPES])], names=schema.names)

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                conv, rows, short, audits = (C.column(one, c).to_pylist()[0] for c in ("conv", "rows", "short", "audits"))
                if whole is None or conv != name:
                    if whole is not None:
                        yield flush()
                    name, whole = conv, Whole()
                whole.faults(short)
                whole.times(r["turn"] for r in rows)
                whole.edits(audits[whole.state], short, ((r["role"], r["text"]) for r in rows), text)
        if whole is not None:
            yield flush()

    return ordered.select("conv", "rows", "short", "audits").mapInArrow(run, schema)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None, with_text: bool = False, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per conversation: ``conv`` (under its own name) and the columns of ``RESULT``; ``repaired`` is null unless ``with_text``."""
    ordered = _ordered(rows, conv, turn, role, text, F.lit(True) if present is None else present)
    first = C.written(_first_pass(ordered, with_text, block_rows, block_bytes), "conversations")
    blocks = first.where("rows is not null").select("conv", "pid", "block", "rows")
    known = blocks.join(_repeats(blocks), ["pid", "block"], "left")
    matrices = C.written(_matrices(known), "conversation-matrices")
    walks = C.written(_walks(_ends(matrices)), "conversation-walks")
    out = first.where("rows is null").drop("pid", "block", "rows").unionByName(_last_pass(blocks, walks, with_text))
    return out.withColumnRenamed("conv", conv)
