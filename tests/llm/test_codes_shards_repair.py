import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimsight.llm import queries, repair, sharding, vector_codes
from claimsight.llm.vector_codes import Books, choose_pivots, nearest, pivot_distances
from tests.llm import brute

RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


# ---------------------------------------------------------------------------- vector codes
def codes_by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{(id, vector): (codes, error)} and the final entries per vector length, in plain Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, books = {}, {}
    for d in {len(v) for _, v in kept}:
        some = sorted([(i, v) for i, v in kept if len(v) == d], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        whole = [[math.floor(scale * x) for x in v] + [0] * (-d % parts) for _, v in some]
        w = len(whole[0]) // parts
        cut = [[tuple(v[m * w:(m + 1) * w]) for m in range(parts)] for v in whole]
        named = [c for (i, _), c in zip(some, cut) if i is not None][:entries]
        if not named:
            continue
        book = [[c[m] for c in named] for m in range(parts)]

        def assign():
            dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
            return [[min((dist(c[m], e), k) for k, e in enumerate(book[m])) for m in range(parts)] for c in cut]

        for _ in range(rounds):
            at = assign()
            for m in range(parts):
                for k in range(len(book[m])):
                    mine = [c[m] for c, a in zip(cut, at) if a[m][1] == k]
                    if mine:
                        book[m][k] = tuple(sum(x) // len(mine) for x in zip(*mine))
        for (i, v), a in zip(some, assign()):
            out[i, tuple(v)] = ([k for _, k in a], sum(e for e, _ in a))
        books[d] = ",".join(str(x) for part in book for e in part for x in e)
    return out, books


def codes(spark, rows, **kw):
    docs = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<float>, codes int, id string")
    coded, books = vector_codes.encode(docs, "vec_id", "embedding", ["codes"], **kw)
    return coded.toDF("vec_id", "codes_before", "size", "codes", "error").collect(), books, docs


def test_codes_against_plain_integers(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.normal(size=(120, 16)))]
    rows += [(i, list(rows[0][1])) for i in range(200, 210)]  # copies: ties between entries
    rows += [(300 + i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.integers(-1, 2, size=(40, 11)))]  # another length, many ties
    rows += [(None, rows[3][1]), (5, rows[5][1]), (5, rows[6][1]), (400, []), (401, []), (500, None)]
    rows += [(501, [None] + [1.0] * 15), (502, [float("nan")] * 16), (503, [float("inf")] * 16), (504, [0.0] * 16), (505, [-0.0001] * 16)]
    got, books, _ = codes(spark, rows)
    want, digests = codes_by_hand(rows)
    assert len(got) == len([1 for _, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)])
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append((r["codes"], r["error"]))
    expected = {}
    for i, v in rows:
        if (i, tuple(v or [])) in want and v is not None:
            expected.setdefault(i, []).append(want[i, tuple(v)])
    assert {i: sorted(v) for i, v in by_id.items()} == {i: sorted(v) for i, v in expected.items()}
    assert {d: b.digest() for d, b in books.items()} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in digests.items()}
    assert all(r["codes_before"] == 7 for r in got)


def test_codes_of_few_and_no_vectors(spark):
    got, books, _ = codes(spark, [(3, [1.0] * 8), (1, [2.0] * 8)])
    assert sorted((r["vec_id"], r["codes"], r["error"]) for r in got) == [(1, [0] * 8, 0), (3, [1] * 8, 0)]
    got, books, _ = codes(spark, [(3, None)])
    assert got == [] and books == {}
    got, books, _ = codes(spark, [(None, [1.0] * 8)])  # no id to start a codebook with
    assert got == [] and books == {}
    with pytest.raises(Exception, match="must be below"):
        codes(spark, [(1, [1e9] * 8)])[0]


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.integers(1, 4), st.sampled_from([2, 50, 4000, 1 << 28]))
def test_nearest_entry_is_exact(seed, width, size):
    rng = np.random.default_rng(seed)
    x = rng.integers(-size, size, (200, 2, width))
    book = rng.integers(-size, size, (2, 16, width))
    book[:, 9] = book[:, 2]  # equal entries: the lower index wins
    books = Books(book, choose_pivots(book, 4))
    at, error, evaluated = nearest(x, pivot_distances(x, books.pivots), books)
    dist = np.square(x[:, :, None] - book[None]).sum(axis=3)
    assert (at == dist.argmin(axis=2)).all() and (error == dist.min(axis=2)).all()
    assert evaluated <= dist.size


def test_pivots_spare_evaluations():
    rng = np.random.default_rng(1)
    book = rng.integers(-4000, 4000, (8, 16, 8))
    x = book[:, rng.integers(0, 16, 1000)].transpose(1, 0, 2) + rng.integers(-300, 300, (1000, 8, 8))
    books = Books(book, choose_pivots(book, 4))
    _, _, evaluated = nearest(x, pivot_distances(x, books.pivots), books)
    assert evaluated < 0.3 * x.shape[0] * 8 * 16


# ---------------------------------------------------------------------------- shards
def shards_by_hand(rows, n):
    data = sorted(((i is not None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows))
    total, before, out = sum(r[2] for r in data), 0, []
    slots = {}
    for there, i, size, crc in data:
        shard = min(n - 1, n * (2 * before + size) // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i if there else None, size, crc, shard, slots[shard]))
        before += size
    return out


@pytest.mark.parametrize("n", [1, 7, 40])
def test_shards_against_plain_prefix_sums(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(400), rng.choice([None, "", "é" * rng.randrange(90), "w " * rng.randrange(300)])) for _ in range(600)]
    rows += [(None, "n" * k) for k in range(300)] + [(7, "same")] * 300
    docs = spark.createDataFrame([(i, t, 1, "s", 2, 3) for i, t in rows], "doc_id long, text string, size int, id string, pid int, total int")
    out = sharding.shards(docs.repartition(9), n)
    assert out.columns == ["doc_id", "size", "crc", "shard", "slot"]
    got = [tuple(r) for r in out.collect()]
    low = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(got, key=low) == sorted(shards_by_hand(rows, n), key=low)
    sizes, largest = {}, max(r[1] for r in got)
    for r in got:
        sizes[r[3]] = sizes.get(r[3], 0) + r[1]
    assert all(abs(s - sum(sizes.values()) / n) <= largest for s in sizes.values())


def test_shards_of_odd_tables(spark):
    assert sharding.shards(spark.createDataFrame([], "doc_id long, text string"), 40).collect() == []
    one = sharding.shards(spark.createDataFrame([(1, "x" * 1_000_000)], "doc_id long, text string"), 40).collect()
    assert [(r.size, r.shard, r.slot) for r in one] == [(1_000_016, 20, 0)]
    none = sharding.shards(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), 3, extra=0).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in none) == [(1, 0, 0), (2, 0, 1)]


def test_a_hot_id_is_split(spark):
    rows = spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    running = sharding._running(sharding.sized(rows, "doc_id", "text", 16), ["id", "size", "crc", "place"])
    counts = [r["count"] for r in running.groupBy("pid").count().collect()]
    assert len(counts) > 1 and max(counts) < 3000


# ---------------------------------------------------------------------------- conversations
def odd_conversations(seed):
    rng, rows = random.Random(seed), []
    texts = [None, "", " \n", "a.", "b", "c!  ", "hello?", "x\x1c", " ", "long " * 5 + "."]
    for conv in [*range(30), None]:
        for _ in range(rng.choice([1, 2, 3, 6, 40])):
            text = rng.choice(texts) if rng.random() < 0.7 else f"t{rng.random()}."
            rows.append((conv, rng.choice([None, *range(25)]), rng.choice(["user", "assistant", "system", "tool", "", None, "u", "ax"]), text))
    return rows + rows[-3:] * 4


def repaired(spark, rows, **kw):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, pid string")
    out = repair.repair(repair.damage(table), present=F.col("present"), **kw)
    return {r["conv_id"]: tuple(r[c] for c in RESULT) for r in out.collect()}


@pytest.mark.parametrize("kw", [{}, {"block_rows": 3}, {"block_bytes": 5}])
def test_repair_against_every_edit_list(spark, kw):
    rows = odd_conversations(len(kw) + kw.get("block_rows", 0))
    want = {c: brute.conversation(some) for c, some in brute.damaged(rows).items()}
    assert repaired(spark, rows, **kw) == want


def test_repair_of_nothing(spark):
    assert repaired(spark, []) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(spark, [(gone, 0, "user", "x.")]) == {gone: (0, 0, 0, 0, 0, 0, "", brute.sha(""))}


def test_repair_of_one_long_conversation(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"text {t}" + rng.choice([".", ""])) for t in range(9000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    small = repair.repair(table, with_text=True, block_rows=100).collect()
    short = [r + ("-" if x.endswith(".") else "t") for r, x in ((r[2][0], r[3]) for r in rows)]
    audit, state = repair.walk(short, repair.END, 0, True)
    lines, _ = repair.lines(audit, [(r[2], r[3]) for r in rows], 0)
    assert [(r.audit, r.repaired, r.repaired_sha256) for r in small] == [(audit, "\n".join(lines), brute.sha("\n".join(lines)))]
    v = repair.END
    for row in reversed(short):
        v = repair.before(row, v)
    assert small[0].cost == v[0] and state in (0, 3)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.sampled_from("bdt-")), max_size=30))
def test_matrices_agree_with_vectors(rows):
    rows = [a + b for a, b in rows]
    v = repair.END
    for row in reversed(rows):
        v = repair.before(row, v)
    m = repair.matrix(rows)
    assert tuple(min(m[s][k] + repair.END[k] for k in range(4)) for s in range(4)) == v


def test_new_queries_have_the_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    want = {"op11_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
            "op12_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
            "op13_conversation_repair": ["conv_id", *RESULT]}
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, sf).columns == columns
