import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from claimsight.llm import common as C
from tests.llm import brute

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\x1c é", max_size=40)), max_size=8)


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_of_a_batch(rows):
    data, off = C.text_bytes(pa.array(rows, pa.string()))
    starts, ends, first = C.find_words(data, off)
    got = [[bytes(data[starts[j]:ends[j]]).decode() for j in range(a, b)] for a, b in zip(first[:-1], first[1:])]
    assert got == [brute.words(t) for t in rows]


def test_word_hashes_depend_on_the_word_alone():
    old = C.HASH_BLOCK
    rows = ["x" * 50 + " y z", "", None, "z y " * 30 + "x" * 50, "ab ba a b"]
    by = {}
    try:
        for C.HASH_BLOCK in (old, 16):
            data, off = C.text_bytes(pa.array(rows))
            starts, ends, _ = C.find_words(data, off)
            for s, e, h in zip(starts, ends, C.word_hashes(data, starts, ends)):
                assert by.setdefault(bytes(data[s:e]), h) == h
    finally:
        C.HASH_BLOCK = old
    assert len(set(by.values())) == len(by)


def test_rolling_equals_the_plain_polynomial():
    h = np.random.default_rng(1).integers(0, 1 << 63, 60, dtype=np.uint64)
    for k in (1, 2, 3, 5, 7, 8, 35, 60, 61):
        want = [sum(int(h[i + j]) * pow(C.BASE, k - 1 - j, 1 << 64) for j in range(k)) % (1 << 64) for i in range(60 - k + 1)]
        assert C.rolling(h, k).tolist() == want


def test_slices_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (5, 0, 100, 3, 3, 3)])], names=["text"])
    parts = list(C.slices([batch], "text", 8))
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    assert max(sum(map(len, filter(None, p.column(0).to_pylist()))) for p in parts if len(p) > 1) <= 8
