import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimsight.llm import bpe, lengths, queries
from tests.conftest import SF0001

PATH, PATTERN = public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(bpe.read_ranks(PATH), PATTERN)


@given(st.text(alphabet="ab1 \t\n'sé!. 　中", max_size=80))
@settings(max_examples=300, deadline=None)
def test_parts_encode_like_the_whole(text):
    enc = bpe.encoding(bpe.read_ranks(PATH), PATTERN)
    for most in (1, 7, 30):
        parts = list(bpe.safe_parts(text, most))
        assert "".join(p for p, _ in parts) == text
        assert sum((enc.encode_ordinary(p) for p, _ in parts), []) == enc.encode_ordinary(text)


def test_long_runs_of_white_space(enc):
    for run in (" " * 600, "\n" * 700, " \t" * 400):
        for text in (run, run + "x", "x" + run + "y z", run + "'s " + run, "a " + run + " b"):
            assert bpe.encode_text(enc, text) == enc.encode_ordinary(text), repr(text[:3])
    very = " " * 2_000_000 + "x"  # the splitting pattern alone would overflow its stack
    assert enc.decode_bytes(bpe.encode_text(enc, very)) == very.encode()


def test_long_text_without_spaces(enc):
    text = "ab" * 100_000
    assert enc.decode_bytes(bpe.encode_text(enc, text)) == text.encode()


def test_rows(spark, enc):
    rows = [(1, "Hello wörld  <|endoftext|>\n", "x"), (2, None, "y"), (3, "", None), (3, "", None), (None, "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_decode(docs.drop("ids"), PATH, PATTERN, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, list(r.ids), bytes(r.decoded)) for r in got) == sorted(
        (i or 0, len(enc.encode_ordinary(t or "")), enc.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    empty = bpe.encode_decode(docs.limit(0), PATH, PATTERN, ["doc_id"])
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_query_digests(spark, enc):
    got = {r.doc_id: r for r in queries.op5_byte_bpe(spark, SF0001).collect()}
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = enc.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_length_histogram(spark):
    sizes = [0, 0, 3, 3, 3, 1500, 2500, 70, None]
    hist = lengths.histogram(spark.createDataFrame([(x,) for x in sizes], "n_tokens int"))
    known = [x for x in sizes if x is not None]
    got = {r.context_limit: r for r in lengths.with_suffix_sums(hist).collect()}
    assert set(got) == set(known)
    for limit, r in got.items():
        assert r.n_docs == known.count(limit) and r.docs_at_most == sum(x <= limit for x in known)
        assert r.docs_longer == sum(x > limit for x in known) and r.total_tokens == sum(known)
        assert r.truncated_tokens == sum(min(x, limit) for x in known) == r.total_tokens - r.lost_tokens
        assert r.quantile == r.docs_at_most / len(known)
    for r in lengths.at_limits(hist, [2, 100, 4000]).collect():
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in known)
    assert lengths.with_suffix_sums(hist.limit(0)).count() == 0


def test_token_count_query(spark, enc):
    known = [len(enc.encode_ordinary(r.text or "")) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = queries.op7_token_counts(spark, SF0001).collect()
    assert {r.context_limit for r in got} == set(known)
    assert all(r.truncated_tokens == sum(min(x, r.context_limit) for x in known) for r in got)
