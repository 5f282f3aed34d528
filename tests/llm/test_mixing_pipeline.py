import math
import os
import shutil
import subprocess
import sys
import tempfile
from collections import defaultdict

import public_tokenizers
import pytest

import corpus_pipeline as P
from claimsight.llm import bpe, mixing, quality, queries
from tests.conftest import SF0001
from tests.llm import brute

SOURCES = {"big": 600, "mid": 90, "small": 12, None: 30}


def sized(spark):
    rows = [(f"{s}-{i}", s, 5 + (i * 7) % 11, 1, 2) for s, n in SOURCES.items() for i in range(n)]
    rows += [("e1", "empty", 0, 1, 2), ("e2", "empty", None, 1, 2)]
    return spark.createDataFrame(rows, "doc_id string, source string, n_tokens long, epoch int, budget int")


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


@pytest.mark.parametrize("target", [0.5, 0.7, 0.9, 1.0])
def test_weights_meet_the_entropy(spark, target):
    w = {r.source: r for r in mixing.source_weights(sized(spark), target_entropy=target).collect()}
    assert abs(sum(r.weight for r in w.values()) - 1) < 1e-9 and w["empty"].weight == 0
    own = entropy([r.total / sum(x.total for x in w.values()) for r in w.values()])
    assert abs(entropy([r.weight for r in w.values()]) - max(own, target * math.log(4))) < 1e-6
    logs = {s: (math.log(r.weight), math.log(r.total)) for s, r in w.items() if r.total}
    slopes = {round((logs["big"][0] - logs[s][0]) / (logs["big"][1] - logs[s][1]), 6) for s in ("mid", "small", None)}
    assert len(slopes) == 1  # one exponent for all


def test_repeats_stay_within_the_limit(spark):
    w = mixing.source_weights(sized(spark), target_entropy=1.0, max_repeats=3.0).collect()
    most = max(r.budget / r.total for r in w if r.total)
    assert 2.98 < most <= 3.0
    far = mixing.source_weights(sized(spark), max_repeats=2.0, budget=10 ** 6).collect()  # can't be met: the shares stay
    total = sum(r.total for r in far)
    assert all(abs(r.weight - r.total / total) < 1e-9 for r in far)


@pytest.mark.parametrize("block_docs", [4096, 16])
def test_realised_copies(spark, block_docs):
    docs = sized(spark)
    weights = mixing.source_weights(docs, target_entropy=0.8)
    blocks = mixing.block_order(docs, weights, block_docs=block_docs)
    got = mixing.realise(docs, weights, blocks, ["doc_id", "source", "n_tokens"], block_docs=block_docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for w in weights.collect():
        rows = sorted(by[w.source], key=lambda r: r.tokens_before)
        assert bool(rows) == (w.total > 0)
        at = 0
        for r in rows:  # the schedule has no gap and ends with the budget
            assert r.tokens_before == at < w.budget and r.epoch == at // w.total
            at += r.n_tokens
        assert not rows or w.budget <= at < w.budget + 16
        for e in {r.epoch for r in rows}:
            ids = [r.doc_id for r in rows if r.epoch == e]
            assert len(ids) == len(set(ids)) and (e == rows[-1].epoch or len(ids) == w.docs)


def test_mixing_edges(spark):
    empty = sized(spark).limit(0)
    weights = mixing.source_weights(empty, **queries.MIX)
    assert weights.count() == 0
    assert mixing.realise(empty, weights, mixing.block_order(empty, weights), ["doc_id"]).count() == 0
    one = sized(spark).where("source = 'mid'")
    weights = mixing.source_weights(one, **queries.MIX)
    assert weights.collect()[0].weight == 1.0
    got = mixing.realise(one, weights, mixing.block_order(one, weights), ["doc_id"], schedule=False)
    assert got.count() == one.count() == got.distinct().count()
    blank = sized(spark).where("source = 'empty'")
    weights = mixing.source_weights(blank, **queries.MIX)
    assert mixing.realise(blank, weights, mixing.block_order(blank, weights), ["doc_id"]).count() == 0
    texts = spark.createDataFrame([(None,), ("",), (" a\tb\x1cc ",)], "t string")
    assert [r[0] for r in texts.select(mixing.word_count("t")).collect()] == [0, 0, 2]


ODD = [(None, "no id at all here", "en", None), (10 ** 9, None, None, "src0"), (10 ** 9 + 1, "", "en", None), (10 ** 9 + 2, "rep row " * 20, "en", "a"),
       (10 ** 9 + 2, "rep row " * 20, "en", "a")]


@pytest.fixture(scope="module")
def odd_dir(spark):
    """The smallest tables with odd rows and extra columns whose names the stages use."""
    d = tempfile.mkdtemp(prefix="claimsight-odd-")
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars")
    docs.unionByName(odd).selectExpr("*", "1 AS score", "'k' AS kept_text", "2 AS epoch", "3 AS id", "4L AS n_tokens").write.parquet(f"{d}/documents.parquet")
    shutil.copy(f"{SF0001}/labels.parquet", f"{d}/labels.parquet")
    return d


def test_stages_against_brute_force(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").cache()
    names = docs.columns
    key = lambda rows: sorted(map(repr, map(tuple, rows)))

    good = P.good_documents(spark, docs, odd_dir).cache()
    stats = quality.with_statistics(docs, ["doc_id"])
    model = quality.fit(queries.labelled_statistics(stats, spark.read.parquet(f"{odd_dir}/labels.parquet")))
    import pyarrow as pa
    rows = docs.collect()
    scores = model.probability(quality.statistics(pa.array([r.text for r in rows])))
    assert good.columns == names and key(good.collect()) == key([r for r, s in zip(rows, scores) if s >= 0.3])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{odd_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert len(kept & set(clean)) >= 0.98 * len(clean)

    one = P.one_of_each_group(spark, docs, odd_dir).cache()
    group = brute.components([(r.doc_id, r.text) for r in rows if r.doc_id is not None], 5, 80)
    assert one.columns == names
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in one.collect()) == sorted({i for i, c in group.items() if i == c} | {-1})

    cut = P.without_repeated_passages(spark, docs, odd_dir)
    want = []
    for r, (_, removed, text) in zip(rows, brute.substring([r.text for r in rows], 35)):
        d = r.asDict()
        if removed:
            d |= {"text": text, "n_chars": len(text)}
        want.append(tuple(d[c] for c in names))
    assert cut.columns == names and cut.dtypes == docs.dtypes and key(cut.collect()) == key(want)

    mix = P.mixed_sources(spark, docs, odd_dir)
    assert mix.columns == names
    have = {r.doc_id: tuple(r) for r in rows}
    assert all(have[r.doc_id] == tuple(r) for r in mix.collect())

    enc = bpe.encoding(bpe.read_ranks(public_tokenizers.path(queries.RANKS)), public_tokenizers.PATTERN)
    got = P.tokens(spark, docs, odd_dir).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, list(r.ids), r.decoded_sha256) for r in got) == sorted(
        (r.doc_id or 0, len(x), x, brute.sha(r.text or "")) for r in rows for x in [enc.encode_ordinary(r.text or "")])


def test_run_and_empty_tables(spark, odd_dir):
    got = P.run(spark, odd_dir)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"] and got.count() > 100
    d = tempfile.mkdtemp(prefix="claimsight-none-")
    for t in ("documents", "labels"):
        spark.read.parquet(f"{odd_dir}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    assert P.run(spark, d).count() == 0
    for name in ("op1", "op4", "op5", "op6", "op7", "op8", "op9", "op10"):
        query = next(q for n, q in queries.QUERIES.items() if n.startswith(name + "_"))
        assert query(spark, d).count() == 0, name


def test_queries_take_odd_rows(spark, odd_dir):
    n = spark.read.parquet(f"{odd_dir}/documents.parquet").count()
    for name in ("op1", "op4", "op5", "op8", "op9", "op10"):
        query = next(q for k, q in queries.QUERIES.items() if k.startswith(name + "_"))
        assert query(spark, odd_dir).count() == n, name


def test_other_queries_take_odd_rows(spark, odd_dir):
    """The operators on other tables, and those whose rows are not the documents'."""
    for t, schema in (("pages", "page_id long, url string, html string, text string"), ("embeddings", "vec_id long, embedding array<float>, label int, id int"),
                      ("conversations", "conv_id long, turn long, role string, text string, cost int")):
        rows = {"pages": [(1, None, None, "t"), (None, "u", "<p>a", "t"), (2, "u", "", "t"), (2, "u", "", "t")],
                "embeddings": [(0, [1.0] * 8, None, 1), (0, [1.0] * 8, None, 1), (None, [2.0] * 8, 3, 1), (20, None, 3, 1), (40, [None] * 8, 3, 1), (60, [], 3, 1)],
                "conversations": [(None, None, None, None, 1), (1, 0, "user", "hi.", 1), (1, 0, "user", "hi.", 1), (1, None, "", " ", 1)]}[t]
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{odd_dir}/{t}.parquet")
    run = lambda name, d: next(q for k, q in queries.QUERIES.items() if k.startswith(name + "_"))(spark, d)
    assert run("op3", odd_dir).count() == 4
    assert [(r.query_id, r.vec_id) for r in run("op2", odd_dir).collect()] == []  # a query's own id is no candidate
    assert run("op11", odd_dir).count() == 4 and {r.label_error for r in run("op11", odd_dir).where("vec_id = 0").collect()} == {0}
    assert {r.conv_id for r in run("op13", odd_dir).collect()} == {None, 1}
    n = spark.read.parquet(f"{odd_dir}/documents.parquet").count()
    assert run("op12", odd_dir).count() == n and run("op7", odd_dir).count() > 0 and run("op6", odd_dir).count() > 0
    d = tempfile.mkdtemp(prefix="claimsight-none-")
    for t in ("pages", "embeddings", "conversations", "documents"):
        spark.read.parquet(f"{odd_dir}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    for name in ("op2", "op3", "op11", "op12", "op13"):
        assert run(name, d).count() == 0, name


def test_different_texts_under_one_id_are_kept(spark, odd_dir):
    """Rows of one id are compared by their texts: equal rows and near copies go, other texts stay."""
    text = " ".join(f"a{i}" for i in range(60))
    other = " ".join(f"b{i}" for i in range(60))
    rows = [(1, text), (5, text + " end"), (5, other), (5, other), (7, other + " end"), (7, "third text of all"), (9, other)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.text) for r in P.one_of_each_group(spark, docs, odd_dir).collect())
    # The copies of the second text: the one with a unique id stays.
    assert got == sorted([(1, text), (9, other), (7, "third text of all")])


def test_library_without_these_folders():
    """The rest imports and lists its queries when the folders are gone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    d = tempfile.mkdtemp(prefix="claimsight-rest-")
    shutil.copytree(f"{root}/claimsight", f"{d}/claimsight", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", d)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(x.startswith('op') for x in q))"],
                          cwd=d, env={**os.environ, "PYTHONPATH": d}, capture_output=True, text=True, timeout=100)
    assert said.stdout.split()[1:] == ["False", "False"] and int(said.stdout.split()[0]) >= 100, said.stderr
