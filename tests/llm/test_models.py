import zlib

import numpy as np
import pyarrow as pa

from claimsight.llm import langid, quality, queries
from tests.conftest import SF001


def auc(score, label):
    place = np.argsort(np.argsort(score))
    n1 = label.sum()
    return (place[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


def test_quality_held_out(spark):
    got = queries.op10_quality(spark, SF001).toPandas()
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    labels = spark.read.parquet(f"{SF001}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.97
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_folds_leave_labels_out(spark):
    """Labels of the held-out fifth have no influence."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    stats = quality.with_statistics(docs, ["doc_id"]).cache()
    models = []
    for turned in (labels, labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 "
                                             "THEN 1 - quality ELSE quality END AS quality")):
        models.append(quality.fit(queries.labelled_statistics(stats, turned)))
    a, b = models
    assert np.allclose(a.means, b.means) and np.isclose(a.slope, b.slope) and np.isclose(a.offset, b.offset)


def test_quality_edges(spark):
    rows = [(1, None, 9), (2, "", 9), (3, "word " * 60_000, 9), (3, "word " * 60_000, 9), (None, "\x00\t \n", 9), (5, "Ünï ✓", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats int")
    stats = quality.with_statistics(docs, ["doc_id"])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.fit(queries.labelled_statistics(stats, labels.limit(0))) is None
    assert quality.fit(queries.labelled_statistics(stats, labels)) is None
    assert {r.score for r in quality.score_texts(docs, None).collect()} == {0.5}
    x = np.random.default_rng(0).normal(size=(40, quality.DIM))
    moments = [quality.Moments(20.0, p.sum(0), p.T @ p) for p in (x[:20], x[20:])]
    model = quality.fit_moments(moments, 0.1, 0.1)
    got = quality.score_texts(docs, model)
    assert got.columns == ["doc_id", "text", "stats", "score"]
    assert all(0 <= r.score <= 1 for r in got.collect()) and got.count() == len(rows)
    same = quality.score_statistics(stats, model, ["doc_id"]).collect()
    assert sorted(r.score for r in same) == sorted(r.score for r in got.collect())
    assert quality.score_texts(docs.limit(0), model).count() == 0


def test_discriminant_is_the_gaussian_log_density_difference():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(300, quality.DIM)), rng.normal(0.3, 1.5, size=(200, quality.DIM))
    model = quality.fit_moments([quality.Moments(float(len(p)), p.sum(0), p.T @ p) for p in (a, b)], 0.0, 0.0)
    every = np.vstack([a, b])
    z = (every - every.mean(0)) / every.std(0)
    want = []
    for part, share in ((z[:300], 0.6), (z[300:], 0.4)):
        cov = np.cov(part.T, bias=True) + 1e-6 * np.eye(quality.DIM)
        d = z - part.mean(0)
        want.append(np.log(share) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (d @ np.linalg.inv(cov) * d).sum(1))
    assert np.allclose(model.difference(every), want[1] - want[0], atol=1e-6)


def test_language_held_out(spark):
    got = queries.op1_language_id(spark, SF001).toPandas()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang").toPandas()
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out].merge(docs, on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_language_edges(spark):
    train = spark.createDataFrame([(t, "xx" if t[0] == "a" else "yy") for t in ("abab aba", "aab abba", "cdcd dc", "ccdd dcd")]
                                  + [(None, "xx"), ("abc", None), ("123", "zz")], "text string, lang string")
    model = langid.fit(train)
    assert model.languages == ["xx", "yy"]
    rows = [(1, "abba"), (2, "dcdc"), (3, None), (4, ""), (5, "12 !?"), (6, "abab " * 100_000), (6, "abab " * 100_000), (None, "CDCD")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS lang_pred")
    got = [(r.doc_id, r[1], r.score) for r in langid.identify(docs, model, ["doc_id"]).collect()]
    assert sorted((i or 0, p) for i, p, _ in got) == [(0, "yy"), (1, "xx"), (2, "yy"), (3, "und"), (4, "und"), (5, "und"), (6, "xx"), (6, "xx")]
    assert all((s == 0) == (p == "und") and 0 <= s <= 1 for _, p, s in got)
    assert langid.fit(train.limit(0)) is None and langid.fit(train.where("lang is null")) is None
    assert {r.lang_pred for r in langid.identify(docs.drop("lang_pred"), None, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model, ["doc_id"]).count() == 0


def test_folded_weights_equal_the_kernel():
    """Scores from the folded matrix are those of kernel, landmarks and ridge step by step."""
    texts = ["abab", "baba ab", "cdc dd", "dcdc", "abcd"]
    bits, _ = langid.presence(pa.array(texts))
    names = ["x", "x", "y", "y", "x"]
    model = langid.fit_kernel(np.packbits(bits.astype(bool), axis=1), names, 4, 0.5)
    unit = bits / np.sqrt(bits.sum(1, keepdims=True))
    marks = unit[[0, 2, 1, 3]]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    phi = (unit @ marks.T) @ (vectors / np.sqrt(values))
    y = np.array([[float(n == k) for k in ("x", "y")] for n in names])
    weight = (y / y.sum(0)).sum(1) * len(y) / 2
    centre, mean = np.average(phi, axis=0, weights=weight), np.average(y, axis=0, weights=weight)
    root = np.sqrt(weight)[:, None]
    alpha = np.linalg.solve(((phi - centre) * root).T @ ((phi - centre) * root) + 0.5 * np.eye(4), ((phi - centre) * root).T @ ((y - mean) * root))
    want = (phi - centre) @ alpha + mean
    got = bits @ model.weights / np.sqrt(bits.sum(1, keepdims=True)) + model.bias
    assert np.allclose(got, want, atol=1e-4)


def test_pieces_cover_the_texts():
    off = np.array([0, 3, 3 + 2 * langid.PIECE, 5 + 2 * langid.PIECE, 6 + 3 * langid.PIECE])
    starts, owner = langid.pieces(off)
    assert owner.tolist() == [0, 1, 1, 2, 3, 3] and np.diff(np.append(starts, off[-1])).tolist() == [
        3, langid.PIECE, langid.PIECE, 2, langid.PIECE, 1]


def test_language_of_very_long_mixed_texts(spark):
    """Prose and then as much of anything else (log lines, ids) as would fill every slot: still the prose's language."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("lang is not null and text is not null")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, w)) for w in rng.integers(97, 123, (20_000, 7))]
    by = {}
    for r in docs.orderBy("doc_id").collect():
        by[r.lang] = by.get(r.lang, "") + " " + r.text
    names = sorted(by)
    long = [(by[a] * (1 + 200_000 // len(by[a])))[:200_000] + " " + " ".join(words) for a in names]
    got, shares = model.predict(pa.array(long))
    assert got == names and (shares > 1 / len(names)).all()
    alone, _ = model.predict(pa.array([(by[a] * (1 + 1_000_000 // len(by[a])))[:1_000_000] for a in names]))
    assert alone == names
