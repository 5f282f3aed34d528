"""Document quality by a regularised quadratic discriminant (operator 10).

Every document becomes a short vector of transformed statistics of its whole text (sizes, letter
case, symbols, word endings, repetition).  Each class gets a Gaussian whose covariance is shrunk
first towards the pooled covariance and then towards a multiple of the identity; the score is the
Mahalanobis log-density difference, computed with Cholesky factors that are factored once on the
driver and cached in the model.  A two-parameter logistic map, fitted on scores of models that
did not see the row (folds), turns the difference into a probability.

Null and empty texts have the zero-size vector and a score like any other; repeated rows count as often as they occur; empty
tables give empty results, and without labels of both kinds every score is 0.5.

Fitting uses every labelled row: Spark aggregates counts, sums and cross products per class and
fold, so the driver sees a few small matrices whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.llm import common as C

#: Names of the statistics, in the order of the vector.
STATISTICS = (
    "log_chars", "log_words", "log_word_length", "word_length_spread", "upper_share", "all_upper_words",
    "symbol_share", "digit_share", "symbol_ending_words", "lone_symbol_words", "distinct_words",
    "distinct_pairs", "distinct_triples", "repeated_neighbours", "top_word_share", "stop_share", "line_length",
)
DIM = len(STATISTICS)
#: Bytes of text whose statistics are computed at a time; the working arrays take some sixty times as much.
SLICE = 1 << 20

#: Byte classes: UTF-8 lead and continuation bytes count as letters.
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ASCII_LETTER = _LETTER & (np.arange(256) < 128)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
#: Marks that prose uses; every other printable ASCII non-alphanumeric byte is a symbol.
_PROSE = np.zeros(256, bool)
_PROSE[[ord(c) for c in ".,;:'\"-()?"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = ~(_LETTER | _DIGIT | _PROSE | _SPACE)
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".?!"]] = True


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many True each row has."""
    out, some = np.zeros(len(off) - 1), off[1:] > off[:-1]
    if some.any():
        out[some] = np.add.reduceat(mask, off[:-1][some], dtype=np.int32)
    return out


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many different keys it has, and how often its commonest key occurs."""
    bits = np.uint64(max(rows, 2).bit_length())  # the row in the upper bits, the key's upper bits below
    own = np.sort((row.astype(np.uint64) << (np.uint64(64) - bits)) | (keys >> bits))
    at = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    n = np.diff(np.append(at, len(own)))
    of = (own[at] >> (np.uint64(64) - bits)).astype(np.int64)
    kinds = np.bincount(of, minlength=rows).astype(float)
    top, some = np.zeros(rows), kinds > 0
    if some.any():
        top[some] = np.maximum.reduceat(n, np.searchsorted(of, np.flatnonzero(some)))
    return kinds, top


def statistics(texts: pa.Array) -> np.ndarray:
    """One vector of ``STATISTICS`` per text. Null and empty texts give the zero-size vector."""
    data, off = C.text_bytes(texts)
    rows = len(off) - 1
    starts, ends, first = C.find_words(data, off)
    h = C.word_hashes(data, starts, ends)
    row = np.repeat(np.arange(rows), np.diff(first))
    n_words = np.diff(first).astype(float)
    some = np.maximum(n_words, 1)
    n_chars = _per_row((data & 0xC0) != 0x80, off)
    letters = _per_row(_LETTER[data], off)
    solid = np.maximum(_per_row(~_SPACE[data], off), 1)
    length = (ends - starts).astype(float)
    total = np.concatenate(([0], np.cumsum(length)))
    mean = (total[first[1:]] - total[first[:-1]]) / some
    squares = np.concatenate(([0], np.cumsum(length * length)))
    spread = np.sqrt(np.maximum((squares[first[1:]] - squares[first[:-1]]) / some - mean ** 2, 0))
    upper = np.concatenate(([0], np.cumsum(_UPPER[data], dtype=np.int32)))
    letter = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data], dtype=np.int32)))
    word_upper, word_letter = upper[ends] - upper[starts], letter[ends] - letter[starts]
    shouting = (word_upper == word_letter) & (word_letter >= 2)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    before = data[np.maximum(ends - 2, starts)] if len(ends) else np.zeros(0, np.uint8)
    ending = _SYMBOL[last] | ((_PROSE[last] | _SYMBOL[last]) & _SYMBOL[before])
    count = lambda mask: np.bincount(row, weights=mask.astype(float), minlength=rows) / some
    lone = (length == 1) & _SYMBOL[last]
    same = np.zeros(len(h), bool)
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    kinds, top = _distinct(h, row, rows)
    out = [np.log1p(n_chars), np.log1p(n_words), np.log1p(mean), np.log1p(spread),
           _per_row(_UPPER[data], off) / np.maximum(letters, 1), count(shouting),
           _per_row(_SYMBOL[data], off) / solid, _per_row(_DIGIT[data], off) / solid, count(ending), count(lone),
           kinds / some]
    for k in (2, 3):
        grams, at = C.windows(h, first, k)
        n, _ = _distinct(grams, row[at], rows)
        out.append((n + 1) / (np.maximum(n_words - k + 1, 0) + 1))
    lines = _per_row(data == 10, off) + 1
    out += [count(same), top / some, _per_row(_STOP[data], off) / some, np.log1p(n_chars / lines)]
    x = np.stack(out, axis=1)
    x[:, 4:10] = np.sqrt(x[:, 4:10])
    x[:, 13:16] = np.sqrt(x[:, 13:16])
    return x


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` plus ``stats`` (array of ``DIM`` doubles) of each whole text. Row-wise, no shuffle."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, "__text", SLICE):
            x = statistics(C.column(batch, "__text"))
            stats = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), DIM).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([C.column(batch, c) for c in keep] + [stats], names=schema.names)

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


@dataclass
class Discriminant:
    """Means, Cholesky factors and log terms per class (0 and 1), and the logistic map of the difference."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    slope: float = 1.0
    offset: float = 0.0

    def __post_init__(self) -> None:
        self.inverses = [np.linalg.inv(f) for f in self.factors]

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log p(x | 1) + log prior(1) - log p(x | 0) - log prior(0)."""
        z = np.clip((x - self.centre) / self.scale, -LIMIT, LIMIT)
        both = [c - 0.5 * np.square((z - m) @ i.T).sum(axis=1)
                for m, i, c in zip(self.means, self.inverses, self.constants)]
        return both[1] - both[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -60, 60)))


#: Standardised statistics are clipped to this many deviations, so that one odd value can't decide alone.
LIMIT = 8.0


@dataclass
class Moments:
    """Count, sum and cross products of one class's vectors; they add up."""

    n: float
    s: np.ndarray
    q: np.ndarray

    @staticmethod
    def none() -> "Moments":
        return Moments(0.0, np.zeros(DIM), np.zeros((DIM, DIM)))

    def plus(self, o: "Moments", sign: int = 1) -> "Moments":
        return Moments(self.n + sign * o.n, self.s + sign * o.s, self.q + sign * o.q)

    def covariance(self) -> np.ndarray:
        m = self.s / max(self.n, 1)
        return self.q / max(self.n, 1) - np.outer(m, m)


def fit_moments(classes: list[Moments], to_pooled: float, to_identity: float) -> Discriminant | None:
    """The discriminant of two classes' moments; None unless both have rows."""
    if min(m.n for m in classes) < 2:
        return None
    n = sum(m.n for m in classes)
    every = classes[0].plus(classes[1])
    centre = every.s / n
    scale = np.sqrt(np.maximum(np.diag(every.covariance()), 1e-9))
    means, factors, constants = [], [], []
    unit = np.outer(scale, scale)
    pooled = sum(m.n / n * m.covariance() for m in classes) / unit
    for m in classes:
        cov = (1 - to_pooled) * m.covariance() / unit + to_pooled * pooled
        cov = (1 - to_identity) * cov + to_identity * np.trace(cov) / DIM * np.eye(DIM)
        f = np.linalg.cholesky(cov + 1e-6 * np.eye(DIM))
        means.append((m.s / m.n - centre) / scale)
        factors.append(f)
        constants.append(float(np.log(m.n / n) - np.log(np.diag(f)).sum()))
    return Discriminant(centre, scale, means, factors, constants)


def _partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: moments of each (fold, label)."""
    held: dict[tuple[int, int], Moments] = {}
    for pdf in batches:
        for key, g in pdf.groupby(["fold", "label"]):
            x = np.stack(g["stats"].to_numpy())
            old = held.get(key, Moments.none())
            held[key] = old.plus(Moments(float(len(x)), x.sum(axis=0), x.T @ x))
    if held:
        yield pd.DataFrame([(int(f), int(y), m.n, m.s, m.q.ravel()) for (f, y), m in held.items()],
                           columns=["fold", "label", "n", "s", "q"])


def fit(labelled: DataFrame, to_pooled: float = 0.02, to_identity: float = 0.01, folds: int = 5) -> Discriminant | None:
    """Fit on all rows of ``labelled``: ``stats``, ``label`` (0 or 1), ``fold`` (0 .. folds-1).

    Tasks send one row of moments per fold and class, added up per position in Spark, so the driver
    gets 2 x folds rows.  Rows whose label is neither 0 nor 1 are left out.  Returns None when a
    class has fewer than two rows.
    """
    labelled = labelled.where(F.col("label").isin(0, 1)).select("stats", F.col("label").cast("int"), F.col("fold").cast("int"))
    parts = labelled.mapInPandas(_partials, "fold int, label int, n double, s array<double>, q array<double>")
    long = parts.select("fold", "label", F.posexplode(F.concat(F.array("n"), "s", "q")).alias("at", "v"))
    rows = (long.groupBy("fold", "label", "at").agg(F.sum("v").alias("v"))
            .groupBy("fold", "label").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("v")).collect())
    by: dict[tuple[int, int], Moments] = {}
    for r in rows:
        v = np.array([x["v"] for x in r["v"]])
        by[r["fold"], r["label"]] = Moments(float(v[0]), v[1:1 + DIM], v[1 + DIM:].reshape(DIM, DIM))
    every = [reduce(Moments.plus, (m for (_, y), m in sorted(by.items()) if y == k), Moments.none()) for k in (0, 1)]
    model = fit_moments(every, to_pooled, to_identity)
    if model is None:
        return None
    inside = {f: fit_moments([every[k].plus(by.get((f, k), Moments.none()), -1) for k in (0, 1)], to_pooled, to_identity)
              for f in range(folds)}
    model.slope, model.offset = _calibrate(labelled, {f: m or model for f, m in inside.items()})
    return model


#: Score bins of the calibration: the difference is compressed to [-1, 1] and cut into this many.
BINS = 2000


def _calibrate(labelled: DataFrame, models: dict[int, Discriminant]) -> tuple[float, float]:
    """Slope and offset of a logistic map of the out-of-fold differences, from a histogram of them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for f, g in pdf.groupby("fold"):
                d = models[int(f)].difference(np.stack(g["stats"].to_numpy()))
                yield pd.DataFrame({"label": g["label"].to_numpy(), "bin": np.round(d / (abs(d) + 10) * BINS).astype("int32")})

    rows = labelled.mapInPandas(run, "label int, bin int").groupBy("label", "bin").count().collect()
    u = np.array([r["bin"] / BINS for r in rows])
    d = 10 * u / np.maximum(1 - abs(u), 1e-3)
    y, w = np.array([float(r["label"]) for r in rows]), np.array([float(r["count"]) for r in rows])
    # Platt's targets keep the map finite when the classes separate.
    hi, lo = (w[y == 1].sum() + 1) / (w[y == 1].sum() + 2), 1 / (w[y == 0].sum() + 2)
    t = np.where(y == 1, hi, lo)
    a, b = 0.5, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -60, 60)))
        g = np.array([(w * (p - t) * d).sum(), (w * (p - t)).sum()])
        v = w * np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(v * d * d).sum() + 1e-6, (v * d).sum()], [(v * d).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 1.0 / max(abs(step).max(), 1e-12))
        a, b = max(a - step[0], 1e-3), b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def score_statistics(with_stats: DataFrame, model: Discriminant | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` plus ``score`` (0 to 1). Without a model every document scores 0.5."""
    if model is None:
        return with_stats.select(*keep, F.lit(0.5).alias("score"))

    @F.arrow_udf("double")
    def probability(stats: pa.Array) -> pa.Array:
        return pa.array(model.probability(stats.flatten().to_numpy().reshape(-1, DIM)))

    return with_stats.select(*keep, probability("stats").alias("score"))


def score_texts(docs: DataFrame, model: Discriminant | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score``; one row-wise pass over whole texts, other columns stay in the JVM."""
    if model is None:
        return docs.withColumn(score, F.lit(0.5))

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [model.probability(statistics(C.column(b, "text"))) for b in C.slices([batch], "text", SLICE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(score, probability(F.col(text)))
