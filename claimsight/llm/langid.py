"""Language identification with string kernels (operator 1).

A text is the set of its character n-grams (``SIZES``, over the lower-cased text with every run of
characters that are not letters as one space), a blended spectrum in presence form.  Grams are
hashed to ``DIM`` slots, so a text is a 0/1 vector b(x) and the kernel is the normalised
intersection

    k(x, y) = <b(x), b(y)> / sqrt(<b(x), b(x)> <b(y), b(y)>).

A Nystroem approximation on landmark texts turns it into features: phi(x) = k(x, L) W^(-1/2) with
W = k(L, L).  One-versus-rest kernel ridge regression on these features gives one score per
language.  Texts are scored in batches by two matrix products, presence x landmarks and then
landmarks x languages, with the first one's rows divided by their norms; as both are linear, they
are multiplied once into one ``DIM`` x languages matrix.

A long text would fill all slots, so texts are scored in pieces of ``PIECE`` code points.  The scores of a text are the means of
its pieces' scores, weighted by their lengths; shorter texts are one piece.

The classifier is fitted on a bounded sample: about ``per_language`` texts of each learned value (all
of them where there are fewer) and about ``most`` in all, chosen by a hash of the row.  A sampled text travels as its bit
vector (``DIM`` / 8 bytes, whatever its length).  Scoring reads whole texts.

Null text and text without a letter give ``und`` with score 0.  Without training rows every other
text gives ``und`` too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.llm import common as C

#: Lengths of the n-grams.
SIZES = (1, 2, 3, 4)
#: Hash slots of the presence vectors.
DIM = 1 << 15
#: Texts or pieces of texts per matrix product.
BATCH = 128
#: Code points of a piece. Few enough that a piece of anything leaves most slots empty.
PIECE = 4096
UNKNOWN = "und"


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each text between two spaces, runs of non-letters as
    one space; offsets of the texts; and whether each text has a letter."""
    clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\P{L}+", " ")
    clean = pc.binary_join_element_wise("", pc.utf8_trim(clean, " "), "", " ")  # " text "
    points = np.frombuffer("".join(clean.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = pc.utf8_length(clean).to_numpy(zero_copy_only=False)
    return points, np.concatenate(([0], np.cumsum(sizes))), sizes > 2


def _bits(points: np.ndarray, off: np.ndarray) -> np.ndarray:
    """0/1 matrix (pieces x ``DIM``) of the hashed n-grams of each piece ``points[off[i]:off[i + 1]]``."""
    out = np.zeros((len(off) - 1, DIM), np.float32)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    end = np.repeat(off[1:], np.diff(off))
    h = points.astype(np.uint64)
    flat, base = out.reshape(-1), row * DIM
    at = np.arange(len(points))
    for n in range(1, max(SIZES) + 1):
        if n > 1:
            h = h[:-1] * np.uint64(C.BASE) + points[n - 1:]
        if n in SIZES and len(h):
            ok = at[:len(h)] + n <= end[:len(h)]
            slot = (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 15)).astype(np.int64)
            flat[(base[:len(h)] + slot)[ok]] = 1
    return out


def presence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """0/1 matrix (texts x ``DIM``) of hashed n-grams, and whether each text has a letter."""
    points, off, has_letter = code_points(texts)
    out = _bits(points, off)
    out[~has_letter] = 0
    return out, has_letter


def pieces(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of pieces of at most ``PIECE`` code points of each text, and the text that each is of."""
    sizes = np.diff(off)
    many = np.maximum(-(-sizes // PIECE), 1)
    owner = np.repeat(np.arange(len(sizes)), many)
    first = np.cumsum(many) - many
    return off[:-1][owner] + (np.arange(len(owner)) - first[owner]) * PIECE, owner


@dataclass
class Classifier:
    """``weights``: landmarks folded into the languages, ``DIM`` x languages; scores are
    presence @ weights / norm + ``bias``."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The best language of each text and its share of the positive scores."""
        names: list[str] = []
        shares = []
        batch = pa.RecordBatch.from_arrays([texts], names=["t"])
        for part in C.slices([batch], "t", 1 << 20):
            points, off, has_letter = code_points(C.column(part, "t"))
            starts, owner = pieces(off)
            ends = np.append(starts[1:], len(points))
            total = np.zeros((len(part), len(self.languages)))
            for at in range(0, len(starts), BATCH):
                to = min(at + BATCH, len(starts))
                cuts = np.append(starts[at:to], ends[to - 1])
                x = _bits(points[cuts[0]:cuts[-1]], cuts - cuts[0])
                f = x @ self.weights / np.maximum(np.sqrt(x.sum(axis=1, keepdims=True)), 1) + self.bias
                np.add.at(total, owner[at:to], np.maximum(f, 1e-6) * np.diff(cuts)[:, None])
            best = total.argmax(axis=1)
            names += [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
            shares.append(np.where(has_letter, total.max(axis=1) / np.maximum(total.sum(axis=1), 1e-300), 0.0))
        return names, np.concatenate(shares) if shares else np.zeros(0)


def _normalised(bits: np.ndarray) -> np.ndarray:
    """Rows of packed bits as vectors of length 1."""
    x = np.unpackbits(bits, axis=1).astype(np.float32)
    return x / np.maximum(np.sqrt(x.sum(axis=1, keepdims=True)), 1)


def fit_kernel(bits: np.ndarray, languages: list[str], landmarks: int, ridge: float) -> Classifier:
    """Nystroem landmarks (spread over the languages) and one-versus-rest ridge on the sample of packed
    bit vectors.  Only the landmarks and one batch are unpacked at a time."""
    names = sorted(set(languages))
    y = np.array([[float(a == b) for b in names] for a in languages])
    turn = Counter()
    turns = [(turn.update([a]) or turn[a]) for a in languages]  # round robin over the languages
    marks = _normalised(bits[np.argsort(turns, kind="stable")[:landmarks]])
    w = (marks @ marks.T).astype(float)
    values, vectors = np.linalg.eigh(w)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # W^(-1/2) up to a rotation
    phi = np.concatenate([(_normalised(bits[i:i + BATCH]) @ marks.T).astype(float) @ root for i in range(0, len(bits), BATCH)])
    # Every language counts alike, however many rows it has in the sample.
    weight = (y / np.maximum(y.sum(axis=0), 1)).sum(axis=1) * len(y) / len(names)
    centre = (weight[:, None] * phi).sum(axis=0) / weight.sum()
    mean = (weight[:, None] * y).sum(axis=0) / weight.sum()
    z = (phi - centre) * np.sqrt(weight)[:, None]
    t = (y - mean) * np.sqrt(weight)[:, None]
    alpha = np.linalg.solve(z.T @ z + ridge * np.eye(z.shape[1]), z.T @ t)
    return Classifier(names, (marks.T.astype(float) @ (root @ alpha)).astype(np.float32), mean - centre @ alpha)


def fit(train: DataFrame, per_language: int = 1000, most: int = 8000, landmarks: int = 384, ridge: float = 1.0,
        text: str = "text", language: str = "lang") -> Classifier | None:
    """Fit on a sample of ``train``; rows with null text or language are left out. None without rows.

    The sample takes each row of a language with probability ``per_language`` / rows of it, decided
    by a hash of the row, so it is the same for the same table.
    """
    counts = train.where(F.col(language).isNotNull()).groupBy(F.col(language).alias("l")).count().collect()  # a row per class
    if not counts:
        return None
    per_language = min(per_language, most / len(counts))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["l"], min(1.0, per_language / r["count"]))])
    ticket = F.pmod(F.xxhash64(*train.columns), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (train.where(F.col(text).isNotNull() & (ticket < share[F.col(language)]))
              .select(F.col(text).alias("t"), F.col(language).alias("l")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, "t", 1 << 20):
            for at in range(0, len(batch), BATCH):
                part = batch.slice(at, BATCH)
                x, ok = presence(C.column(part, "t"))
                packed = [np.packbits(r.astype(bool)).tobytes() for r in x[ok]]
                yield pa.RecordBatch.from_arrays([C.column(part, "l").filter(pa.array(ok)), pa.array(packed, pa.binary())],
                                                 names=["l", "bits"])

    got = sorted((r["l"], bytes(r["bits"])) for r in sample.mapInArrow(run, "l string, bits binary").collect())
    if not got:
        return None
    bits = np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(len(got), -1)
    return fit_kernel(bits, [a for a, _ in got], landmarks, ridge)


def identify(docs: DataFrame, model: Classifier | None, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` plus ``lang_pred`` and ``score`` (0 to 1) of every whole text. No shuffle."""
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in C.slices(batches, "__text", 4 << 20):
            names, shares = model.predict(C.column(batch, "__text")) if model else ([UNKNOWN] * len(batch), np.zeros(len(batch)))
            yield pa.RecordBatch.from_arrays([C.column(batch, c) for c in keep] + [pa.array(names, pa.string()), pa.array(shares)],
                                             names=schema.names)

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
