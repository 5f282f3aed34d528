"""Exact quantiles and modes that never gather a column in one task.

Spark's exact ``percentile``/``median`` aggregate keeps every distinct value of
a group in one buffer; for a global median over a very large table that is the
whole column in one task.  Here a mergeable sketch (``percentile_approx``)
brackets the wanted rank, and exact counts below, at, between and above the
bracket say where the rank is.  Each pass is one aggregate over the needed
columns for all open searches together; nothing is exploded, shuffled at full
width or persisted.  The bracket's inside shrinks about a hundredfold per pass, until it
has at most ``final_rows`` values, which the next pass collects.

Quantiles interpolate linearly between order statistics (the default of
pandas/NumPy ``quantile`` and DuckDB ``quantile_cont``).  Infinite values count
like any other; NULL and NaN are skipped.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of the sketch's percentages per pass.
_GRID = 200


@dataclass
class _Search:
    """Where one rank is: strictly between ``a`` and ``b`` (None: no limit), with ``base`` values at or below ``a``.

    The next pass splits that range at ``lo`` and ``hi``; ``expect`` bounds the
    values between them (None: not known yet).
    """

    rank: int | None
    a: float | None = None
    b: float | None = None
    base: int = 0
    lo: float = -math.inf
    hi: float = math.inf
    expect: int | None = None

    def split(self) -> tuple:
        return self.a, self.lo, self.hi, self.b


def _value(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _pass(df: DataFrame, cols: Sequence[str], wanted: list[tuple[int, tuple, bool]], buckets: int) -> list[dict]:
    """Counts of the parts of each range (the rest lies above), and the sorted inside (True) or its sketch."""
    grid = [i / _GRID for i in range(_GRID + 1)]
    out = []
    for j, (k, (a, lo, hi, b), collect) in enumerate(wanted):
        v = _value(cols[k])
        inside = (v > F.lit(lo)) & (v < F.lit(hi))
        left = v < F.lit(lo) if a is None else (v > F.lit(a)) & (v < F.lit(lo))
        lowest = F.lit(False) if lo == a else v == F.lit(lo)
        highest = F.lit(False) if hi in (b, lo) else v == F.lit(hi)
        held = F.when(inside, v)
        parts = {"below": F.count_if(left), "low": F.count_if(lowest), "high": F.count_if(highest)}
        if collect:
            parts["seen"] = F.sort_array(F.collect_list(held))
        else:
            parts |= {"mid": F.count(held), "seen": F.percentile_approx(held, grid, buckets)}
        out += [e.alias(f"{name}{j}") for name, e in parts.items()]
    row = df.agg(*out).first().asDict()
    return [{"below": row[f"below{j}"], "low": row[f"low{j}"], "high": row[f"high{j}"], "seen": row[f"seen{j}"], "whole": w[2],
             "mid": len(row[f"seen{j}"]) if w[2] else row[f"mid{j}"], "above": math.inf} for j, w in enumerate(wanted)]


def order_statistics(df: DataFrame, cols: Sequence[str], ranks, buckets: int = 10_000,
                     final_rows: int = 20_000) -> dict[tuple[int, int], float]:
    """Exact 0-based order statistics ``{(col_index, rank): value}``.

    ``ranks`` is ``{col_index: ranks}`` or a function of the per-column counts
    of values returning that dict (the first pass yields the counts).
    ``buckets`` is the accuracy of the sketch.
    """
    result: dict[tuple[int, int], float] = {}
    first = _pass(df, cols, [(k, _Search(None).split(), False) for k in range(len(cols))], buckets)
    counts = {k: sum(p[n] for n in ("below", "low", "mid", "high")) for k, p in enumerate(first)}
    if callable(ranks):
        ranks = ranks(counts)
    open_ = {(k, r): _Search(r) for k, rs in ranks.items() if counts[k] for r in rs}
    seen = {(k, _Search(None).split()): p for k, p in enumerate(first)}
    while open_:
        for (k, r), s in list(open_.items()):
            found = _narrow(s, seen[(k, s.split())], buckets)
            if found is not None:
                result[(k, r)] = found
                del open_[(k, r)]
        wanted = list({(k, s.split(), s.expect is not None and s.expect <= final_rows) for (k, _), s in open_.items()})
        if wanted:
            seen = {(k, split): p for (k, split, _), p in zip(wanted, _pass(df, cols, wanted, buckets))}
    return result


def _narrow(s: _Search, p: dict, buckets: int) -> float | None:
    """The value at the rank, or None after narrowing ``s`` to the part that holds it."""
    at = s.rank - s.base
    for name, value, a, b in (("below", None, s.a, s.lo), ("low", s.lo, None, None), ("mid", None, s.lo, s.hi),
                              ("high", s.hi, None, None), ("above", None, s.hi, s.b)):
        n = p[name]
        if at >= n:
            at -= n
            continue
        if value is not None:
            return value
        if name == "mid" and p["whole"]:
            return p["seen"][at]
        s.base, s.a, s.b = s.rank - at, a, b
        if name != "mid":  # the sketch misjudged the rank and there is none of this part: sketch it next
            s.lo, s.hi, s.expect = a, b, n
        else:
            place = round(at / max(n - 1, 1) * _GRID)  # neighbouring ranks get the same bracket
            lo, hi = max(0, place - 2), min(_GRID, place + 2)
            s.lo, s.hi = p["seen"][lo], p["seen"][hi]
            s.expect = int(n * ((hi - lo) / _GRID + 2 / buckets)) + 2
        return None
    raise ValueError("rank beyond the number of values")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    **kw) -> dict[str, dict[float, float | None]]:
    """``{col: {p: value}}`` with linear interpolation; empty column gives None."""
    plan: dict[tuple[int, float], tuple[int, int, float]] = {}

    def ranks_for(counts: dict[int, int]) -> dict[int, set]:
        ranks: dict[int, set] = {}
        for i, n in counts.items():
            if not n:
                continue
            for p in probs:
                pos = p * (n - 1)
                lo = int(math.floor(pos))
                hi = min(lo + 1, n - 1)
                plan[(i, p)] = (lo, hi, pos - lo)
                ranks.setdefault(i, set()).update({lo, hi})
        return ranks

    stats = order_statistics(df, cols, ranks_for, **kw)
    out: dict[str, dict[float, float | None]] = {}
    for i, c in enumerate(cols):
        out[c] = {}
        for p in probs:
            if (i, p) not in plan:
                out[c][p] = None
                continue
            lo, hi, frac = plan[(i, p)]
            a, b = stats[(i, lo)], stats[(i, hi)]
            if not frac or a == b:
                out[c][p] = a
            elif math.isinf(a) or math.isinf(b):
                out[c][p] = a * (1 - frac) + b * frac  # the infinite end wins
            else:
                out[c][p] = a + (b - a) * frac
    return out


def exact_median(df: DataFrame, col: str, **kw) -> float | None:
    return exact_quantiles(df, [col], [0.5], **kw)[col][0.5]


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10_000) -> dict[str, dict[float, float | None]]:
    """One-pass sketch alternative (``percentile_approx``) for very large inputs."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        vals = row[f"q{i}"]
        out[c] = {p: (vals[j] if vals is not None else None) for j, p in enumerate(probs)}
    return out


def mode_value(df: DataFrame, col: str):
    """Most frequent non-NULL value, smallest on ties; None when all NULL."""
    return mode_values(df, [col])[col]


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict:
    """Modes of several columns, one job per column type.

    (column, value) pairs are counted by a distributed ``groupBy`` with
    map-side combine; a second aggregation keeps, per column, the minimum of
    ``(-count, value)`` -- the most frequent value, smallest on ties (in the
    column's own ordering).  The driver receives one row per column; no group
    is ever gathered in one task.
    """
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = {}
    for group in by_type.values():
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("k"), F.col(c).alias("v")) for i, c in enumerate(group)
        ])).alias("e")).select("e.k", "e.v").where(F.col("v").isNotNull())
        counts = pairs.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("k").agg(
            F.min(F.struct((-F.col("n")).alias("nn"), F.col("v").alias("v"))).alias("b"))
        found = {r["k"]: r["b"]["v"] for r in best.collect()}
        out.update({c: found.get(i) for i, c in enumerate(group)})
    return {c: out.get(c) for c in cols}
