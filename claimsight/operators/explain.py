"""Model explanation as distributed jobs.

Every explanation scores synthetic rows built *from the data* with one call of
the model's ``transform`` (or any ``DataFrame -> DataFrame`` scorer), so the
work is spread over the executors and grows linearly with the rows explained:

* X1 Shapley sampling: each explained row is paired, per sample, with one
  background row chosen by hash (an equi-join to a written background of
  bounded size -- never a cross product), and one random feature order; the
  "with" and "without" rows for every feature are scored together.
  ``shapley_adaptive`` walks along each order and its reverse, keeps running
  variances, and goes on only with the rows whose standard error is too large.
* X2 exact contributions of a linear model, ``coef * (x - mean)``, also through
  the slots of a fitted pipeline.
* X5 accumulated local effects: every row scored at both edges of its bin.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight import config as K
from claimsight.operators.filters import sample_n
from claimsight.operators.ordering import numbered
from claimsight.plans.scoring import materialize

Scorer = Callable[[DataFrame], DataFrame]  # adds a double column "prediction"


# --------------------------------------------------------------------------- X2
def shapley_linear(rows: DataFrame, coefficients: dict[str, float], means: dict[str, float],
                   id_col: str = "Claim_ID", transforms: dict[str, Callable[[Column], Column]] | None = None
                   ) -> DataFrame:
    """Exact contributions of a linear model: ``coef_f * (t(x_f) - mean_f)``.

    ``transforms`` maps a feature to the transformation the model applies
    (for example ``log1p``); ``means`` are the background means of the
    transformed features.  Long output: ``id, feature, value, contribution``.
    """
    transforms = transforms or {}
    parts = []
    for f, c in coefficients.items():
        t = transforms.get(f, lambda x: x)(F.col(f).cast("double"))
        parts.append(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                              (F.lit(c) * (t - F.lit(means[f]))).alias("contribution")))
    return rows.select(id_col, F.inline(F.array(*parts)))


def slot_groups(features_field) -> list[tuple[str, int, int]]:
    """Source columns of an assembled vector from its attribute metadata: name, first slot, number of slots, in slot order."""
    attrs = features_field.metadata.get("ml_attr", {}).get("attrs", {})
    out: list[list] = []
    for index, name in sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind):
        if name.startswith("__ohe_"):
            column = next((c for c in K.CATEGORICAL_FEATURES if name.startswith(f"__ohe___cat_{c}_") or name.startswith(f"__ohe_{c}_")), None)
            column = column or name.removeprefix("__ohe_").removeprefix("__cat_").rsplit("_", 1)[0]
        else:
            column = name.removeprefix("__num_")
        if out and out[-1][0] == column:
            out[-1][2] += 1
        else:
            out.append([column, index, 1])
    return [tuple(g) for g in out]


def shapley_linear_model(rows: DataFrame, model: PipelineModel, background: DataFrame, id_col: str = "Claim_ID") -> DataFrame:
    """Exact log-scale contributions of every source column of a fitted linear pipeline.

    A column's contribution is the sum over its slots (one scaled number, or the levels of a category) of
    ``coefficient * (slot - background mean of the slot)``; the slots come from the attribute metadata of the
    assembled vector.  Contributions of a row add up to its prediction minus the mean prediction of the background.  One
    aggregate over the background, then row-wise.  Long output: ``id, feature, contribution``.
    """
    prep, linear = PipelineModel(stages=model.stages[:-1]), model.stages[-1]
    assembled = prep.transform(background).select("features")
    groups = slot_groups(assembled.schema["features"])
    if sum(n for _, _, n in groups) != len(linear.coefficients):
        raise ValueError("the model's slots are not all described by the attributes of its features")
    means = assembled.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    c = linear.coefficients.toArray()
    parts = []
    for name, first, n in groups:
        mine = F.lit([float(x) for x in c[first:first + n]])
        dot = F.aggregate(F.zip_with(F.slice("__v", first + 1, n), mine, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
        parts.append(F.struct(F.lit(name).alias("feature"), (dot - F.lit(float(c[first:first + n] @ means[first:first + n]))).alias("contribution")))
    return prep.transform(rows).select(id_col, vector_to_array("features").alias("__v")).select(id_col, F.inline(F.array(*parts)))


# --------------------------------------------------------------------------- X1
def hash60(*cols: Column) -> Column:
    """A 60-bit integer from the MD5 of the values joined by ``-``.

    Portable: any SQL engine with ``md5`` reproduces the background choice and
    feature order (first 15 hex digits read as an integer).
    """
    text = F.concat_ws("-", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def shapley_sampling(rows: DataFrame, background: DataFrame, scorer: Scorer, features: Sequence[str],
                     id_col: str = "Claim_ID", samples: int = 32, background_rows: int = 100,
                     seed: int = K.RANDOM_STATE, partitions: int | None = None) -> DataFrame:
    """Sampled Shapley contributions of ``features`` for every row of ``rows``.

    Background: at most ``background_rows`` rows of ``background`` (a seeded
    sample, written once).
    For sample ``s`` of row ``i``: background row ``hash(i, s) mod B`` and
    feature order by ``hash(i, s, f)``.  Output long: ``id, feature,
    contribution`` averaged over samples; contributions of a row sum to
    ``f(x) - mean_s f(b_s)``.
    """
    feats = list(features)
    nf = len(feats)
    bg = sample_n(background.select(*feats), background_rows, seed=seed, id_col=feats[0]) \
        if id_col not in background.columns else sample_n(background, background_rows, seed, id_col)
    bg = bg.select(*[F.col(f).alias(f"__b_{f}") for f in feats])
    # index the (bounded) background 0..B-1; the window sees at most B rows
    bg = bg.withColumn("__bidx", F.row_number().over(Window.orderBy(*[f"__b_{f}" for f in feats])) - 1)
    bg = materialize(rows.sparkSession, bg, f"shapley_background/{uuid.uuid4().hex}")
    n_bg = bg.count()
    if n_bg == 0:
        raise ValueError("empty background")
    pairs = (rows.select(id_col, *feats)
             .withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
             .withColumn("__bidx", F.pmod(hash60(F.col(id_col), F.col("__s"), F.lit(seed)),
                                          F.lit(n_bg)).cast("int")))
    pairs = pairs.join(bg, "__bidx")
    # The explained rows often come from a top-n sample (a single partition);
    # spread the (row, sample) pairs before the features x 2 expansion.
    n_parts = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by id only: the final groupBy(id, feature) then needs no second shuffle
    pairs = pairs.repartition(n_parts, id_col)
    ranks = [hash60(F.col(id_col), F.col("__s"), F.lit(i), F.lit(seed + 1)) for i in range(nf)]
    pairs = pairs.withColumn("__r", F.array(*ranks))
    # one row per (row, sample, feature j, with/without j)
    mixed = (pairs.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(nf - 1))))
             .withColumn("__with", F.explode(F.array(F.lit(True), F.lit(False)))))
    rj = F.element_at(F.col("__r"), F.col("__j") + 1)
    cols = {}
    for i, f in enumerate(feats):
        ri = F.element_at(F.col("__r"), F.lit(i + 1))
        before = (ri < rj) | ((ri == rj) & (F.lit(i) < F.col("__j")))
        own = F.col("__j") == i
        cols[f] = (F.when(own, F.when(F.col("__with"), F.col(f)).otherwise(F.col(f"__b_{f}")))
                   .when(before, F.col(f)).otherwise(F.col(f"__b_{f}")))
    mixed = mixed.withColumns(cols).select(id_col, "__s", "__j", "__with", *feats)
    scored = scorer(mixed)
    signed = F.when(F.col("__with"), F.col("prediction")).otherwise(-F.col("prediction"))
    # Rows that share an id are explained together, by the mean of their contributions.
    contrib = scored.groupBy(id_col, "__j").agg((F.sum(signed) * 2 / F.count(F.lit(1))).alias("contribution"))
    names = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("__j") + 1)
    return contrib.select(id_col, names.alias("feature"), "contribution")


def shapley_adaptive(rows: DataFrame, background: DataFrame, scorer: Scorer, features: Sequence[str], tolerance: float,
                     id_col: str = "Claim_ID", first_pairs: int = 8, most_pairs: int = 64, background_rows: int | None = None,
                     seed: int = K.RANDOM_STATE) -> DataFrame:
    """Sampled Shapley contributions with known errors.

    A sample is a background row and an order of the features, taken forwards and backwards (antithetic: the two
    errors partly cancel).  Along an order the features change one by one from the background's to the row's values,
    so ``2 * features`` scored rows give two marginal effects of every feature.  ``std_error`` is that of the mean over these pairs.  Rounds double
    the pairs of the rows that still have a ``std_error`` above ``tolerance`` in some feature, up to ``most_pairs``.

    The background is all of ``background`` (or ``background_rows`` of it by hash), written and numbered once and met by an equi-join.
    Output long: ``id, feature, contribution, std_error, pairs, base, prediction``; a row's contributions add up to ``prediction - base``.
    Rows that share an id are explained together.
    """
    spark, feats = rows.sparkSession, list(features)
    nf = len(feats)
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"#{seed}")))
    bg = numbered(background.select(id_col, *feats), key, id_col, "shapley_background")
    if background_rows is not None:
        bg = bg.where(F.col("__number") < background_rows)
    bg = materialize(spark, bg.select(F.col("__number").alias("__bidx"), *[F.col(f).alias(f"__b_{f}") for f in feats]), f"shapley_background/{uuid.uuid4().hex}")
    n_bg = bg.count()
    if n_bg == 0:
        raise ValueError("empty background")
    own = materialize(spark, rows.select(id_col, *feats).withColumn("__row", F.monotonically_increasing_id()), f"shapley_rows/{uuid.uuid4().hex}")
    state, active, done = None, own, 0
    while done < most_pairs:
        count = min(done or first_pairs, most_pairs - done)
        part = _pair_moments(active, bg, n_bg, scorer, feats, id_col, done, count, seed)
        state = materialize(spark, part if state is None else _merged_moments(state, part, id_col), f"shapley_state/{uuid.uuid4().hex}")
        done += count
        open_ = state.where((F.col("pairs") >= done) & (_std_error() > tolerance)).select(id_col).distinct()
        active = materialize(spark, own.join(open_.withColumnRenamed(id_col, "__id"), F.col(id_col).eqNullSafe(F.col("__id")), "left_semi"),
                             f"shapley_rows/{uuid.uuid4().hex}")
        if done < most_pairs and active.isEmpty():
            break
    names = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("__j") + 1)
    return state.select(id_col, names.alias("feature"), F.col("mean").alias("contribution"), _std_error().alias("std_error"), "pairs", "base", "prediction")


def _std_error() -> Column:
    """Of the mean over the pairs; unknown (NULL) for a single pair."""
    return F.when(F.col("pairs") > 1, F.sqrt(F.col("m2") / (F.col("pairs") - 1) / F.col("pairs")))


def _pair_moments(rows: DataFrame, bg: DataFrame, n_bg: int, scorer: Scorer, feats: list[str], id_col: str, first: int, count: int,
                  seed: int) -> DataFrame:
    """Per id and feature ``__j``: pairs, mean and sum of squared deviations of the pairs ``first`` .. ``first + count - 1``."""
    nf = len(feats)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def place(i: int) -> Column:  # of feature i in the order of this row and sample
        tickets = F.array(*[F.struct(hash60(F.col(id_col), F.col("__s"), F.lit(j), F.lit(seed + 1)).alias("t"), F.lit(j).alias("j")) for j in range(nf)])
        return F.array_position(F.transform(F.array_sort(tickets), lambda x: x["j"]), i) - 1

    pairs = (rows.withColumn("__s", F.explode(F.sequence(F.lit(first), F.lit(first + count - 1))))
             .withColumn("__bidx", F.pmod(hash60(F.col(id_col), F.col("__s"), F.lit(seed)), F.lit(n_bg))))
    pairs = pairs.join(bg, "__bidx").repartition(parts, "__row")
    pairs = pairs.withColumn("__places", F.array(*[place(i) for i in range(nf)]))
    # States 0 .. nf go forwards from the background to the row; nf + 1 .. 2 nf - 1 are those in between on the way backwards.
    states = pairs.withColumn("__e", F.explode(F.sequence(F.lit(0), F.lit(2 * nf - 1))))
    own = {f: F.when(F.when(F.col("__e") <= nf, F.element_at("__places", i + 1) < F.col("__e"))
                     .otherwise(F.element_at("__places", i + 1) >= 2 * nf - F.col("__e")), F.col(f)).otherwise(F.col(f"__b_{f}"))
           for i, f in enumerate(feats)}
    states = states.select(id_col, "__row", "__s", "__places", "__e", *[v.alias(f) for f, v in own.items()])
    scored = scorer(states).groupBy("__row", "__s").agg(
        F.first(id_col).alias(id_col), F.first("__places").alias("__places"),
        F.transform(F.array_sort(F.collect_list(F.struct("__e", "prediction"))), lambda x: x["prediction"]).alias("__p"))
    at = lambda k: F.element_at("__p", (k + 1).cast("int"))  # noqa: E731  state k of the way forwards

    def back(k: Column) -> Column:  # state k of the way backwards
        return F.when(k == 0, at(F.lit(0))).when(k == nf, at(F.lit(nf))).otherwise(at(k + nf))

    def effect(i: int) -> Column:
        r = F.element_at("__places", i + 1)
        return (at(r + 1) - at(r) + back(nf - r) - back(nf - 1 - r)) / 2

    each = scored.select(id_col, at(F.lit(0)).alias("b"), at(F.lit(nf)).alias("p"),
                         F.posexplode(F.array(*[effect(i) for i in range(nf)])).alias("__j", "v"))
    return each.groupBy(id_col, "__j").agg(F.count("v").alias("pairs"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"),
                                           F.avg("b").alias("base"), F.avg("p").alias("prediction"))


def _merged_moments(state: DataFrame, part: DataFrame, id_col: str) -> DataFrame:
    """Moments of two disjoint sets of pairs together; ``part`` has some of the ids of ``state``."""
    new = part.select(F.col(id_col).alias("__id"), F.col("__j").alias("__k"), *[F.col(c).alias(f"__{c}") for c in ("pairs", "mean", "m2", "base", "prediction")])
    both = state.join(new, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__j") == F.col("__k")), "left")
    n, m = F.col("pairs"), F.coalesce("__pairs", F.lit(0))
    mix = lambda c: F.when(m > 0, F.col(c) + (F.col(f"__{c}") - F.col(c)) * m / (n + m)).otherwise(F.col(c)).alias(c)
    gap = F.col("__mean") - F.col("mean")
    return both.select(id_col, "__j", (n + m).alias("pairs"), mix("mean"),
                       F.when(m > 0, F.col("m2") + F.col("__m2") + gap * gap * n * m / (n + m)).otherwise(F.col("m2")).alias("m2"), mix("base"), mix("prediction"))


# --------------------------------------------------------------------------- X3, X4, K2, K3
def global_importance(contributions: DataFrame, k: int | None = 20) -> DataFrame:
    """Mean absolute contribution per feature, largest first; top ``k``."""
    g = (contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
         .orderBy(F.desc("importance"), "feature"))
    return g.limit(k) if k else g


def contribution_points(contributions: DataFrame, rows: DataFrame, id_col: str = "Claim_ID",
                        k: int = 20) -> DataFrame:
    """Long table ``feature, contribution, value`` for the top-k features.

    The top-k list has at most ``k`` rows (the bound that makes its broadcast safe).
    """
    top = global_importance(contributions, k).select("feature")
    feats = [f for f in rows.columns if f != id_col]
    values = rows.select(id_col, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in feats])))
    c = contributions.join(F.broadcast(top), "feature")
    return c.join(values, [id_col, "feature"], "left").select(id_col, "feature", "contribution", "value")


def contribution_waterfall(contributions: DataFrame, id_col: str = "Claim_ID") -> DataFrame:
    """Per row: non-zero contributions ordered by magnitude, then a total row (K3).

    ``step`` numbers the bars within each row; the total has ``feature`` =
    ``Prediction`` and the sum of contributions.
    """
    nz = contributions.where(F.col("contribution") != 0)
    w = Window.partitionBy(id_col).orderBy(F.desc(F.abs("contribution")), "feature")
    bars = nz.withColumn("step", F.row_number().over(w))
    total = nz.groupBy(id_col).agg(F.sum("contribution").alias("contribution"),
                                   (F.count(F.lit(1)) + 1).alias("step")) \
        .withColumn("feature", F.lit("Prediction"))
    return bars.select(id_col, "step", "feature", "contribution").unionByName(
        total.select(id_col, "step", "feature", "contribution"))


def business_context(df: DataFrame, feature_col: str = "feature") -> DataFrame:
    """Attach name, impact and action of each feature (C11).

    The context table is a fixed 8-row dimension, so broadcasting it is safe.
    """
    ctx = df.sparkSession.createDataFrame(
        list(K.FEATURE_BUSINESS_CONTEXT),
        "feature string, name string, business_impact string, actionable_insight string")
    return df.join(F.broadcast(ctx), df[feature_col] == ctx["feature"], "inner").drop(ctx["feature"])


# --------------------------------------------------------------------------- X5
def ale(rows: DataFrame, scorer: Scorer, feature: str, bins: int = 20) -> DataFrame:
    """First-order accumulated local effects of ``feature``.

    Equal-width bins between min and max; every row is scored at its bin's
    lower and upper edge; the mean difference per bin is accumulated in bin order (the window holds one row
    per bin) and centred by the count-weighted mean.  ``heterogeneity`` is the
    population std of the differences within the bin.
    """
    v = F.col(feature).cast("double")
    rng = rows.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo, hi = rng["lo"], rng["hi"]
    if lo is None:
        return rows.sparkSession.createDataFrame(
            [], "bin int, bin_start double, bin_end double, n bigint, effect double, heterogeneity double, "
                "ale double")
    width = (hi - lo) / bins if hi > lo else 1.0
    at = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    binned = rows.where(v.isNotNull()).withColumn("__bin", at)
    # Both edges are scored on the same row, as doubles whatever the feature's type: no shuffle, no row id.
    low, high = F.lit(lo) + F.col("__bin") * F.lit(width), F.lit(lo) + (F.col("__bin") + 1) * F.lit(width)
    held = binned.columns
    below = scorer(binned.withColumn(feature, low)).select(*held, F.col("prediction").alias("__below"))
    both = scorer(below.withColumn(feature, high)).select("__bin", "__below", "prediction")
    diffs = both.select("__bin", (F.col("prediction") - F.col("__below")).alias("__d"))
    per_bin = diffs.groupBy(F.col("__bin").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("__d").alias("effect"),
        F.stddev_pop("__d").alias("heterogeneity"))
    acc = per_bin.withColumn("__acc", F.sum("effect").over(
        Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    centre = F.sum(F.col("__acc") * F.col("n")).over(Window.partitionBy()) / \
        F.sum("n").over(Window.partitionBy())
    return acc.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
                      "n", "effect", "heterogeneity", (F.col("__acc") - centre).alias("ale"))


def ale_all(rows: DataFrame, scorer: Scorer, features: Sequence[str], bins: int = 20, sample: int | None = 10_000,
            id_col: str = "Claim_ID", seed: int = K.RANDOM_STATE) -> DataFrame:
    """``ale`` of several numeric features over one seeded sample of rows (None: all rows), with a ``feature`` column."""
    if sample is not None:
        rows = sample_n(rows, sample, seed, id_col)
    parts = [ale(rows, scorer, f, bins).withColumn("feature", F.lit(f)) for f in features]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
