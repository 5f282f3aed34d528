import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsight.operators import explain as X
from claimsight.operators import ml as ML
from claimsight.operators.split import is_test, train_test_split, with_split
from claimsight.plans.scoring import prepared_claims
from claimsight.sources import artifacts as A

from conftest import SF0001


@pytest.fixture(scope="module")
def prepared(spark):
    return prepared_claims(spark, SF0001).cache()


def test_split_disjoint_and_covering(spark, prepared):
    s = with_split(prepared)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == prepared.count()
    assert 0.1 < counts["test"] / prepared.count() < 0.3
    train, test = train_test_split(prepared)
    assert train.join(test, "Claim_ID").count() == 0


def test_unseen_and_null_category_is_zero_vector(spark, prepared):
    train, _ = train_test_split(prepared)
    prep = ML.fit_feature_pipeline(ML.with_label(train), numeric=["Driver_Age"], categorical=["Claim_Type"])
    new = prepared.limit(2).withColumn("Claim_Type", F.when(F.col("Claim_ID") >= 0, F.lit("Meteor")))
    vec = prep.transform(new).select("features").first()["features"].toArray()
    assert list(vec[1:]) == [0.0] * (len(vec) - 1)
    names = ML.feature_names(prep.transform(prepared.limit(1)))
    assert names[0] == "Driver_Age" and any("Collision" in n for n in names)


def test_model_beats_mean_and_roundtrips(spark, prepared, tmp_dir):
    train, test = train_test_split(prepared)
    tm = ML.fit_model(train, "elastic_net", {"regParam": 0.01, "maxIter": 50})
    m = ML.evaluate_model(test, tm.model)
    assert m["r2_log"] > 0.0
    version = A.save_model(spark, tm.model, tmp_dir, "elastic_net", tm.params, m)
    A.save_model(spark, tm.model, tmp_dir, "run_metadata", kind="metadata")
    listed = [r["name"] for r in A.list_models(spark, tmp_dir).collect()]
    assert listed == ["elastic_net"]
    loaded = A.load_model(spark, tmp_dir, "elastic_net", version)
    a = ML.score(test, tm.model).select("Claim_ID", "Predictions")
    b = ML.score(test, loaded).select("Claim_ID", F.col("Predictions").alias("P2"))
    assert a.join(b, "Claim_ID").where(F.abs(F.col("Predictions") - F.col("P2")) > 1e-9).count() == 0


def test_tune_returns_grid_table(spark, prepared):
    train, _ = train_test_split(prepared)
    tm, table = ML.tune(train, "elastic_net", {"regParam": [0.01, 1.0], "maxIter": [20]}, folds=3, parallelism=2)
    assert table.count() == 2 and tm.params["regParam"] in (0.01, 1.0)


def test_grid_sizes_match_reference_configuration():
    assert ML.grid_size("elastic_net") == 56 and ML.grid_size("hist_boosting") == 36
    assert ML.grid_size("gradient_boosting") == 27  # the split-size axis has no MLlib counterpart


def _linear_scorer(b):
    def s(df):
        return df.withColumn("prediction", F.lit(b) * F.col("x1") + F.lit(2 * b) * F.col("x2"))
    return s


def test_shapley_sampling_matches_linear_exact(spark):
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 3)) for i in range(40)], "Claim_ID long, x1 double, x2 double")
    bg = spark.createDataFrame([(1000 + i, float(i % 5), float(i % 4)) for i in range(30)],
                               "Claim_ID long, x1 double, x2 double")
    sampled = X.shapley_sampling(rows, bg, _linear_scorer(1.5), ["x1", "x2"], samples=64, background_rows=30)
    # for a linear model each sample gives coef * (x - b_s) exactly; check the additivity property
    per_row = sampled.groupBy("Claim_ID").agg(F.sum("contribution").alias("s"))
    assert per_row.count() == 40
    mean_bg = bg.agg(F.avg("x1"), F.avg("x2")).first()
    exact = X.shapley_linear(rows, {"x1": 1.5, "x2": 3.0}, {"x1": mean_bg[0], "x2": mean_bg[1]})
    joined = sampled.join(exact.withColumnRenamed("contribution", "e"), ["Claim_ID", "feature"])
    err = joined.agg(F.avg(F.abs(F.col("contribution") - F.col("e")))).first()[0]
    assert err < 1.0  # sampling error only (64 samples of a 30-row background)


def test_importance_waterfall_points(spark):
    contrib = spark.createDataFrame([(1, "a", 2.0), (1, "b", -3.0), (1, "c", 0.0), (2, "a", 1.0), (2, "b", 0.0)],
                                    "Claim_ID long, feature string, contribution double")
    imp = [r["feature"] for r in X.global_importance(contrib, k=2).collect()]
    assert imp == ["a", "b"]
    wf = X.contribution_waterfall(contrib).where("Claim_ID = 1").orderBy("step").collect()
    assert [(r["feature"], r["contribution"]) for r in wf] == [("b", -3.0), ("a", 2.0), ("Prediction", -1.0)]
    rows = spark.createDataFrame([(1, 5.0, 6.0, 7.0), (2, 8.0, 9.0, 1.0)], "Claim_ID long, a double, b double, c double")
    pts = X.contribution_points(contrib, rows, k=1).collect()
    assert {(r["Claim_ID"], r["feature"], r["value"]) for r in pts} == {(1, "a", "5.0"), (2, "a", "8.0")}


def test_ale_linear_slope(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(101)], "Claim_ID long, x double")
    out = X.ale(rows, lambda d: d.withColumn("prediction", F.col("x") * 3.0), "x", bins=10).orderBy("bin").collect()
    assert all(r["effect"] == pytest.approx(30.0) for r in out)
    assert sum(r["ale"] * r["n"] for r in out) == pytest.approx(0.0, abs=1e-6)


def test_business_context_join(spark):
    df = spark.createDataFrame([("Driver_Age", 1.0), ("Unknown", 2.0)], "feature string, v double")
    out = X.business_context(df).collect()
    assert [(r["feature"], r["name"]) for r in out] == [("Driver_Age", "Driver Age")]


def test_is_test_deterministic(spark, prepared):
    a = prepared.where(is_test()).select("Claim_ID").orderBy("Claim_ID").collect()
    b = prepared.repartition(3).where(is_test()).select("Claim_ID").orderBy("Claim_ID").collect()
    assert a == b


def test_ale_of_integers_and_repeated_ids(spark):
    scorer = lambda d: d.withColumn("prediction", F.col("x") * 3.0)
    rows = spark.createDataFrame([(i // 3, i % 11) for i in range(99)], "Claim_ID long, x bigint")
    out = X.ale(rows, scorer, "x", bins=4).orderBy("bin").collect()
    assert [r["effect"] for r in out] == [7.5] * 4 and sum(r["n"] for r in out) == 99
    assert all(r["heterogeneity"] < 1e-9 for r in out)
    both = X.ale_all(rows.withColumn("y", F.col("x") * 2.0), lambda d: d.withColumn("prediction", F.col("x") + F.col("y")), ["x", "y"], bins=4)
    assert {(r["feature"], r["effect"]) for r in both.collect()} == {("x", 2.5), ("y", 5.0)}


def test_shapley_of_repeated_ids_is_their_mean(spark):
    scorer = lambda d: d.withColumn("prediction", F.col("x") * 2.0)
    bg = spark.createDataFrame([(9, 0.0)], "Claim_ID long, x double")
    rows = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "Claim_ID long, x double")
    got = {r["Claim_ID"]: r["contribution"] for r in X.shapley_sampling(rows, bg, scorer, ["x"], samples=3).collect()}
    assert got == {1: 4.0, 2: 10.0}


def test_depth_beyond_the_limit_raises():
    with pytest.raises(ValueError):
        ML.random_forest(maxDepth=31)


def test_column_without_values(spark, prepared):
    train = prepared.withColumn("Driver_Age", F.lit(None).cast("double"))
    tm = ML.fit_model(train, "elastic_net", {"regParam": 0.0, "maxIter": 5}, numeric=["Driver_Age", "Estimated_Claim_Amount"], categorical=[])
    assert ML.score(train, tm.model).where("Predictions IS NULL").count() == 0


def test_run_table_keeps_the_scales_apart(spark, prepared):
    train, test = train_test_split(prepared)
    tm = ML.train_all(train, test, ["elastic_net"], {"elastic_net": {"regParam": 0.0, "maxIter": 10}})[0]
    r = ML.metrics_table(spark, [tm]).first()
    assert r["mse"] == pytest.approx(r["rmse"] ** 2) and r["mse_log"] == pytest.approx(r["rmse_log"] ** 2)
    assert r["mse_log"] < 10 < r["rmse"] and r["rmsle"] == pytest.approx(r["rmse_log"])


def test_tune_scores_every_point_on_both_measures(spark, prepared):
    train, _ = train_test_split(prepared)
    _, table = ML.tune(train, "elastic_net", {"regParam": [0.0, 0.5], "elasticNetParam": [0.5], "maxIter": [20]}, folds=3,
                       numeric=["Estimated_Claim_Amount"], categorical=[], train_scores=True)
    rows = table.collect()
    assert len(rows) == 2 and all(r[c] > 0 for r in rows for c in ("cv_rmsle", "cv_smape", "train_rmsle", "train_smape"))
    assert all(r["cv_smape"] <= 2 for r in rows)


def test_model_queries_do_the_whole_job(spark, monkeypatch):
    """All four models are compared; 3,000 test claims are explained with the operator's own samples and background."""
    from claimsight.plans import queries_models as Q

    asked = {}
    monkeypatch.setattr(Q, "sample_n", lambda df, n, *a, **b: asked.update(n=n) or df.limit(5))
    monkeypatch.setattr(Q.X, "shapley_sampling", lambda *a, **b: asked.update(b) or spark.createDataFrame(
        [(1, "x", 1.0)], "Claim_ID long, feature string, contribution double"))
    assert Q.q_shapley_model(spark, SF0001).count() == 1 and asked == {"n": 3000}
    assert sorted(r[0] for r in Q.q_compare_models(spark, SF0001).select("model").collect()) == sorted(Q.ML.BUILDERS)


def _vectors(spark, prepared):
    from claimsight.operators import tuning as T
    train, _ = train_test_split(prepared)
    labelled = ML.with_label(train)
    return T, labelled, ML.fit_feature_pipeline(labelled)


def _rmsle(model, vec, where):
    return model.transform(vec).where(where).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))).first()[0]


def test_penalty_path_equals_separate_fits(spark, prepared):
    T, labelled, prep = _vectors(spark, prepared)
    grid = {"regParam": [0.01, 0.3], "elasticNetParam": [0.1, 1.0], "maxIter": [1000, 5000], "tol": [1e-6]}
    vec, points, sums = T.search(labelled, prep, "elastic_net", ML.elastic_net, grid, 3, ML.cv_fold(3))
    assert len(points) == 8 and T.fits("elastic_net", grid, 3) == 0
    for i in (0, 3, 6):
        model = ML.elastic_net(**points[i]).fit(vec.where("fold <> 1"))
        assert sums[1].measures("held")[i][0] == pytest.approx(_rmsle(model, vec, "fold = 1"), rel=1e-4)
        assert sums[1].measures("used")[i][0] == pytest.approx(_rmsle(model, vec, "fold <> 1"), rel=1e-4)
    assert (sums[1].held[0::2] == sums[1].held[1::2]).all()  # more sweeps than needed change nothing


@pytest.mark.parametrize("name, grid, fits, exact", [
    ("gradient_boosting", {"maxIter": [2, 5], "stepSize": [0.1, 0.3], "maxDepth": [2]}, 4, {"maxIter": (2, 5)}),
    ("random_forest", {"numTrees": [2, 4], "maxDepth": [2, 5], "minInstancesPerNode": [2]}, 2, {"numTrees": (4,)})])
def test_stages_equal_separate_fits(spark, prepared, name, grid, fits, exact):
    """Boosted stages of every size, and depths of the largest forest, score like models of their own."""
    T, labelled, prep = _vectors(spark, prepared)
    assert T.fits(name, grid, 2) == fits
    vec, points, sums = T.search(labelled, prep, name, ML.BUILDERS[name], grid, 2, ML.cv_fold(2), parallelism=2)
    (stage, sizes), = exact.items()
    for i, p in enumerate(points):
        model = ML.BUILDERS[name](**p).fit(vec.where("fold <> 0"))
        got, want = sums[0].measures("held")[i][0], _rmsle(model, vec, "fold = 0")
        assert got == pytest.approx(want, rel=1e-9 if p[stage] in sizes else 0.25)
    assert all(s.held[:, 1].sum() + s.used[:, 1].sum() == len(points) * vec.count() for s in sums)


def test_path_without_spread_or_label_deviation():
    from claimsight.operators.tuning import Problem
    z = np.column_stack([np.ones(6), [1, 1, 1, 1, 1, 1], [0, 1, 0, 1, 0, 1], [3.0] * 6])
    point = {"regParam": 0.1, "elasticNetParam": 0.5, "maxIter": 10, "tol": 1e-4}
    assert Problem.of(z.T @ z).path([point, point | {"regParam": 0.0}])[0].tolist() == [3.0, 0.0, 0.0]
    z[:, 3] = [1, 2, 1, 2, 1, 2]
    free, = Problem.of(z.T @ z).path([point | {"regParam": 0.0}])
    assert np.allclose(z[:, :3] @ free, z[:, 3])


def _bent(d):
    return d.withColumn("prediction", F.col("x1") * F.col("x2") + F.abs(F.col("x1") - F.col("x3")) + 5 * F.col("x3"))


def _points(spark, n, first=0):
    return spark.createDataFrame([(first + i, float(i * 7 % 11), float(i % 4), float(i * 3 % 5)) for i in range(n)],
                                 "Claim_ID long, x1 double, x2 double, x3 double")


def test_adaptive_contributions_add_up_and_stop(spark):
    rows, bg = _points(spark, 30), _points(spark, 70, 1000)
    out = X.shapley_adaptive(rows, bg, _bent, ["x1", "x2", "x3"], tolerance=2.5, first_pairs=4, most_pairs=32).collect()
    by = {}
    for r in out:
        by.setdefault(r["Claim_ID"], []).append(r)
    want = {r["Claim_ID"]: r["prediction"] for r in _bent(rows).collect()}
    assert set(by) == set(want) and all(len(v) == 3 for v in by.values())
    for i, parts in by.items():
        assert sum(r["contribution"] for r in parts) == pytest.approx(parts[0]["prediction"] - parts[0]["base"])
        assert parts[0]["prediction"] == pytest.approx(want[i]) and len({r["pairs"] for r in parts}) == 1
        worst = max(r["std_error"] for r in parts)
        assert parts[0]["pairs"] == 32 or worst <= 2.5
    assert {v[0]["pairs"] for v in by.values()} > {32}  # some rows went on, some stopped before


def test_adaptive_contributions_converge_to_exact_ones(spark):
    """Every order and background row, by hand, is within a few standard errors."""
    import itertools
    rows, bg = _points(spark, 4), _points(spark, 40, 500)
    f = lambda x: x[0] * x[1] + abs(x[0] - x[2]) + 5 * x[2]
    back = [tuple(r)[1:] for r in bg.collect()]
    out = X.shapley_adaptive(rows, bg, _bent, ["x1", "x2", "x3"], tolerance=0.0, first_pairs=16, most_pairs=256).collect()
    got = {(r["Claim_ID"], r["feature"]): r for r in out}
    for row in rows.collect():
        x = tuple(row)[1:]
        exact = [0.0] * 3
        for b in back:
            for order in itertools.permutations(range(3)):
                now = list(b)
                for j in order:
                    old = f(now)
                    now[j] = x[j]
                    exact[j] += (f(now) - old) / 6 / len(back)
        for j in range(3):
            r = got[row["Claim_ID"], f"x{j + 1}"]
            assert r["pairs"] == 256 and abs(r["contribution"] - exact[j]) <= 4.5 * r["std_error"] + 1e-9


def test_adaptive_with_one_feature_copies_and_a_small_background(spark):
    rows = _points(spark, 3).select("Claim_ID", "x1")
    line = lambda d: d.withColumn("prediction", 2 * F.col("x1"))
    out = X.shapley_adaptive(rows.union(rows), _points(spark, 9, 50).select("Claim_ID", "x1"), line, ["x1"], tolerance=0.1, first_pairs=3,
                             most_pairs=5, background_rows=1).collect()
    assert len(out) == 3 and all(r["pairs"] == 6 and r["std_error"] == 0 and r["contribution"] == pytest.approx(r["prediction"] - r["base"]) for r in out)
    with pytest.raises(ValueError):
        X.shapley_adaptive(rows, rows.limit(0), line, ["x1"], tolerance=0.1)
    assert X.shapley_adaptive(rows.limit(0), rows, line, ["x1"], tolerance=0.1).count() == 0


def test_numbers_follow_the_order(spark):
    df = spark.createDataFrame([(i, (i * 37) % 101) for i in range(101)], "Claim_ID long, v long").repartition(7)
    got = X.numbered(df, F.col("v"), "Claim_ID", "test_numbers").collect()
    assert sorted((r["__number"], r["v"]) for r in got) == [(i, i) for i in range(101)]


def test_linear_pipeline_contributions_add_up(spark, prepared):
    train, test = train_test_split(prepared)
    tm = ML.fit_model(train, "elastic_net", {"regParam": 0.01, "elasticNetParam": 0.5, "maxIter": 200})
    out = X.shapley_linear_model(test, tm.model, train)
    feats = {r[0] for r in out.select("feature").distinct().collect()}
    assert feats == {c for c in (*ML.K.NUMERIC_FEATURES, *ML.K.CATEGORICAL_FEATURES) if c in prepared.columns}
    mean = tm.model.transform(train).agg(F.avg("prediction")).first()[0]
    sums = out.groupBy("Claim_ID").agg(F.sum("contribution").alias("s"))
    off = tm.model.transform(test).select("Claim_ID", "prediction").join(sums, "Claim_ID").agg(F.max(F.abs(F.col("prediction") - F.col("s") - mean))).first()[0]
    assert off < 1e-9


def test_preprocessing_reads_written_columns(spark, monkeypatch):
    """Statistics of the preprocessing read written columns: features are derived once, also for a search; a column without any value is allowed."""
    from claimsight.operators import ml as ML
    derived = spark.range(60).select(F.col("id").alias("Claim_ID"), (F.col("id") % 7).cast("double").alias("n"), F.lit(None).alias("none"),
                                     F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"), (F.col("id") + 1.0).alias(ML.K.TARGET))
    fit, read = ML.fit_feature_pipeline, []
    monkeypatch.setattr(ML, "fit_feature_pipeline", lambda rows, *a: read.append(rows) or fit(rows, *a))
    some = {"numeric": ["n", "none"], "categorical": ["c"]}
    _, vec = ML.training_vectors(derived, **some)
    assert vec.count() == 60
    _, table = ML.tune(derived, "elastic_net", {"regParam": [0.1]}, folds=2, **some)
    assert table.count() == 1
    assert [r.columns for r in read] == [["n", "none", "c", "label"], ["n", "none", "c", "label", "__fold"]]
    assert all(r.inputFiles() and all("/training/" in f for f in r.inputFiles()) for r in read)


def test_training_vectors_are_dealt_over_files(spark, monkeypatch):
    from claimsight.operators import ml as ML
    monkeypatch.setattr(ML, "VECTOR_FILE_ROWS", 20)
    rows = spark.range(50).coalesce(1).select(F.col("id").cast("double").alias("n"), (F.col("id") + 1.0).alias(ML.K.TARGET))
    _, vec = ML.training_vectors(rows, ["n"], [])
    assert len(vec.inputFiles()) == 3 and vec.count() == 50


@pytest.mark.parametrize("name, points", [("random_forest", 24), ("gradient_boosting", 27)])
def test_tree_searches_cover_the_configured_grid(spark, monkeypatch, name, points):
    """Every configured point and all five folds, over all training claims."""
    import inspect

    from claimsight.plans import queries_models as Q

    asked = {}
    signature = inspect.signature(ML.tune)

    def tune(*a, **b):
        call = signature.bind(*a, **b)
        call.apply_defaults()
        asked.update(call.arguments)
        return None, spark.createDataFrame([({}, 1.0)], "params map<string,string>, cv_rmsle double")

    monkeypatch.setattr(Q.ML, "tune", tune)
    assert getattr(Q, f"q_tune_{name}")(spark, SF0001).count() == 1
    grid = asked["grid"] or ML.GRIDS[asked["name"]]
    assert asked["name"] == name and asked["folds"] == ML.K.CV_FOLDS and asked["train_scores"]
    assert grid == ML.GRIDS[name] and ML.grid_size(name) == points
    assert asked["train"].count() == train_test_split(Q.prepared(spark, SF0001))[0].count()


def test_boosted_models_of_a_search_grow_side_by_side(spark, prepared, monkeypatch):
    """Depths and steps share every pass, past a checkpoint too, and score like MLlib's own fits; rows without a fold are scored only."""
    T, labelled, prep = _vectors(spark, prepared)
    monkeypatch.setattr(T, "tree_scores", lambda *a: pytest.fail("fitted one by one"))
    grid = {"maxIter": [3, 12], "stepSize": [0.3], "maxDepth": [1, 2]}
    fold = F.when(F.col("Claim_ID") % 50 != 0, ML.cv_fold(2))
    vec, points, sums = T.search(labelled, prep, "gradient_boosting", ML.gradient_boosting, grid, 2, fold)
    for i in (0, 2):  # at depth 1 no two features part the rows alike
        model = ML.gradient_boosting(**points[i]).fit(vec.where("fold <> 1"))
        assert sums[1].measures("held")[i][0] == pytest.approx(_rmsle(model, vec, "fold = 1"), rel=1e-9)
        assert sums[1].measures("used")[i][0] == pytest.approx(_rmsle(model, vec, "fold is null or fold <> 1"), rel=1e-9)


def test_split_candidates_of_a_boosted_search():
    from claimsight.operators.boosting import Layout, _candidates
    v = np.array([0.0, 0.0, 1.0, 2.0, 2.0, 4.0])
    assert _candidates(v, 6, 5).tolist() == [0.5, 1.5, 3.0]
    assert _candidates(np.arange(1.0, 101.0), 100, 3).tolist() == [25.5, 50.5, 75.5]
    assert _candidates(np.zeros(4), 4, 3).tolist() == []
    layout = Layout([0], [[1, 2], [3]], [[np.array([0.5])]], 2)
    codes = layout.codes(np.array([[0.2, 1, 0, 0], [0.9, 0, 1, 1], [0.5, 0, 0, 1]]))
    assert codes.tolist() == [[0, 1, 0], [1, 5, 3]] and layout.hot(3)[1].tolist() == [False] * 3 + [True] * 3
    with pytest.raises(ValueError):
        layout.codes(np.array([[0.2, 1, 1, 0]]))


def test_several_models_are_evaluated_on_written_test_rows(spark, prepared, monkeypatch):
    """Features of the test split are derived once for all models, whose metrics are those of the derived rows."""
    train, test = train_test_split(prepared)
    evaluate, read = ML.evaluate_model, []
    monkeypatch.setattr(ML, "evaluate_model", lambda rows, *a: read.append(rows) or evaluate(rows, *a))
    some = {"numeric": ["Driver_Age", "Estimate_Relative_to_Type"], "categorical": ["Claim_Type"]}
    models = ML.train_all(train, test, ["elastic_net", "gradient_boosting"], {"elastic_net": {"regParam": 0.01}, "gradient_boosting": {"maxIter": 2}}, **some)
    assert all(r.inputFiles() and all("/training/" in f for f in r.inputFiles()) for r in read) and len(read) == 2
    for tm in models:
        want = ML.run_metrics(evaluate(test, tm.model))
        assert tm.metrics.keys() == want.keys() and all(tm.metrics[k] == pytest.approx(want[k], rel=1e-9) for k in want)
