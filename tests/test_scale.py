"""Exact splits, level tables, skewed joins, several models, batches that count once, observed writes."""

import math
import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from claimsight.operators import levels as L
from claimsight.operators import ml as ML
from claimsight.operators.joins import merge_claims_policies, merge_skewed, null_key_rows
from claimsight.operators.ordering import smallest_hex
from claimsight.operators.split import exact_train_test_split, train_test_split, with_exact_split
from claimsight.plans.scoring import prepared_claims
from claimsight.sources import artifacts as A
from claimsight.sources import history as H

from conftest import SF0001


@pytest.fixture(scope="module")
def prepared(spark):
    return prepared_claims(spark, SF0001)


# --------------------------------------------------------------------------- exact split
@pytest.mark.parametrize("n", [0, 1, 2, 5, 15, 1000])
def test_exact_share(spark, n):
    both = with_exact_split(spark.range(n).withColumnRenamed("id", "Claim_ID"))
    counts = {r["split"]: r["count"] for r in both.groupBy("split").count().collect()}
    assert counts.get("test", 0) == math.ceil(n / 5) and sum(counts.values()) == n


def test_exact_split_is_stable_and_whole(spark):
    df = spark.range(2000).withColumnRenamed("id", "Claim_ID")
    side = lambda d: {r["Claim_ID"] for r in with_exact_split(d).where("split = 'test'").collect()}
    one, more = side(df), side(spark.range(2200).withColumnRenamed("id", "Claim_ID"))
    assert len(one) == 400 and len(one - more) <= 60  # two hundred more rows move the limit, little else
    train, test = exact_train_test_split(df)
    assert (train.count(), test.count()) == (1600, 400) and train.columns == ["Claim_ID"]


def test_exact_split_of_missing_and_repeated_ids(spark):
    rows = [(None, i) for i in range(50)] + [(7, 1)] * 20 + [(i, 0) for i in range(100, 130)]
    both = with_exact_split(spark.createDataFrame(rows, "Claim_ID long, v int"))
    assert len({r["split"] for r in both.where("Claim_ID = 7").collect()}) == 1
    assert 20 <= both.where("split = 'test'").count() < 40 and both.where("split is null").count() == 0
    with pytest.raises(ValueError):
        with_exact_split(both, fraction=1.5)


@pytest.mark.parametrize("final", [1, 10, 10_000])
def test_smallest_hex(spark, final):
    df = spark.range(300).select(F.md5((F.col("id") % 120).cast("string")).alias("h"))
    want = sorted(r["h"] for r in df.collect())
    for k in (1, 2, 150, 300):
        assert smallest_hex(df, F.col("h"), k, final_rows=final) == want[k - 1]
    assert smallest_hex(df, F.col("h"), 0) == ""
    with pytest.raises(ValueError):
        smallest_hex(df, F.col("h"), 301)


# --------------------------------------------------------------------------- levels
def test_levels_by_rank_and_bucket(spark):
    rows = ["b"] * 3 + ["a"] * 3 + ["c"] * 2 + ["d", "e's \\", None]
    df = spark.createDataFrame([(v,) for v in rows], "v string")
    table = L.level_table(df, "v")
    assert {r["level"]: (r["n"], r["rank"]) for r in table.collect()} == {"a": (3, 0), "b": (3, 1), "c": (2, 2), "d": (1, 3), "e's \\": (1, 4)}
    slots = {r["v"]: r["slot"] for r in L.with_slot(df, "v", table, 2, 4).collect()}
    assert slots["a"] == 0 and slots["b"] == 1 and slots[None] is None and all(2 <= slots[v] < 6 for v in ("c", "d", "e's \\"))
    assert {r["v"]: r["slot"] for r in L.with_slot(df, "v", table, 2, 0).collect()}["c"] is None


def test_level_pipeline_is_sparse_saved_and_takes_unseen_values(spark, tmp_dir):
    from pyspark.ml import PipelineModel
    from pyspark.ml.linalg import SparseVector
    train = spark.createDataFrame([(float(i), f"p'{i % 50}\\", "x" if i % 3 else None) for i in range(200)], "n double, p string, q string")
    prep = L.fit_level_pipeline(train, ["n"], ["p", "q"], most_levels=20, buckets=8)
    prep.write().save(f"{tmp_dir}/prep")
    odd = train.union(spark.createDataFrame([(1.0, "new", "never"), (None, None, None)], train.schema))
    out = PipelineModel.load(f"{tmp_dir}/prep").transform(odd)
    assert out.count() == 202
    vectors = [r["features"] for r in out.collect()]
    assert all(v.size == 1 + 20 + 8 + 1 + 8 for v in vectors) and any(isinstance(v, SparseVector) for v in vectors)
    assert all(sum(x != 0 for x in v.toArray()[1:]) == 2 for v in vectors)
    none = L.fit_level_pipeline(train, ["n"], ["p"], most_levels=5, buckets=0).transform(odd)
    assert {int(sum(r["features"].toArray()[1:])) for r in none.collect()} == {0, 1}


# --------------------------------------------------------------------------- skewed join
def _sides(spark):
    claims = spark.range(6000).select(F.col("id").alias("Claim_ID"), F.when(F.col("id") % 100 == 0, None).when(F.col("id") % 2 == 0, 1)
                                      .otherwise(F.col("id") % 500).cast("long").alias("Policy_ID"), F.lit("c").alias("note"))
    policies = spark.range(400).select(F.when(F.col("id") % 90 == 7, None).otherwise(F.col("id")).cast("long").alias("Policy_ID"), F.lit("p").alias("note"))
    return claims, policies


def test_skewed_merge_equals_the_plain_one(spark):
    claims, policies = _sides(spark)
    rows = lambda d: Counter(map(tuple, d.select(*sorted(d.columns)).collect()))
    plain = rows(merge_claims_policies(claims, policies, ["Policy_ID"]))
    assert null_key_rows(claims, policies, ["Policy_ID"]) == (60, 5)
    for heavy in (10, 500, 10 ** 6):
        out = merge_skewed(claims, policies, ["Policy_ID"], heavy_rows=heavy)
        assert rows(out) == plain and out.columns == merge_claims_policies(claims, policies, ["Policy_ID"]).columns
    apart = rows(merge_skewed(claims, policies, ["Policy_ID"], nulls="apart", heavy_rows=500))
    assert apart == rows(merge_claims_policies(claims, policies, ["Policy_ID"], null_safe=False))
    with pytest.raises(ValueError, match="60 claims and 5 policies"):
        merge_skewed(claims, policies, ["Policy_ID"], nulls="refuse")
    with pytest.raises(ValueError):
        merge_skewed(claims, policies, ["Policy_ID"], nulls="maybe")
    assert merge_skewed(claims.limit(0), policies, ["Policy_ID"]).count() == 0


def test_a_hot_policy_is_spread_over_tasks(spark):
    claims, policies = _sides(spark)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tasks = merge_skewed(claims, policies, ["Policy_ID"], heavy_rows=100).groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in tasks)
        assert len(sizes) > 8 and sizes[-1] <= 4 * sizes[len(sizes) // 2]
        hot = merge_claims_policies(claims, policies, ["Policy_ID"]).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in hot) > sizes[-1]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# --------------------------------------------------------------------------- several models in one scan
def test_models_share_their_preprocessing(spark, prepared):
    train, test = train_test_split(prepared)
    params = {"elastic_net": {"regParam": 0.01, "maxIter": 50}, "gradient_boosting": {"maxIter": 2, "maxDepth": 2}}
    models = {tm.name: tm.model for tm in ML.train_all(train, test, list(params), params)}
    assert len({m.stages[0].uid for m in models.values()}) == 1
    got = {r["Claim_ID"]: r["predictions"] for r in ML.score_models(test, models).collect()}
    for i, model in enumerate(models.values()):
        want = {r["Claim_ID"]: r["Predictions"] for r in ML.score(test, model).select("Claim_ID", "Predictions").collect()}
        assert {k: v[i] for k, v in got.items()} == pytest.approx(want)
    plan = ML.score_models(test, models)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == test._jdf.queryExecution().executedPlan().toString().count("FileScan")  # one scan for all models
    own = {"a": ML.fit_model(train, "elastic_net", params["elastic_net"]).model, "b": models["gradient_boosting"]}
    assert ML.score_models(test, own).count() == test.count()


# --------------------------------------------------------------------------- history
def test_batches_count_once(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "Claim_ID long, Predictions double")
    with pytest.raises(AnalysisException):
        H.read_history(spark, tmp_dir)
    assert H.append_batch(df, tmp_dir, "2024-01-01") and not H.append_batch(df, tmp_dir, "2024-01-01")
    assert H.append_batch(df.limit(1), tmp_dir, "a/b=c d") and H.read_history(spark, tmp_dir).count() == 3
    # An attempt without a commit, and a second commit of the same batch, are not read.
    late = df.withColumns({"batch_id": F.lit("2024-01-01"), "scored_at": F.localtimestamp()})
    late.write.parquet(H._folder(tmp_dir, "2024-01-01", "late"))
    assert H.read_history(spark, tmp_dir).count() == 3
    H.commit(spark, tmp_dir, "2024-01-01", "late")
    rows = H.read_history(spark, tmp_dir)
    assert rows.count() == 3 and sorted({r["batch_id"] for r in rows.collect()}) == ["2024-01-01", "a/b=c d"]
    assert set(rows.columns) == {"Claim_ID", "Predictions", "batch_id", "scored_at"}


# --------------------------------------------------------------------------- observed writes
def test_metadata_comes_from_the_write_itself(spark, tmp_dir):
    df = spark.createDataFrame([(1, None, "2024-01-05 00:00:00"), (2, "x", "2023-01-01 10:00:00"), (3, None, None)],
                               "n int, `odd name` string, t string").withColumn("Accident_Date", F.col("t").cast("timestamp_ntz")).drop("t")
    sc, group = spark.sparkContext, "observed-write"
    sc.setJobGroup(group, "one write")
    try:
        A.write_processed(df, tmp_dir)
        observed = len(sc.statusTracker().getJobIdsForGroup(group))
        sc.setJobGroup(group + "-count", "write, then count")
        df.write.parquet(os.path.join(tmp_dir, "x"))
        A.dataset_metadata(df).write.parquet(os.path.join(tmp_dir, "y"))
        counted = len(sc.statusTracker().getJobIdsForGroup(group + "-count"))
    finally:
        sc.setJobGroup("rest", "")
    assert observed < counted
    m = A.read_metadata(spark, tmp_dir).first()
    assert (m["n_rows"], m["nulls"], m["first_time"], m["last_time"]) == (
        3, {"n": 0, "odd name": 2, "Accident_Date": 1}, "2023-01-01 10:00:00", "2024-01-05 00:00:00")
    assert A.dataset_metadata(df).first()["nulls"] is None


# --------------------------------------------------------------------------- rollup
def _portfolio(spark, n=400):
    import random
    rng = random.Random(7)
    rows = []
    for i in range(n):
        day = None if i % 41 == 0 else f"2023-{1 + i % 7:02d}-{1 + i % 28:02d} {i % 24:02d}:00:00"
        amount = None if i % 17 == 0 else rng.choice([12000.0, 12000.0, -50.0, 0.0, rng.uniform(0, 50000)])
        rows.append((i, None if i % 19 == 0 else i % 60, day, amount, 11000.0))
    return spark.createDataFrame(rows, "Claim_ID long, Policy_ID long, t string, Ultimate_Claim_Amount double, Predictions double").withColumn(
        "Accident_Date", F.col("t").cast("timestamp_ntz")).drop("t")


@pytest.mark.parametrize("start, end", [(None, None), ("2023-02-01", "2023-04-30"), ("2023-01-15", "2023-05-03"), ("2023-03-05", "2023-03-20"),
                                        ("2023-04-10", None), (None, "2023-02-02"), ("2030-01-01", "2031-01-01")])
def test_rollup_equals_the_claims(spark, tmp_path_factory, start, end):
    from claimsight.operators import portfolio as P
    from claimsight.operators.rollup import Rollup, build
    claims = _portfolio(spark)
    base = str(tmp_path_factory.getbasetemp() / "rollup")
    if not os.path.exists(base):
        build(claims, base)
    rollup, some = Rollup(spark, base), claims
    if start:
        some = some.where(F.col("Accident_Date").cast("date") >= F.lit(start).cast("date"))
    if end:
        some = some.where(F.col("Accident_Date").cast("date") <= F.lit(end).cast("date"))

    def same(a, b):
        rows = lambda d: sorted((tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in d.select(sorted(d.columns)).collect()), key=str)
        assert sorted(a.columns) == sorted(b.columns) and rows(a) == rows(b)

    same(rollup.kpis(start, end), P.portfolio_kpis(some))
    same(rollup.tiles(start, end), P.dashboard_tiles(some))
    for metric in ("exposure", "volume", "severity", "efficiency"):
        same(rollup.monthly(metric, start, end), P.monthly_metric(some, metric).withColumn("Month", F.col("Month")))
    same(rollup.trend(start, end), P.trend_volume(some))
    exact = some.agg(F.count_distinct("Policy_ID")).first()[0]
    assert abs(rollup.policies(start, end) - exact) <= 0.1 * exact


def test_rollup_limits(spark, tmp_dir):
    from claimsight.operators.rollup import Rollup, _weighted_rank, build
    build(_portfolio(spark).limit(0), tmp_dir)
    empty = Rollup(spark, tmp_dir)
    assert empty.median() is None and empty.kpis().first()["total_claims"] == 0 and empty.policies() == 0
    with pytest.raises(ValueError):
        empty.monthly("other")
    values = spark.createDataFrame([(float(i * i), 1 + i % 3) for i in range(300)], "amount double, n long")
    flat = sorted(a for a, n in ((r["amount"], r["n"]) for r in values.collect()) for _ in range(n))
    for rank in (0, 1, 299, len(flat) - 1):
        assert _weighted_rank(values, rank, final_rows=5) == _weighted_rank(values, rank) == flat[rank]


def test_level_pipeline_opens_each_vector_once(spark):
    """The vector is not turned into an array again at every slot."""
    from claimsight.plans.queries_scale import q_level_pipeline
    out = q_level_pipeline(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().analyzed().toString()
    lambdas = [line for line in plan.splitlines() if "lambdafunction(" in line]
    assert lambdas and not any("UDF(" in line.split("lambdafunction(", 1)[1] for line in lambdas)
    assert {r["entries"] for r in out.collect()} == {2}
