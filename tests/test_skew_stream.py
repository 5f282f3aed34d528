import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from claimsight.functions.quantiles import exact_quantiles, mode_values
from claimsight.operators import portfolio as P
from claimsight.operators.joins import attach_group_mean, attach_lookup, merge_claims_policies
from claimsight.sources.files import export_csv
from claimsight.streaming.arrivals import UPLOAD_COLUMNS, UPLOAD_SCHEMA, score_arrivals


def test_hot_policy_join_keeps_every_row(spark):
    # a third of all claims on one policy: the join must neither drop nor duplicate
    n = 3000
    claims = spark.range(n).select(F.col("id").alias("Claim_ID"),
                                   F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("Policy_ID"),
                                   F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("Customer_ID"))
    policies = spark.range(n).select(F.col("id").alias("Policy_ID"), F.col("id").alias("Customer_ID"),
                                     (F.col("id") % 25 + 1990).alias("Vehicle_Year"))
    out = merge_claims_policies(claims, policies)
    assert out.count() == n
    assert out.where("Policy_ID = 0").count() == n // 3
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_hot_group_mean_and_mode(spark):
    rows = [("Collision" if i % 3 == 0 else f"T{i % 7}", float(i)) for i in range(2100)]
    df = spark.createDataFrame(rows, "Claim_Type string, e double")
    got = attach_group_mean(df, "Claim_Type", "e", "m").where("Claim_Type = 'Collision'").select("m").distinct()
    assert got.count() == 1
    assert got.first()["m"] == pytest.approx(sum(float(i) for i in range(0, 2100, 3)) / 700)
    assert mode_values(df, ["Claim_Type"]) == {"Claim_Type": "Collision"}


def test_lookup_is_one_join_for_any_table(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("v"))
    out = attach_group_mean(df, "k", "v", "m")
    assert out.where(F.col("m") != F.col("v")).count() == 0 and out.count() == 50
    # NULL and repeated keys of the table neither raise nor multiply rows
    odd = spark.createDataFrame([("1", 5.0), ("1", 7.0), (None, 9.0), ("x", None)], "k string, x double")
    rows = spark.createDataFrame([("1",), ("x",), ("y",), (None,)], "k string")
    assert {r["k"]: r["x"] for r in attach_lookup(rows, odd, "k", "x").collect()} == {"1": 7.0, "x": None, "y": None, None: None}
    assert attach_lookup(rows, odd, "k", "x").count() == 4


def test_quantiles_hot_value_exact(spark):
    vals = [5.0] * 1000 + [float(i) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    import numpy as np
    got = exact_quantiles(df, ["x"], [0.25, 0.5], buckets=8, final_rows=10)["x"]
    assert got[0.25] == pytest.approx(float(np.quantile(vals, 0.25)))
    assert got[0.5] == pytest.approx(float(np.quantile(vals, 0.5)))


def test_monthly_series_with_hot_month(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(days=(0 if i % 3 == 0 else i % 300)), float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "Accident_Date timestamp_ntz, Ultimate_Claim_Amount double")
    total = sum(r[1] for r in rows)
    assert P.monthly_exposure(df).agg(F.sum("value")).first()[0] == pytest.approx(total)


def test_arrival_stream_scores_files(spark, tmp_dir):
    rows = [(f"c{i}", f"p{i}", "2024-01-01 00:00:00", "2024-01-02 06:00:00", "2024-02-01 00:00:00",
             1000.0 * (i + 1), 30.0, 5.0, 3.0, "Fire", "High", "Stormy", "AUTOMOBILE") for i in range(20)]
    df = spark.createDataFrame(rows, UPLOAD_SCHEMA)
    export_csv(df.select(*UPLOAD_COLUMNS).repartition(3), os.path.join(tmp_dir, "in"))
    means = spark.createDataFrame([("Fire", 10000.0)], "Claim_Type string, Type_Avg_Estimate double")

    def scorer(s):
        return s.withColumn("prediction", F.log1p(F.col("Estimated_Claim_Amount")))

    q = score_arrivals(spark, os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out"),
                       os.path.join(tmp_dir, "ckpt"), UPLOAD_SCHEMA, scorer, "2026-01-01 00:00:00",
                       type_means=means)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert out.count() == 20
    r = out.where("Claim_ID = 'c9'").first()
    assert r["Predictions"] == pytest.approx(10000.0)
    assert r["Estimate_Relative_to_Type"] == pytest.approx(1.0)
    assert r["FNOL_Delay"] == pytest.approx(30.0) and r["Complexity_Score"] == "Yes"
    assert r["Severity"] == "Medium"


def test_scale_settings():
    from claimsight.session import scale_settings
    s = scale_settings(100 * 1024 ** 4, executor_cores=4, executors=1000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600  # 100 TiB / 256 MiB
    small = scale_settings(10 * 1024 ** 2, executor_cores=4, executors=2)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # at least three waves


def _arrivals(spark, folder, name, lines):
    import os
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


def _score_folder(spark, folder):
    from pyspark.sql import types as T
    from claimsight.streaming.arrivals import score_arrivals
    schema = T.StructType([T.StructField("Claim_ID", T.StringType()), T.StructField("Accident_Date", T.StringType()),
                           T.StructField("Driver_Age", T.DoubleType())])
    q = score_arrivals(spark, f"{folder}/in", f"{folder}/out", f"{folder}/ckpt", schema,
                       lambda d: d.withColumn("prediction", F.lit(3.0)), "2026-01-01 00:00:00")
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_stream_sets_bad_rows_aside(spark, tmp_dir):
    _arrivals(spark, tmp_dir, "a", ["Claim_ID,Accident_Date,Driver_Age", "c1,2024-01-05,30", "c2,2023-02-29,40", "c3,2024-01-05,old", "c4,,"])
    got = {r["Claim_ID"]: (r["Rejected"], r["Predictions"] is None) for r in _score_folder(spark, tmp_dir).collect()}
    assert got == {"c1": (None, False), "c2": ("Accident_Date", True), "c3": ("Driver_Age", True), "c4": (None, False)}


def test_stream_stops_at_another_header(spark, tmp_dir):
    from pyspark.errors import StreamingQueryException
    _arrivals(spark, tmp_dir, "a", ["Accident_Date,Claim_ID,Driver_Age", "2024-01-05,c1,30"])
    with pytest.raises(StreamingQueryException):
        _score_folder(spark, tmp_dir)


def test_snapshot_versions(spark, tmp_dir):
    from claimsight.streaming.arrivals import EXPOSURE_SCHEMA, monthly_exposure_stream, read_snapshot
    snap = f"{tmp_dir}/snap"
    assert read_snapshot(spark, snap).count() == 0
    for i, amount in enumerate((10, 30)):
        _arrivals(spark, tmp_dir, f"f{i}", ["Claim_ID,Accident_Date,Ultimate_Claim_Amount", f"c{i},2024-01-05,{amount}"])
        monthly_exposure_stream(spark, f"{tmp_dir}/in", snap, f"{tmp_dir}/ck", EXPOSURE_SCHEMA).awaitTermination()
        assert [r["value"] for r in read_snapshot(spark, snap).collect()] == [10.0 if i == 0 else 40.0]


def test_null_keys_are_counted_when_asked(spark):
    claims = spark.createDataFrame([(None, None)] * 3 + [(1, 1)], "Policy_ID long, Customer_ID long")
    policies = spark.createDataFrame([(None, None)] * 2 + [(1, 1)], "Policy_ID long, Customer_ID long").withColumn("x", F.lit(1))
    assert merge_claims_policies(claims, policies, most_null_pairs=6).count() == 7
    with pytest.raises(ValueError):
        merge_claims_policies(claims, policies, most_null_pairs=5)


def test_stream_rows_stay_narrow_and_far_columns_are_found(spark, tmp_dir):
    """Records reach Python in a few columns, with short ones filled up by the parser; columns beyond the narrow part are still found by name."""
    from claimsight.sources.files import _NEAR_COLUMNS, csv_stream
    more = [f"x{i}" for i in range(2 * _NEAR_COLUMNS)]
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w", newline="") as f:
        f.write(",".join(["a", *more, "b"]) + "\r\n" + ",".join(["1", *more, '"two,\nlines"']) + "\r\n")
    with open(f"{tmp_dir}/in/b.csv", "w") as f:
        f.write("a,b\n3,4\n2\n")
    rows = csv_stream(spark, f"{tmp_dir}/in", ["a", "b"])
    plan = rows._jdf.queryExecution().analyzed()
    assert plan.child().output().size() == _NEAR_COLUMNS + 2
    assert plan.child().child().output().size() > 257  # one column more than is read
    rows.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("1", "two,\nlines"), ("2", None), ("3", "4")], key=str)


def test_a_large_partition_is_exported_and_kept_in_several_files(spark, tmp_dir, monkeypatch):
    from claimsight.plans import scoring
    from claimsight.sources import files
    monkeypatch.setattr(files, "_FILE_ROWS", 100)
    monkeypatch.setattr(scoring, "_FILE_ROWS", 100)
    one = spark.range(250).coalesce(1)
    files.export_csv(one, f"{tmp_dir}/csv")
    kept = scoring.materialize(spark, one, "several_files")
    assert [len(x.inputFiles()) for x in (spark.read.csv(f"{tmp_dir}/csv"), kept)] == [3, 3]
    assert kept.count() == 250
