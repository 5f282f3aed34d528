"""Registered queries for sources, sinks, artifacts and the arrival stream (2.1, 2.12).

Each writes its intermediate tables under the session's shared checkpoint
folder (a fresh sub-folder per run) and reads them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from claimsight.operators.metrics import fit_loglinear, loglinear_predict
from claimsight.operators.split import is_test
from claimsight.plans.catalog import _CACHE, _key, merged, prepared, register, rnd, scored
from claimsight.plans.prepare import persist_split
from claimsight.plans.scoring import enrich_predictions
from claimsight.session import shared_path
from claimsight.sources import artifacts as A
from claimsight.sources.files import CLAIMS_SCHEMA, export_csv, lost_numbers, read_claims, read_upload
from claimsight.sources.history import append_batch, read_history
from claimsight.streaming.arrivals import UPLOAD_COLUMNS, UPLOAD_SCHEMA, score_arrivals


def _run_dir(spark, what: str) -> str:
    return shared_path(spark, f"{what}/{uuid.uuid4().hex}")


@register("dataset_metadata", """
SELECT CAST(any_value(n) AS BIGINT) AS n_rows, CAST(count(*) AS INT) AS n_columns,
  CAST(count(*) FILTER (WHERE kind IN ('BIGINT', 'INTEGER', 'DOUBLE') OR kind LIKE 'DECIMAL%') AS INT) AS numeric_columns,
  CAST(count(*) FILTER (WHERE kind = 'VARCHAR') AS INT) AS text_columns,
  CAST(count(*) FILTER (WHERE kind LIKE 'TIMESTAMP%' OR kind = 'DATE') AS INT) AS time_columns
FROM (SELECT typeof(COLUMNS(*)) FROM features LIMIT 1) UNPIVOT INCLUDE NULLS (kind FOR col IN (*))
CROSS JOIN (SELECT count(*) AS n FROM features)""")
def q_dataset_metadata(spark, sf):
    """Rows, columns and column-kind counts of the processed artifact (A1, A3)."""
    meta = A.dataset_metadata(prepared(spark, sf), "processed")
    return meta.select("n_rows", "n_columns", "numeric_columns", "text_columns", "time_columns")


@register("processed_roundtrip", """
SELECT Claim_Type, CAST(count(*) AS BIGINT) AS claims FROM features GROUP BY 1""")
def q_processed_roundtrip(spark, sf):
    """Write a processed version with metadata, read the latest version back."""
    base = _run_dir(spark, "processed")
    A.write_processed(prepared(spark, sf), base, lineage={"source": sf})
    back = A.read_processed(spark, base)
    return back.groupBy("Claim_Type").agg(F.count(F.lit(1)).alias("claims"))


@register("split_roundtrip", """
SELECT split, CAST(count(*) AS BIGINT) AS claims FROM split GROUP BY 1""")
def q_split_roundtrip(spark, sf):
    """Persist the split partitioned by ``split`` and reload each part with pruning."""
    path = _run_dir(spark, "split")
    persist_split(prepared(spark, sf), path)
    train = A.read_split(spark, path, "train").agg(F.count(F.lit(1)).alias("claims")).withColumn(
        "split", F.lit("train"))
    test = A.read_split(spark, path, "test").agg(F.count(F.lit(1)).alias("claims")).withColumn(
        "split", F.lit("test"))
    return train.unionByName(test)


@register("split_metadata", """
SELECT CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_rows, CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_rows,
  true AS schema_consistent, '0.2' AS test_fraction, 'Ultimate_Claim_Amount' AS target FROM split""")
def q_split_metadata(spark, sf):
    """Metadata of a persisted split: rows of both parts, equal schemas, how it was made."""
    path = _run_dir(spark, "split")
    persist_split(prepared(spark, sf), path)
    meta = spark.read.parquet(f"{path}/_meta")
    return meta.select("train_rows", "test_rows", "schema_consistent", F.col("info")["test_fraction"].alias("test_fraction"),
                       F.col("info")["target"].alias("target"))


@register("upload_roundtrip", """
SELECT Claim_Type, CAST(count(*) AS BIGINT) AS claims,
  CAST(sum(CAST(round(Estimated_Claim_Amount * 1000) AS BIGINT)) AS BIGINT) AS estimate_milli,
  CAST(count(*) FILTER (WHERE FNOL_Date IS NOT NULL) AS BIGINT) AS dated
FROM features GROUP BY 1""")
def q_upload_roundtrip(spark, sf):
    """Export claims as CSV, read them back as an upload with parsed dates.

    The estimate total is compared in exact integer thousandths: a float sum
    can sit on a rounding half.
    """
    path = _run_dir(spark, "upload")
    export_csv(prepared(spark, sf).select(*UPLOAD_COLUMNS), path)
    up = read_upload(spark, path)
    milli = F.round(F.col("Estimated_Claim_Amount") * 1000).cast("bigint")
    return up.groupBy("Claim_Type").agg(F.count(F.lit(1)).alias("claims"), F.sum(milli).alias("estimate_milli"),
                                        F.count("FNOL_Date").alias("dated"))


@register("quoted_export", """
SELECT CAST(Claim_ID AS VARCHAR) AS Claim_ID, Claim_Type || ', "' || Weather_Condition || '"' || chr(10) || ' second line,' AS Claim_Type,
  CAST(round(Estimated_Claim_Amount * 1000) AS BIGINT) AS estimate_milli, CAST(1 AS BIGINT) AS lost FROM features""")
def q_quoted_export(spark, sf):
    """Claims whose texts hold quotes, commas and line breaks, exported and read back as claims and as an upload.

    ``lost`` counts amounts that the reader could not cast: the one of an added row, which comes back as NULL and is left out.
    """
    path = _run_dir(spark, "quoted")
    text = F.concat("Claim_Type", F.lit(', "'), "Weather_Condition", F.lit('"\n second line,'))
    claims = prepared(spark, sf).select(F.col("Claim_ID").cast("string").alias("Claim_ID"), text.alias("Claim_Type"),
                                        F.col("Estimated_Claim_Amount").cast("string").alias("Estimated_Claim_Amount"), "FNOL_Date")
    export_csv(claims, f"{path}/good")
    export_csv(claims, f"{path}/all")
    odd = spark.createDataFrame([("12,5 \"or so\"", "odd\nrow")], "Estimated_Claim_Amount string, Claim_ID string")
    export_csv(odd, f"{path}/all", mode="append")
    lost = lost_numbers(spark, f"{path}/all", CLAIMS_SCHEMA).first()["Estimated_Claim_Amount"]
    read = read_claims(spark, f"{path}/all").where("Claim_ID <> 'odd\\nrow'").select("Claim_ID", "Claim_Type", "Estimated_Claim_Amount")
    upload = read_upload(spark, f"{path}/good").select("Claim_ID", F.col("Claim_Type").alias("same"), F.col("Estimated_Claim_Amount").alias("e"))
    both = read.join(upload, "Claim_ID").where(F.col("Claim_Type").eqNullSafe(F.col("same")) & F.col("Estimated_Claim_Amount").eqNullSafe(F.col("e")))
    milli = F.round(F.col("Estimated_Claim_Amount") * 1000).cast("bigint").alias("estimate_milli")
    return both.select("Claim_ID", "Claim_Type", milli, F.lit(lost).cast("bigint").alias("lost"))


@register("demo_views", """
SELECT Claim_ID, Policy_ID, round(Predictions, 4) AS Predictions, Severity,
  round(Recommended_Reserve, 4) AS Recommended_Reserve FROM scored""")
def q_demo_views(spark, sf):
    """Start-up view (S8): read the newest committed version, score it, enrich, log the predictions once per version."""
    base = processed_base(spark, sf)
    df = A.read_processed(spark, base)
    a, b = fit_loglinear(df.where(~is_test()))
    out = enrich_predictions(df.withColumn("Predictions", F.expm1(loglinear_predict(a, b))))
    out = out.select("Claim_ID", "Policy_ID", "Predictions", "Severity", "Recommended_Reserve")
    append_batch(out, f"{base}/predictions", A.latest_version(spark, base))
    return rnd(out, {"Predictions": 4, "Recommended_Reserve": 4})


def processed_base(spark, sf) -> str:
    """Folder of the processed table of ``sf``, written at the first call of a session and only read afterwards."""
    key = _key(spark, sf, "processed")
    if key not in _CACHE:
        base = _run_dir(spark, "processed_of")
        A.write_processed(prepared(spark, sf), base, lineage={"source": sf})
        _CACHE[key] = base
    return _CACHE[key]


@register("prediction_history", """
SELECT CAST(Claim_ID % 3 AS INT) AS part, CAST(count(*) AS BIGINT) AS claims, round(sum(Recommended_Reserve), 1) AS reserve
FROM scored WHERE Claim_ID % 3 < 2 GROUP BY 1""")
def q_prediction_history(spark, sf):
    """Two batches, each written twice, and an attempt that died before its commit: every claim counts once."""
    path = _run_dir(spark, "history")
    claims = scored(spark, sf).select("Claim_ID", "Predictions", "Severity", "Recommended_Reserve")
    parts = [claims.where(F.col("Claim_ID") % 3 == k) for k in range(3)]
    parts[2].withColumns({"batch_id": F.lit("2024-03"), "scored_at": F.localtimestamp()}).write.parquet(f"{path}/data/batch=b-2024-03/attempt=a-dead")
    for name, part in (("2024-01", parts[0]), ("2024-02", parts[1]), ("2024-01", parts[0]), ("2024-02", parts[1])):
        append_batch(part, path, name)
    out = read_history(spark, path).groupBy((F.col("Claim_ID") % 3).cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("claims"), F.sum("Recommended_Reserve").alias("reserve"))
    return rnd(out, {"reserve": 1})


_OBSERVED = ("Estimated_Claim_Amount", "Claim_Type", "Traffic_Condition", "Weather_Condition", "Vehicle_Type")


@register("written_metrics", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS nulls, CAST(count(*) AS BIGINT) AS n_rows, "
    f"strftime(min(Accident_Date), '%Y-%m-%d %H:%M:%S') AS first_time, strftime(max(Accident_Date), '%Y-%m-%d %H:%M:%S') AS last_time FROM merged"
    for c in _OBSERVED) + ")")
def q_written_metrics(spark, sf):
    """Rows, NULLs per column and time range of the joined claims, observed while they are written (S3, A1, Q1)."""
    base = _run_dir(spark, "observed")
    A.write_processed(merged(spark, sf), base)
    meta = A.read_metadata(spark, base)
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.element_at("nulls", c).alias("nulls")) for c in _OBSERVED]))
    return meta.select(each, "n_rows", "first_time", "last_time")


_HASHED = ("Accident_Date", "Claim_ID", "Claim_Type", "Driver_Age", "Estimated_Claim_Amount", "Vehicle_Year", "Weather_Condition")


@register("schema_hash", f"""
k AS (SELECT typeof(COLUMNS(*)) FROM (SELECT {', '.join(_HASHED)} FROM features) LIMIT 1),
t AS (SELECT * FROM k UNPIVOT INCLUDE NULLS (kind FOR col IN (*)))
SELECT md5(string_agg('`' || col || '` ' || CASE kind WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
         WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(kind) END, ',' ORDER BY col)) AS schema_hash, CAST(count(*) AS INT) AS n_columns FROM t""")
def q_schema_hash(spark, sf):
    """Hash of the names and types of seven columns, in the order of their names (A3)."""
    own = A.schema_fingerprint(prepared(spark, sf).select(*sorted(_HASHED)))
    return spark.createDataFrame([(own["schema_hash"], own["n_columns"])], "schema_hash string, n_columns int")


@register("score_arrivals", """
SELECT CAST(Claim_ID AS VARCHAR) AS Claim_ID, round(Estimate_Relative_to_Type, 8) AS Estimate_Relative_to_Type,
  round(Predictions, 4) AS Predictions, Severity, round(Recommended_Reserve, 4) AS Recommended_Reserve
FROM scored""")
def q_score_arrivals(spark, sf):
    """Arrival stream (ST1): claims dropped as CSV files are scored into a Parquet sink."""
    base = _run_dir(spark, "arrivals")
    df = prepared(spark, sf)
    a, b = fit_loglinear(df.where(~is_test()))
    export_csv(df.select(*UPLOAD_COLUMNS), f"{base}/in")
    type_means = df.select("Claim_Type", "Type_Avg_Estimate").dropDuplicates(["Claim_Type"])

    def scorer(s):
        return s.withColumn("prediction", loglinear_predict(a, b))

    q = score_arrivals(spark, f"{base}/in", f"{base}/out", f"{base}/_checkpoint", UPLOAD_SCHEMA, scorer,
                       "2026-01-01 00:00:00", type_means=type_means)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out").select(
        "Claim_ID", "Estimate_Relative_to_Type", "Predictions", "Severity", "Recommended_Reserve")
    return rnd(out, {"Estimate_Relative_to_Type": 8, "Predictions": 4, "Recommended_Reserve": 4})


@register("monthly_exposure_stream", """
m AS (SELECT CAST(date_trunc('month', Accident_Date) AS DATE) AS Month, sum(Ultimate_Claim_Amount) AS value
      FROM scored GROUP BY 1)
SELECT strftime(Month, '%Y-%m-%d') AS Month, round(value, 2) AS value,
  round(avg(value) OVER (ORDER BY Month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving_avg
FROM m""")
def q_monthly_exposure_stream(spark, sf):
    """Claims arriving as CSV files keep the monthly exposure current (stateful stream, G4 + W2)."""
    from claimsight.operators.portfolio import with_moving_average
    from claimsight.plans.catalog import iso
    from claimsight.streaming.arrivals import EXPOSURE_SCHEMA, monthly_exposure_stream, read_snapshot
    base = _run_dir(spark, "exposure_stream")
    cols = [f.name for f in EXPOSURE_SCHEMA.fields]
    export_csv(prepared(spark, sf).select(*cols), f"{base}/in")
    q = monthly_exposure_stream(spark, f"{base}/in", f"{base}/snapshot", f"{base}/_checkpoint", EXPOSURE_SCHEMA)
    q.awaitTermination()
    snap = read_snapshot(spark, f"{base}/snapshot").select("Month", "value")
    return iso(rnd(with_moving_average(snap), {"value": 2, "moving_avg": 2}), "Month")


@register("exposure_stream_by_name", """
c AS (SELECT Claim_ID % 50 = 0 AS bad, CAST(date_trunc('month', Accident_Date) AS DATE) AS Month, Ultimate_Claim_Amount AS amount FROM scored)
SELECT strftime(CASE WHEN NOT bad THEN Month END, '%Y-%m-%d') AS Month, round(sum(CASE WHEN NOT bad THEN amount END), 6) AS value,
  CAST(count(*) FILTER (NOT bad) AS BIGINT) AS claims, CAST(count(*) FILTER (bad) AS BIGINT) AS rejected
FROM c GROUP BY CASE WHEN NOT bad THEN Month END""")
def q_exposure_stream_by_name(spark, sf):
    """Arriving files with their columns in different orders, an extra quoted column, and malformed amounts in every fiftieth claim."""
    from claimsight.plans.catalog import iso
    from claimsight.streaming.arrivals import EXPOSURE_SCHEMA, monthly_exposure_stream, read_snapshot
    base = _run_dir(spark, "exposure_by_name")
    amount = F.when(F.col("Claim_ID") % 50 == 0, F.lit("a \"lot\",\nor so")).otherwise(F.col("Ultimate_Claim_Amount").cast("string"))
    claims = prepared(spark, sf).select("Claim_ID", "Accident_Date", amount.alias("Ultimate_Claim_Amount"), F.concat(F.lit('"'), "Claim_Type", F.lit('",')).alias("Note"))
    half = F.col("Claim_ID") % 2 == 0
    export_csv(claims.where(half), f"{base}/in", mode="append")
    export_csv(claims.where(~half).select(*reversed(claims.columns)), f"{base}/in", mode="append")
    monthly_exposure_stream(spark, f"{base}/in", f"{base}/snapshot", f"{base}/_checkpoint", EXPOSURE_SCHEMA).awaitTermination()
    # Amounts have five or six decimals: at two, a sum can sit on a rounding half.
    return iso(rnd(read_snapshot(spark, f"{base}/snapshot"), {"value": 6}), "Month")
