import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from claimsight.plans.scoring import prepared_claims
from claimsight.sources import artifacts as A
from claimsight.sources import files as S
from claimsight.sources.tables import TABLES

from conftest import SF0001


def test_read_claims_and_policies_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "claims.csv")
    with open(path, "w") as f:
        f.write("Claim_ID,Policy_ID,Customer_ID,Accident_Date,FNOL_Date,Settlement_Date,Estimated_Claim_Amount,"
                "Ultimate_Claim_Amount,Traffic_Condition,Weather_Condition,Claim_Type\n"
                "CLM-2024-00001,POL-1,CUS-1,2024-01-05,2024-01-06 10:00:00,2024-02-01,1200.5,1300,Light,Clear,Fire\n")
    df = S.read_claims(spark, path)
    r = df.first()
    assert r["Claim_ID"] == "CLM-2024-00001" and r["Ultimate_Claim_Amount"] == 1300.0


def test_upload_rejects_malformed_dates(spark, tmp_dir):
    good = os.path.join(tmp_dir, "good")
    os.makedirs(good)
    with open(os.path.join(good, "u.csv"), "w") as f:
        f.write("Claim_ID,Accident_Date,Estimated_Claim_Amount\nc1,2024-01-01,10\nc2,2024-02-29 08:00:00,20\n")
    df = S.read_upload(spark, good)
    assert df.schema["Accident_Date"].dataType.simpleString() == "timestamp_ntz"
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "u.csv"), "w") as f:
        f.write("Claim_ID,Accident_Date,Estimated_Claim_Amount\nc1,2023-02-29,10\n")
    with pytest.raises(S.UploadError):
        S.read_upload(spark, bad)


def test_processed_versions_and_split(spark, tmp_dir):
    df = prepared_claims(spark, SF0001)
    v1 = A.write_processed(df.limit(10), tmp_dir, version="20240101T000000Z")
    v2 = A.write_processed(df, tmp_dir, version="20250101T000000Z")
    assert A.latest_version(spark, tmp_dir) == v2 and v1 < v2
    assert A.read_processed(spark, tmp_dir).count() == df.count()
    assert A.read_processed(spark, tmp_dir, v1).count() == 10
    with pytest.raises(FileNotFoundError):
        A.read_processed(spark, os.path.join(tmp_dir, "missing"))
    meta = A.read_metadata(spark, tmp_dir).orderBy("version").collect()
    assert [m["n_rows"] for m in meta] == [10, df.count()]
    assert A.schema_fingerprint(df)["n_columns"] == 28
    with pytest.raises(ValueError):
        A.dataset_metadata(df, "other")


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.columns == ["Month", "value", "moving_avg"] and out.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


@pytest.mark.parametrize("name", ["monthly_exposure", "reserve_adequacy_driver_age", "savings_summary",
                                  "feature_statistics", "impute_median", "ale_estimate", "insights"])
def test_oracle_agreement_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF0001)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    idx = [dcols.index(c) for c in cols]
    drows = sorted(tuple(str(r[i]) for i in idx) for r in res.fetchall())
    assert sorted(dcols) == cols and srows == drows


def test_export_and_prediction_log(spark, tmp_dir):
    df = prepared_claims(spark, SF0001).select("Claim_ID", "Accident_Date", "Estimated_Claim_Amount")
    S.export_csv(df, os.path.join(tmp_dir, "out"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "out"))
    assert back.count() == df.count()
    S.append_prediction_log(df.limit(3), os.path.join(tmp_dir, "log"))
    S.append_prediction_log(df.limit(2), os.path.join(tmp_dir, "log"))
    log = spark.read.parquet(os.path.join(tmp_dir, "log"))
    assert log.count() == 5 and "scored_at" in log.columns
    assert log.where(F.col("scored_at").isNull()).count() == 0


def test_columns_are_matched_by_name_across_files(spark, tmp_dir):
    for name, lines in (("a.csv", "Claim_ID,Policy_ID,Estimated_Claim_Amount\nc1,p1,10\nc3,p3,30\n"),
                        ("b.csv", "Policy_ID,Estimated_Claim_Amount,Claim_ID\np2,20,c2\n"),
                        ("c.csv", 'Claim_ID,"Note, free"\nc4,"x, y"\n')):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(lines)
    got = {r["Claim_ID"]: (r["Policy_ID"], r["Estimated_Claim_Amount"], r["Note, free"]) for r in S.read_claims(spark, tmp_dir).collect()}
    assert got == {"c1": ("p1", 10.0, None), "c2": ("p2", 20.0, None), "c3": ("p3", 30.0, None), "c4": (None, None, "x, y")}
    assert S.read_upload(spark, tmp_dir).count() == 4


def test_read_policies(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p.csv")
    with open(path, "w") as f:
        f.write("Vehicle_Year,Policy_ID,Customer_ID,Date_of_Birth\n2015,POL-1,CUS-1,1980-02-03\nold,POL-2,CUS-2,\n")
    got = {r["Policy_ID"]: (r["Customer_ID"], r["Vehicle_Year"], r["Date_of_Birth"]) for r in S.read_policies(spark, path).collect()}
    assert got == {"POL-1": ("CUS-1", 2015, "1980-02-03"), "POL-2": ("CUS-2", None, None)}


def test_fingerprint_keeps_column_order(spark):
    df = spark.createDataFrame([(1, "a", None)], "n int, s string, t timestamp_ntz")
    assert A.schema_fingerprint(df) != A.schema_fingerprint(df.select("s", "n", "t"))
    meta = A.dataset_metadata(df, "split", test=df.select("s", "n", "t"), lineage={"split_method": "md5", "target": "n"}).first()
    assert (meta["numeric_columns"], meta["text_columns"], meta["time_columns"]) == (1, 1, 1)
    assert meta["schema_consistent"] is False and meta["train_rows"] == meta["test_rows"] == 1 and meta["info"]["split_method"] == "md5"


def test_shared_folder_is_needed_off_local():
    from claimsight.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, *a):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


ODD_TEXTS = ['He said "hi", ok', "two\nlines", "cr\rx", "crlf\r\nx", "  lead", "trail  ", '"', '""', None, "a,b", "#c", "\\", 'x\\"y', '"q" start',
             "é z", "null", ",", "\n", " ", "\t", 'a\\"']


def test_export_reads_back_equal(spark, tmp_dir):
    import csv
    rows = [(f"c{i}", v, float(i)) for i, v in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame(rows, "Claim_ID string, Claim_Type string, Estimated_Claim_Amount double")
    S.export_csv(df.repartition(3), f"{tmp_dir}/x")
    for read in (S.read_claims, S.read_upload):
        assert sorted((tuple(r) for r in read(spark, f"{tmp_dir}/x").collect()), key=str) == sorted(rows, key=str)
    py = {}
    for f in os.listdir(f"{tmp_dir}/x"):
        if f.endswith(".csv"):
            with open(f"{tmp_dir}/x/{f}", newline="", encoding="utf8") as file:
                py |= {r["Claim_ID"]: r["Claim_Type"] for r in csv.DictReader(file)}
    assert py == {k: v or "" for k, v, _ in rows}


@pytest.mark.parametrize("name", ["Note", "Note\nin two lines", 'Note, "quoted"'])
def test_files_of_spreadsheets_are_read(spark, tmp_dir, name):
    import csv
    with open(f"{tmp_dir}/p.csv", "w", newline="", encoding="utf-8-sig") as f:  # byte order mark, \r\n
        w = csv.writer(f)
        w.writerow(["Claim_ID", "Claim_Type", "Estimated_Claim_Amount", name])
        w.writerows([f"c{i}", v, i, "n"] for i, v in enumerate(ODD_TEXTS))
    up = S.read_upload(spark, f"{tmp_dir}/p.csv")
    assert up.columns == ["Claim_ID", "Claim_Type", "Estimated_Claim_Amount", name]
    assert {r[0]: (r[1], r[2], r[3]) for r in up.collect()} == {f"c{i}": (v, float(i), "n") for i, v in enumerate(ODD_TEXTS)}


def test_lost_numbers_are_counted(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('Claim_ID,Estimated_Claim_Amount\nc1,"1,200"\nc2, 7 \nc3,\n')
    assert S.lost_numbers(spark, f"{tmp_dir}/a.csv", S.CLAIMS_SCHEMA).first().asDict() == {"Estimated_Claim_Amount": 1}
    assert {r["Claim_ID"]: r["Estimated_Claim_Amount"] for r in S.read_claims(spark, f"{tmp_dir}/a.csv").collect()} == {"c1": None, "c2": 7.0, "c3": None}
    with pytest.raises(S.UploadError):
        S.read_upload(spark, f"{tmp_dir}/a.csv")


def test_exposure_stream_finds_columns_by_name(spark, tmp_dir):
    from pyspark.errors import StreamingQueryException
    from claimsight.streaming.arrivals import EXPOSURE_SCHEMA, monthly_exposure_stream, read_snapshot
    files = {"a": 'Claim_ID,Accident_Date,Ultimate_Claim_Amount\nc1,2024-01-05,10\nc2,2024-01-06,abc\n', "empty": "",
             "b": 'Ultimate_Claim_Amount,"Note, x",Claim_ID,Accident_Date\n5,"two\nlines",c3,2024-02-01\n7,,c4,\n1,,c5,2024-02-30\n',
             "crlf": "Claim_ID,Ultimate_Claim_Amount,Accident_Date\r\nc6,3,2024-02-07\r\n"}
    os.makedirs(f"{tmp_dir}/in")
    for name, text in files.items():
        with open(f"{tmp_dir}/in/{name}.csv", "w", newline="") as f:
            f.write(text)
    run = lambda: monthly_exposure_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/snap", f"{tmp_dir}/ck", EXPOSURE_SCHEMA).awaitTermination()
    run()
    got = {str(r["Month"]): (r["value"], r["claims"], r["rejected"]) for r in read_snapshot(spark, f"{tmp_dir}/snap").collect()}
    assert got == {"2024-01-01": (10.0, 1, 0), "2024-02-01": (8.0, 2, 0), "None": (7.0, 1, 2)}
    with open(f"{tmp_dir}/in/c.csv", "w") as f:
        f.write("Claim_ID,Ultimate_Claim_Amount\nc9,4\n")
    with pytest.raises(StreamingQueryException):
        run()
