"""The driver's TPC-H-shaped tables seen as claims and policies.

``orders`` is the claim grain (one row per order) and ``customer`` the policy
grain.  The mapping uses integer arithmetic on keys plus the order's price and
date, so Spark and an independent SQL engine produce identical rows.  The same
mapping is spelled in SQL in :mod:`claimsight.plans.oracle` for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def claims_from_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast(T.TimestampNTZType())
    price = F.col("o_totalprice").cast("double")
    fnol_h = k * 7 % 97
    settle_h = k * 7 % 97 + 24 * (k * 13 % 181)
    return orders.select(
        k.alias("Claim_ID"),
        F.col("o_custkey").alias("Policy_ID"),
        F.col("o_custkey").alias("Customer_ID"),
        d.alias("Accident_Date"),
        (d + _hours(fnol_h)).alias("FNOL_Date"),
        (d + _hours(settle_h)).alias("Settlement_Date"),
        F.when(k % 50 != 0, price / F.lit(5.0)).alias("Estimated_Claim_Amount"),
        F.when(k % 71 != 0, price / F.lit(5.0) * (F.lit(0.7) + (k % 61) / F.lit(100.0)))
         .alias("Ultimate_Claim_Amount"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Collision")
         .when(F.col("o_orderpriority") == "2-HIGH", "Theft")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "Fire")
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Windshield Damage")
         .otherwise("Third-Party Damage").alias("Claim_Type"),
        F.when(k % 37 == 0, F.lit(None).cast("string")).when(k % 4 == 0, "Light")
         .when(k % 4 == 1, "Moderate").when(k % 4 == 2, "High").otherwise("Severe")
         .alias("Traffic_Condition"),
        F.when(k % 41 == 0, F.lit(None).cast("string")).when(k % 5 == 0, "Clear")
         .when(k % 5 == 1, "Rainy").when(k % 5 == 2, "Foggy").when(k % 5 == 3, "Snowy")
         .otherwise("Stormy").alias("Weather_Condition"),
    )


def policies_from_customer(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    dob_days = c * 37 % 21000
    base_dob = F.lit("1920-01-01 00:00:00").cast(T.TimestampNTZType())
    base_lic = F.lit("1937-01-01 00:00:00").cast(T.TimestampNTZType())
    return customer.select(
        c.alias("Policy_ID"),
        c.alias("Customer_ID"),
        (base_dob + _days(dob_days)).alias("Date_of_Birth"),
        (base_lic + _days(dob_days + c % 900)).alias("Full_License_Issue_Date"),
        (F.lit(1980) + c % 25).cast("int").alias("Vehicle_Year"),
        F.col("c_mktsegment").alias("Vehicle_Type"),
    )


def fixture_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_from_orders(read_table(spark, sf_dir, "orders"))


def fixture_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies_from_customer(read_table(spark, sf_dir, "customer"))
