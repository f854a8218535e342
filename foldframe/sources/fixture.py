"""The `listings` fixture: one listing row per order, built from the driver's
TPC-H-like tables so that every column role of the listing schema exists.

This only produces input rows in the listing schema; none of the feature or
model work happens here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows with `price` for every row and an `is_train` flag."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    li = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_shipdate").alias("mx"),
            F.sum("l_quantity").alias("q"),
            F.avg("l_discount").alias("disc"),
            F.avg("l_tax").alias("tax"),
            F.avg("l_extendedprice").alias("ep"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    k = F.col("o_orderkey")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").join(
        li, k == F.col("l_orderkey"), "left")
    reg_text = F.date_format(F.col("o_orderdate"), "yyyyMMdd")
    return j.select(
        k.alias("SaleID"),
        F.col("o_custkey").alias("name"),
        F.when(k % 97 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit("0011")))
        .otherwise(reg_text).alias("regDate"),
        F.date_format(F.date_add(F.to_date("mx"), 730), "yyyyMMdd").alias("creatDate"),
        F.when(k % 53 == 0, F.lit(None)).otherwise(F.col("o_custkey") % 250).cast("double").alias("model"),
        F.col("c_nationkey").cast("long").alias("brand"),
        F.when(k % 41 == 0, F.lit(None)).otherwise(k % 8).cast("double").alias("bodyType"),
        (k % 7).cast("double").alias("fuelType"),
        (k % 2).cast("double").alias("gearbox"),
        F.round(F.col("c_acctbal") / 10).cast("double").alias("power"),
        (F.col("q") / 20).alias("kilometer"),
        F.when(F.col("o_orderstatus") == "F", "0.0")
        .when(F.col("o_orderstatus") == "O", "1.0").otherwise("-").alias("notRepairedDamage"),
        F.col("o_custkey").alias("regionCode"),
        F.lit(0).alias("seller"),
        F.lit(0).alias("offerType"),
        F.col("o_totalprice").alias("price"),
        (F.col("c_acctbal") / 1000).alias("v_0"),
        F.col("disc").alias("v_1"),
        F.col("tax").alias("v_2"),
        (F.col("ep") / 1000).alias("v_3"),
        F.col("n").cast("double").alias("v_4"),
        (k % 4 != 0).alias("is_train"),
    )


def split_train_test(listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train rows keep the target; test rows lose it (as in the raw files)."""
    train = listing.where(F.col("is_train")).drop("is_train")
    test = listing.where(~F.col("is_train")).drop("is_train", "price")
    return train, test


# DuckDB text of the same fixture, used by the oracle SQL.
LISTINGS_SQL = """
listings AS (
  WITH li AS (
    SELECT l_orderkey, max(l_shipdate) AS mx, sum(l_quantity) AS q,
           avg(l_discount) AS disc, avg(l_tax) AS tax, avg(l_extendedprice) AS ep,
           count(*) AS n
    FROM lineitem GROUP BY l_orderkey)
  SELECT o_orderkey AS SaleID,
         o_custkey AS name,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '0011'
              ELSE strftime(o_orderdate, '%Y%m%d') END AS regDate,
         strftime(CAST(mx AS DATE) + 730, '%Y%m%d') AS creatDate,
         CAST(CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_custkey % 250 END AS DOUBLE) AS model,
         CAST(c_nationkey AS BIGINT) AS brand,
         CAST(CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderkey % 8 END AS DOUBLE) AS bodyType,
         CAST(o_orderkey % 7 AS DOUBLE) AS fuelType,
         CAST(o_orderkey % 2 AS DOUBLE) AS gearbox,
         CAST(round(c_acctbal / 10) AS DOUBLE) AS power,
         q / 20 AS kilometer,
         CASE WHEN o_orderstatus = 'F' THEN '0.0' WHEN o_orderstatus = 'O' THEN '1.0' ELSE '-' END
           AS notRepairedDamage,
         o_custkey AS regionCode,
         0 AS seller, 0 AS offerType,
         o_totalprice AS price,
         c_acctbal / 1000 AS v_0, disc AS v_1, tax AS v_2, ep / 1000 AS v_3,
         CAST(n AS DOUBLE) AS v_4,
         (o_orderkey % 4 <> 0) AS is_train
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN li ON o_orderkey = l_orderkey
)"""
